"""Benchmark decontamination by training suffix arrays.

Every shard of documents (a few megabytes) gets a suffix array of its word sequences, and every suffix of every
benchmark item is searched in it by bisection. Suffixes are compared by their first ``WINDOW`` words, which is what a
window needs; windows that go on in document and item make up longer matches. A suffix that begins with three words
(fewer in shorter items) that no item has cannot match and is left out of the array, so that it is short.

The items are indexed on the driver in blocks of at most ``block_words`` words, each sent to all tasks and used one at
a time: what a task holds is bounded however large the benchmark is, and every document meets every block. Documents
are neither shuffled nor grouped.

Defined results: a null or empty text has no words and is clean; an item without words has no window; items with equal
ids count once, a null id reads as the empty string; repeated rows are judged each; ids are passed on, null as well; an
empty table of documents gives an empty result, an empty benchmark leaves all clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow

#: Fixed value: consecutive words that make up a match.
WINDOW = 10
BLOCK_WORDS = 2_000_000
HEAD = 3
MARKS = 1 << 22


def words_of(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a chunk's words, A-Z lower-cased, and per document the first word's index."""
    chunk = chunk.lower()
    starts, ends, first = chunk.runs(T.LETTERS)
    return chunk.hashes(starts, ends), first


class Index:
    """The windows of a block of items, as sortable keys, and what a suffix that can match must begin with."""

    def __init__(self, item_ids: list[str], texts: list[bytes], window: int = WINDOW):
        self.window = window
        self.names = sorted(set(item_ids))
        place = {n: i for i, n in enumerate(self.names)}
        hashes, first = words_of(T.Chunk.of(texts))
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        counts = np.diff(first)
        lengths = np.minimum(counts, window)
        n_windows = np.where(counts > 0, counts - lengths + 1, 0)
        item = np.repeat(np.arange(len(texts)), n_windows)
        start = np.repeat(first[:-1], n_windows) + np.arange(int(n_windows.sum())) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        self.length = lengths[item]
        self.item = np.array([place[n] for n in item_ids], np.int64)[item] if len(item) else np.zeros(0, np.int64)
        padded = np.concatenate([ids, np.zeros(window, np.int64)])
        rows = padded[start[:, None] + np.arange(window)]
        over = np.arange(window) >= self.length[:, None]
        rows[over] = 0
        self.low = keys_of(rows)
        rows[over] = 2**32 - 1
        self.high = keys_of(rows)
        self.known = np.zeros(MARKS, bool)
        self.known[(self.vocabulary & T.U64(MARKS - 1)).astype(np.int64)] = True
        self.heads: dict[int, np.ndarray] = {}
        for size in sorted(set(np.minimum(self.length, HEAD).tolist())):
            marks = self.heads[size] = np.zeros(MARKS, bool)
            marks[head_hash(padded, start[np.minimum(self.length, HEAD) == size], size)] = True

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words in the items' vocabulary, from 1; 0 for other words."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            maybe = np.flatnonzero(self.known[(hashes & T.U64(MARKS - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            hit = self.vocabulary[at] == hashes[maybe]
            out[maybe[hit]] = at[hit] + 1
        return out


def keys_of(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort as the rows do."""
    return np.ascontiguousarray(rows, dtype=">u4").view(f"S{4 * rows.shape[1]}").reshape(-1)


def head_hash(ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = T.mix(out + ids[at + k].astype(np.uint64))
    return (out & T.U64(MARKS - 1)).astype(np.int64)


def suffix_array(ids: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """The starts of a shard's suffixes that can match, in order, and their keys. ``ids`` has zeros between documents,
    and ``window`` of them at the end."""
    can = np.zeros(len(ids) - index.window, bool)
    for size, marks in index.heads.items():
        inside = ids[: len(can)] > 0
        for k in range(1, size):
            inside &= ids[k: len(can) + k] > 0
        at = np.flatnonzero(inside)
        can[at[marks[head_hash(ids, at, size)]]] = True
    at = np.flatnonzero(can)
    keys = keys_of(ids[at[:, None] + np.arange(index.window)])
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def matches(hashes: np.ndarray, first: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """All places of the index's windows in a shard: word index and window number."""
    gaps = T.doc_of(first)
    ids = np.zeros(len(hashes) + len(first) - 1 + index.window, np.int64)
    spread = np.arange(len(hashes)) + gaps
    ids[spread] = index.look_up(hashes)
    starts, keys = suffix_array(ids, index)
    low, high = np.searchsorted(keys, index.low, "left"), np.searchsorted(keys, index.high, "right")
    found = np.flatnonzero(high > low)
    times = (high - low)[found]
    rank = np.repeat(low[found], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    back = np.zeros(len(ids), np.int64)
    back[spread] = np.arange(len(hashes))
    return back[starts[rank]], np.repeat(found, times)


def longest(words: np.ndarray, windows: np.ndarray, index: Index) -> list[tuple[int, int, int]]:
    """Longest verbatim matches as (word index, number of words, item), from places of windows: a place of one window
    and the next place of the item's next window belong to the same match."""
    out, open_ = [], {}
    for at, w in sorted(zip(words.tolist(), windows.tolist())):
        begun = open_.pop((at - 1, w - 1), None) if w and index.item[w] == index.item[w - 1] else None
        open_[at, w] = begun or (at, int(index.item[w]))
    for (at, w), (begun, item) in open_.items():
        out.append((begun, at - begun + int(index.length[w]), item))
    return sorted(out)


def indexes(benchmark: DataFrame, block_words: int = BLOCK_WORDS, window: int = WINDOW) -> list:
    """The benchmark's blocks, indexed and sent out one after the other; the driver holds one at a time."""
    context, out, ids, texts, size = benchmark.sparkSession.sparkContext, [], [], [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    for item, text in rows.toLocalIterator():
        ids.append(item)
        texts.append(text.encode())
        size += len(texts[-1]) // 2
        if size >= block_words:
            out.append(context.broadcast(Index(ids, texts, window)))
            ids, texts, size = [], [], 0
    if ids:
        out.append(context.broadcast(Index(ids, texts, window)))
    return out


def _judge(column: pa.Array, blocks: list) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, list[set[str]]]]:
    """Per chunk of documents: first document, their number, words, hit words and items."""
    for chunk in T.chunks(column):
        hashes, first = words_of(chunk)
        change = np.zeros(len(hashes) + 1, np.int64)
        items: list[set[str]] = [set() for _ in range(chunk.n)]
        for block in blocks:
            index = block.value
            at, window = matches(hashes, first, index)
            np.add.at(change, at, 1)
            np.add.at(change, at + index.length[window], -1)
            docs = np.searchsorted(first, at, "right") - 1
            for pair in np.unique(docs * len(index.names) + index.item[window]).tolist():
                items[pair // len(index.names)].add(index.names[pair % len(index.names)])
            if len(blocks) > 1:
                block.__dict__.pop("_value", None)  # the next block takes its place
        hit = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
        yield chunk.first, chunk.n, np.diff(first), hit[first[1:]] - hit[first[:-1]], items


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: its words, those inside an occurrence of a window, and the items whose windows occur."""
    docs, blocks = documents(docs), indexes(benchmark, block_words, window)
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, n_items long, "
        "items_sha256 string, contaminated boolean, items array<string>"
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, n, words, hit, items in _judge(part.column("text"), blocks):
                names = [sorted(x) for x in items]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(first, n), pa.array(words), pa.array(hit), pa.array([len(x) for x in names], pa.int64()),
                     pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]), pa.array(hit > 0), pa.array(names, pa.list_(pa.string()))],
                    ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
                )

    return map_arrow(docs, run, schema)


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per longest verbatim match of an item in a document: its first word there and its number of words."""
    docs, blocks = documents(docs), indexes(benchmark, block_words, window)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, first_word long, n_words long, item_id string"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                hashes, first = words_of(chunk)
                for block in blocks:
                    index = block.value
                    found = longest(*matches(hashes, first, index), index)
                    doc = np.searchsorted(first, [a for a, _, _ in found], "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(doc + chunk.first, pa.int64())), pa.array([a - int(first[d]) for (a, _, _), d in zip(found, doc)], pa.int64()),
                         pa.array([n for _, n, _ in found], pa.int64()), pa.array([index.names[i] for _, _, i in found], pa.string())],
                        ["doc_id", "first_word", "n_words", "item_id"],
                    )

    return map_arrow(docs, run, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any word in an occurrence of a window, with all their columns."""
    blocks = indexes(benchmark, block_words, window)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            hit = [h for _, _, _, h, _ in _judge(part.column("text"), blocks)]
            yield part.filter(pa.array(np.concatenate(hit) == 0)) if hit else part

    return map_arrow(docs, run, docs.schema)
