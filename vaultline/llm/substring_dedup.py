"""Exact substring dedup: every byte covered by a ``LENGTH``-byte string that also starts earlier goes.

Any such string holds exactly one anchor: the leftmost of its ``GRAM``-byte pieces with the least hash. So equal strings
have equal anchors at equal distances, and only strings of one anchor need to be compared. The strings of one anchor's
occurrence in a document lie together in one stretch of some 135 bytes.

1. Anchors are counted; what occurs once can't repeat. (A filter of a fixed number of bits decides what is passed on;
   too many anchors for it only let more through.)
2. Equal stretches are one: all but the first of them are removed whole.
3. Where an anchor has stretches that differ, the bytes of the first of each are brought together, and a suffix array
   of each anchor's stretches, built by linear grouping, puts equal strings side by side; in each run of equal strings
   all but the earliest are removed. An anchor with many stretches is split first: strings that begin at nearly the same
   distance before it lie in one piece, and only pieces that agree in what all their strings hold can have equal ones.
   For an anchor with very many stretches, each string is a piece. (A filter of a fixed number of bits tells where the
   first ones lie; too many for it only let more through.)
4. The removed ranges are united by document.

Equal stretches and strings are reduced to the first by task before they are shuffled, so a passage that most documents
share costs one row for each few megabytes of input, and no group is larger than ``SPLIT[1]`` stretches. A different
stretch is brought to the arrays once, however many copies it has: as one row, in pieces as one for each ``PIECE``
distances, and beyond ``SPLIT[1]`` as one for each string.

Defined results: a null or empty text has no bytes; null ids come before others, documents of equal ids are ordered by
a hash of their text, and rows alike in id and text are one document whose result each gets; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow, row_key, stored
from vaultline.llm.components import bits_of, has_bit
from vaultline.llm.suffix_array import suffix_arrays

#: Fixed value: bytes of a string.
LENGTH = 100

GRAM = 32
ANCHOR_BITS = 27
DIFFER_BITS = 24
PLACE_BITS = 27
#: Different stretches of an anchor beyond which it is split, and beyond which each string is a piece.
SPLIT = (64, 4096)
#: Distances in a piece.
PIECE = 8
BATCH_SYMBOLS = 1_500_000
#: Bytes whose anchors are sought, and hashed, at a time.
BLOCK = 1 << 19

KEYS = ["d", "r"]


def keyed(docs: DataFrame) -> DataFrame:
    """Two longs that tell documents apart and put them in order, beside id and text."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    r = F.conv(F.hex(F.substring(row_key(), 1, 7)), 16, 10).cast("long")
    return documents(docs).select("doc_id", "text", d.alias("d"), r.alias("r"))


class Stretches:
    """The stretches of a chunk: first string's start, number of strings, anchor's hash, own hash, document. Anchors are
    found in one block after the other, each with the bytes of a string beyond it, so that only stretches are held for a
    whole chunk."""

    def __init__(self, chunk: T.Chunk, length: int):
        n, found = len(chunk.data), []
        for a in range(0, n, BLOCK):
            found.append(self._block(chunk, length, a, min(n, a + BLOCK)))
        start, count, owner, gram = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))
        # what a block's border cut belongs together
        new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + count[:-1])) if len(start) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.start, self.count = start[first], np.add.reduceat(count, first) if len(first) else count
        self.ahead = owner[first] - self.start  # the first string's distance to the anchor
        self.anchor = T.mix(gram[first].astype(np.uint64)).view(np.int64)
        self.own = T.mix(chunk.hashes(self.start, self.start + self.count + length - 1, BLOCK) + T.U64(1)).view(np.int64)
        self.doc = np.searchsorted(chunk.offsets, self.start, "right") - 1

    @staticmethod
    def _block(chunk: T.Chunk, length: int, a: int, b: int) -> tuple[np.ndarray, ...]:
        """Of the strings that start in a block, those of one anchor together: start, number, anchor's place and hash."""
        span = length - GRAM + 1
        docs = slice(max(0, int(np.searchsorted(chunk.offsets, a, "right")) - 1), int(np.searchsorted(chunk.offsets, b)))
        begin, end = chunk.offsets[:-1][docs], np.maximum(chunk.offsets[1:][docs] - length + 1, chunk.offsets[:-1][docs])
        valid = np.zeros(b - a + 1, np.int32)
        np.add.at(valid, np.clip(begin, a, b) - a, 1)
        np.add.at(valid, np.clip(end, a, b) - a, -1)
        at = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        if not len(at):
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
        data = chunk.data[a: min(len(chunk.data), b + length - 1)]
        grams = T.Chunk(data, np.array([0, len(data)])).gram_hashes(GRAM)
        least, width = (grams & T.U64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), 1
        while 2 * width <= span:  # the least of twice as many pieces each time
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width:])
        owner = (least[at] & T.U64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)))
        return a + at[first], np.diff(np.append(first, len(at))), a + owner[first], grams[owner[first]]


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Marks the first row of each combination of keys."""
    order = np.lexsort(keys[::-1])
    new = np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)) if len(order) else np.zeros(0, bool)
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def _in_order(chunk: T.Chunk, part: pa.RecordBatch, stretches: Stretches) -> np.ndarray:
    """The stretches' numbers by document order and start; of rows alike in id and text, the first's alone."""
    d, r = (part.column(k).slice(chunk.first, chunk.n).to_numpy() for k in KEYS)
    order = np.lexsort((stretches.start, r[stretches.doc], d[stretches.doc]))
    return order[_first_of(d, r)[stretches.doc[order]]]


def _batch(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def repeated_anchors(docs: DataFrame, length: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                anchors, times = np.unique(Stretches(chunk, length).anchor, return_counts=True)
                yield _batch(["h", "n"], anchors, times)

    return map_arrow(docs.select("text"), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")


def occurrences(docs: DataFrame, repeated: np.ndarray, length: int) -> DataFrame:
    """``anchor, own, d, r, start, count, later`` of the stretches whose anchor repeats; ``later`` if an equal one is
    known to be earlier, and need not be compared."""
    shared = docs.sparkSession.sparkContext.broadcast(repeated)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                s = Stretches(chunk, length)
                order = _in_order(chunk, part, s)
                order = order[has_bit(shared.value, s.anchor[order].view(np.uint64))]
                doc = s.doc[order]
                d, r = (part.column(k).slice(chunk.first, chunk.n).to_numpy()[doc] for k in KEYS)
                first = _first_of(s.anchor[order], s.own[order]) if len(order) else np.zeros(0, bool)
                yield _batch(["anchor", "own", "d", "r", "start", "count", "later"], s.anchor[order], s.own[order], d, r,
                             s.start[order] - chunk.offsets[doc], s.count[order].astype(np.int32), ~first)

    return map_arrow(docs.select("text", *KEYS), run, "anchor long, own long, d long, r long, start long, count int, later boolean")


def pieces(chunk: T.Chunk, s: Stretches, which: np.ndarray, step: int, length: int) -> tuple[np.ndarray, ...]:
    """The pieces of some stretches: key, own hash, start and size. A piece has the strings whose distances to the
    anchor, divided by ``step``, agree; its key, besides the anchor, is what all strings of such distances hold."""
    far, near = s.ahead[which], s.ahead[which] - s.count[which] + 1
    times = far // step - near // step + 1
    stretch = np.repeat(which, times)
    number = np.repeat(near // step, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    anchor_at = s.start[stretch] + s.ahead[stretch]
    first = np.minimum(np.repeat(far, times), (number + 1) * step - 1)
    last = np.maximum(np.repeat(near, times), number * step)
    start, size = anchor_at - first, first - last + length
    core = anchor_at - number * step
    shared = chunk.hashes(core, core + length - step + 1, BLOCK)
    key = T.mix(shared + s.anchor[stretch].view(np.uint64) + number.astype(np.uint64) * T.U64(0xD6E8FEB86659FD93))
    own = T.mix(chunk.hashes(start, start + size, BLOCK) + first.astype(np.uint64) + T.U64(2))
    return key.view(np.int64), own.view(np.int64), start, size


Marks = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def first_places(classes: DataFrame, differ: np.ndarray) -> DataFrame:
    """``h``, which tells ``_split`` where the first of equal stretches lies, for anchors whose stretches differ."""
    shared = classes.sparkSession.sparkContext.broadcast(differ)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield part.filter(pa.array(has_bit(shared.value, part.column("anchor").to_numpy().view(np.uint64)))).select(["h"])

    h = F.col("own").bitwiseXOR(F.col("first.r")).bitwiseXOR(F.col("first.start")).alias("h")
    return map_arrow(classes.select("anchor", h), run, "h long")


def _split(chunk: T.Chunk, part: pa.RecordBatch, marks: Marks, length: int) -> tuple[Stretches, np.ndarray, tuple[np.ndarray, ...]]:
    """A chunk's stretches, the numbers of those to be compared whole, and the pieces of the others."""
    differ, many, very, places = marks
    s = Stretches(chunk, length)
    order = _in_order(chunk, part, s)
    order = order[has_bit(differ, s.anchor[order].view(np.uint64))]
    doc = s.doc[order]
    r = part.column("r").slice(chunk.first, chunk.n).to_numpy()[doc]
    order = order[has_bit(places, (s.own[order] ^ r ^ (s.start[order] - chunk.offsets[doc])).view(np.uint64))]
    anchors = s.anchor[order].view(np.uint64)
    parted, single = has_bit(many, anchors), has_bit(very, anchors)
    found = [pieces(chunk, s, order[m], step, length) for m, step in ((parted & ~single, PIECE), (single, 1))]
    return s, order[~parted & ~single], tuple(np.concatenate(c) for c in zip(*found))


def stretch_bytes(docs: DataFrame, marks: Marks, length: int) -> DataFrame:
    """``key, own, d, r, start, size, bytes``: the first of equal stretches, of anchors that have different ones, whole
    with the anchor as key, or in pieces. Pieces that an equal one of the same chunk precedes have null for bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)
    names = ["key", "own", "d", "r", "start", "size", "bytes"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                s, whole, found = _split(chunk, part, shared.value, length)
                stretches = (s.anchor[whole], s.own[whole], s.start[whole], s.count[whole] + length - 1)
                key, own, start, size = (np.concatenate(x) for x in zip(stretches, found))
                if not len(key):
                    continue
                first = _first_of(key, own)
                again = np.flatnonzero(~first & (np.arange(len(key)) >= len(whole)))
                key[again] = T.mix((key[again] + start[again]).view(np.uint64)).view(np.int64)  # to any task
                use = np.append(np.flatnonzero(first), again)
                key, own, start, size = key[use], own[use], start[use], size[use]
                doc = np.searchsorted(chunk.offsets, start, "right") - 1
                d, r = (part.column(k).slice(chunk.first, chunk.n).to_numpy()[doc] for k in KEYS)
                data = chunk.data.tobytes()
                held = [data[a:b] for a, b in zip(start.tolist(), (start + size).tolist())]
                held = pa.array(held[: len(held) - len(again)] + [None] * len(again), pa.binary())
                yield _batch(names, key, own, d, r, start - chunk.offsets[doc], size.astype(np.int32), held)

    return map_arrow(docs.select("text", *KEYS), run, "key long, own long, d long, r long, start long, size int, bytes binary")


def earlier_strings(groups: list[list[tuple]], length: int) -> list[tuple[int, int, int, int]]:
    """For groups of stretches (d, r, start, bytes): the ranges (d, r, first byte, end) of the strings that an equal
    string of their group precedes."""
    flat = [row for g in groups for row in g]
    sizes = np.array([len(row[3]) + 1 for row in flat])  # a separator after each stretch
    per_group = np.array([len(g) for g in groups])
    stretch_at = np.concatenate([[0], np.cumsum(sizes)])
    group_end = np.concatenate([[0], np.cumsum(per_group)])
    data = np.frombuffer(b"\0".join(row[3] for row in flat) + b"\0", np.uint8)
    symbols = data.astype(np.int16) + 2
    symbols[stretch_at[1:] - 1] = 1
    ends = stretch_at[group_end[1:]]
    symbols[ends - 1] = 0
    order = suffix_arrays(symbols, np.concatenate([[0], ends]))
    stretch = np.repeat(np.arange(len(flat)), sizes)
    inside = np.arange(len(data)) - stretch_at[stretch]
    group = np.repeat(np.arange(len(groups)), per_group)
    # suffixes that begin a whole string; equal ones are next to each other
    order = order[inside[order] + length < sizes[stretch[order]]]
    if not len(order):
        return []
    same = np.zeros(len(order), bool)
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    for at in range(1, len(order), 65536):
        a, b = order[at - 1: at - 1 + 65536], order[at: at + 65536]
        a = a[: len(b)]
        same[at: at + len(b)] = (windows[a] == windows[b]).all(axis=1) & (group[stretch[a]] == group[stretch[b]])
    run = np.cumsum(~same)
    d, r, start = (np.array([row[k] for row in flat], np.int64) for k in range(3))
    rank = np.empty(len(flat), np.int64)
    by = np.lexsort((start, r, d))
    rank[by] = np.arange(len(flat))
    # documents in order, then starts within them
    new = np.append(True, (d[by][1:] != d[by][:-1]) | (r[by][1:] != r[by][:-1]))
    doc = np.empty(len(flat), np.int64)
    doc[by] = np.cumsum(new)
    where = np.lexsort((start[stretch[order]] + inside[order], doc[stretch[order]], run))
    later = np.append(False, run[where][1:] == run[where][:-1])
    removed = np.sort(order[where[later]])
    if not len(removed):
        return []
    cut = np.flatnonzero(np.append(True, removed[1:] != removed[:-1] + 1))
    first, last = removed[cut], removed[np.append(cut[1:], len(removed)) - 1]
    s = stretch[first]
    return list(zip(d[s].tolist(), r[s].tolist(), (start[s] + inside[first]).tolist(), (start[s] + inside[last] + length).tolist()))


def array_ranges(stretches: DataFrame, length: int) -> DataFrame:
    """Ranges removed by the suffix arrays, over stretches that are grouped and sorted by key."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[tuple]] = []
        key = own = None
        size, again = 0, []

        def flush() -> pa.RecordBatch:
            found = earlier_strings([g for g in groups if len(g) > 1], length) if any(len(g) > 1 for g in groups) else []
            found += again
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(4)], ["d", "r", "first", "end"])

        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in ("key", "own", "d", "r", "start", "bytes", "size"))):
                if row[5] is None:
                    again.append((row[2], row[3], row[4], row[4] + row[6]))
                    continue
                if row[0] != key:
                    if size > BATCH_SYMBOLS:
                        yield flush()
                        groups, size, again = [], 0, []
                    groups.append([])
                elif row[1] == own:  # equal to the one before, and not earlier
                    if row[2:5] != groups[-1][-1][:3]:
                        again.append((row[2], row[3], row[4], row[4] + row[6]))
                    continue
                key, own = row[:2]
                groups[-1].append(row[2:6])
                size += len(row[5]) + 1
        if groups or again:
            yield flush()

    dealt = stretches.repartition("key").sortWithinPartitions("key", "own", "d", "r", "start")
    return map_arrow(dealt, run, "d long, r long, first long, end long")


def removed_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``d, r, first, end``: byte ranges to be removed, which may overlap. ``docs`` as from ``keyed``."""
    repeated = bits_of(repeated_anchors(docs, length).select("h"), ANCHOR_BITS)
    found = stored(occurrences(docs, repeated, length), "occurrences")
    compared = found.where("not later")
    # the first of each stretch, by task before its shuffle; all others of the stretch are later
    place = F.struct("d", "r", "start")
    classes = stored(compared.groupBy("anchor", "own").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "first-stretches")
    first = classes.where("n > 1").select("anchor", "own", "first")
    again = compared.join(first, ["anchor", "own"]).where(place != F.col("first")).select("d", "r", "start", "count")
    copies = again.unionByName(found.where("later").select("d", "r", "start", "count"))
    copies = copies.select("d", "r", F.col("start").alias("first"), (F.col("start") + F.col("count") + (length - 1)).alias("end"))
    kinds = classes.groupBy(F.col("anchor").alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kinds = stored(kinds, "anchors")
    differ = bits_of(kinds.select("h"), DIFFER_BITS)
    many, very = (bits_of(kinds.where(F.col("n") > least).select("h"), DIFFER_BITS) for least in SPLIT)
    marks = (differ, many, very, bits_of(first_places(classes, differ), PLACE_BITS))
    return copies.unionByName(array_ranges(stretch_bytes(docs, marks, length), length))


def remove(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """One row per document: its bytes, those removed, their maximal runs, and the hash of what remains. Documents
    that a filter of fixed size knows to have no range are finished where they are; the others meet their ranges."""
    spans = stored(ranges.groupBy(*KEYS).agg(F.collect_list(F.struct("first", "end")).alias("spans")), "spans")
    h = F.xxhash64(*KEYS)
    shared = docs.sparkSession.sparkContext.broadcast(bits_of(spans.select(h.alias("h")), DIFFER_BITS))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def may_have(part: pa.RecordBatch) -> np.ndarray:
        return has_bit(shared.value, part.column("h").to_numpy().view(np.uint64))

    def touched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield part.filter(pa.array(may_have(part))).select(["doc_id", "text", *KEYS])

    def finish(ids: pa.Array, texts: pa.Array, spans: pa.Array | None) -> pa.RecordBatch:
        out = []
        for chunk in T.chunks(texts):
            for i in range(chunk.n):
                data = chunk.data[chunk.offsets[i]: chunk.offsets[i + 1]]
                rows = spans[chunk.first + i] if spans is not None else None
                if rows is None or not rows.is_valid:
                    out.append((len(data), 0, 0, hashlib.sha256(data.tobytes()).hexdigest()))
                    continue
                first, end = (rows.values.field(k).to_numpy() for k in (0, 1))
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, first, 1)
                np.add.at(change, end, -1)
                gone = np.cumsum(change[:-1]) > 0
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
        return _batch(names, ids, *[pa.array([x[k] for x in out], pa.int64()) for k in range(3)], pa.array([x[3] for x in out], pa.string()))

    def whole(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            part = part.filter(pa.array(~may_have(part)))
            yield finish(part.column("doc_id"), part.column("text"), None)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield finish(part.column("doc_id"), part.column("text"), part.column("spans"))

    hashed = docs.withColumn("h", h)
    some = map_arrow(hashed, touched, f"doc_id {kind}, text string, d long, r long").join(spans, KEYS, "left").select("doc_id", "text", "spans")
    return map_arrow(hashed, whole, schema).unionByName(map_arrow(some, cut, schema))


def substring_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    docs = keyed(docs)
    return remove(docs, removed_ranges(docs, length))
