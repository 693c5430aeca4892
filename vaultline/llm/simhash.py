"""SimHash near-dedup by the generalised pigeonhole.

A document's fingerprint has the bits that over half of its shingles' hashes have. Two fingerprints that differ in at
most ``distance`` bits are linked. With the 64 bits cut into m parts and a threshold per part, thresholds that add up
to ``distance - m + 1`` are enough: if two fingerprints differ in more bits than its threshold in every part, they
differ in more than ``distance``. A threshold of -1 leaves a part out.

1. Bits are put into four quarters so that bits which agree often lie together: the counts of joint bits over all
   fingerprints give their correlations. What is common is then common in one quarter, and the others tell more apart.
2. How many fingerprints have each quarter's values is counted. This gives every fingerprint an estimate, per part and
   threshold, of its candidates. Dynamic programming over the parts takes the thresholds of least cost, for each
   fingerprint by itself: a part with a value that many share is left out where another part can be probed wider.
   The cuttings of ``LAYOUTS`` join quarters to wider parts; the one of least total cost is used.
3. Every fingerprint is listed under its own value of each part, and probes the values within its threshold. Those
   that meet are compared; only links that join components of one bucket are passed on, never all pairs. A bucket of
   more than ``UNIT`` entries is cut into blocks, and its units are the pairs of blocks.

Equal fingerprints are one vertex, so copies cost nothing after the first step. The estimates decide what is probed,
never what is found. What comes to the driver has a fixed size: 64 x 64 joint counts and 4 x 65,536 value counts.

Defined results: a null or empty text, or one of white space alone, has fingerprint zero and is linked like any other;
a text of fewer words than a shingle is one shingle; texts are read whole, in blocks of ``BLOCK`` shingles; repeated
rows each get their row; a component's id is its smallest id that isn't null (null if all are), and ties do not arise;
further columns are not looked at, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow, stored
from vaultline.llm.components import components

#: Words in a shingle, seed of its XXH64, bits in which linked fingerprints may differ.
SHINGLE = 3
SEED = 42
DISTANCE = 3

QUARTERS, WIDTH = 4, 16
#: Parts as unions of quarters.
LAYOUTS = (((0,), (1,), (2,), (3,)), ((0, 1), (2,), (3,)), ((0, 1), (2, 3)))
#: What a probe costs, in comparisons.
PROBE = 16
BLOCK = 1 << 17
UNIT = 4096
SMALL = 64
PAIRS = 1 << 21


def shingle_hashes(chunk: T.Chunk, words: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of a lower-cased chunk's shingle hashes, each with its document's number; documents in order."""
    starts, ends, first = chunk.runs(T.NON_SPACE)
    if not len(starts):
        return
    sizes = ends - starts
    joined = np.full(int(sizes.sum()) + len(sizes), 0x20, np.uint8)  # words with one space after each
    word = np.repeat(np.arange(len(sizes)), sizes)
    joined[np.arange(len(word)) + word] = chunk.data[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(word))]
    at = np.cumsum(sizes + 1) - sizes - 1
    per_doc = np.diff(first)
    shingles = np.where(per_doc >= words, per_doc - words + 1, np.minimum(per_doc, 1))
    doc = np.repeat(np.arange(chunk.n), shingles)
    begin = np.repeat(first[:-1], shingles) + np.arange(len(doc)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    last = begin + np.minimum(words, per_doc[doc]) - 1
    begin, end, data, digest = at[begin], at[last] + sizes[last], joined.tobytes(), xxhash.xxh64_intdigest
    for k in range(0, len(doc), BLOCK):
        a, b = begin[k: k + BLOCK].tolist(), end[k: k + BLOCK].tolist()
        yield np.fromiter((digest(data[x:y], SEED) for x, y in zip(a, b)), np.uint64, len(a)), doc[k: k + BLOCK]


def bits_of_values(values: np.ndarray) -> np.ndarray:
    """A row of 64 bits per value, the lowest first."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def chunk_fingerprints(chunk: T.Chunk, words: int = SHINGLE) -> np.ndarray:
    votes, total = np.zeros((chunk.n, 64), np.int64), np.zeros(chunk.n, np.int64)
    for hashes, doc in shingle_hashes(chunk.lower(), words):
        cut = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        votes[doc[cut]] += np.add.reduceat(bits_of_values(hashes), cut, axis=0, dtype=np.int64)
        total[doc[cut]] += np.diff(np.append(cut, len(doc)))
    return np.ascontiguousarray(np.packbits(2 * votes > total[:, None], axis=1, bitorder="little")).view("<u8").ravel()


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every document, ``fp`` as a signed long."""
    docs = documents(docs)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                found = pa.array(chunk_fingerprints(chunk, words).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").slice(chunk.first, chunk.n), found], ["doc_id", "fp"])

    return map_arrow(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def correlated_quarters(joint: np.ndarray, n: int) -> np.ndarray:
    """The 64 bits in the order of their quarters, from counts of joint bits: each quarter begins with the open bit
    that is most correlated with the other open ones and takes those most correlated with what it has."""
    p = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs(joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    is_open, order = np.ones(64, bool), []
    for _ in range(QUARTERS):
        score = np.where(is_open, strength[:, is_open].sum(1), -1)
        for k in range(WIDTH):
            bit = int(np.argmax(score))
            order.append(bit)
            is_open[bit] = False
            score = np.where(is_open, strength[bit] + (score if k else 0), -1)
    return np.array(order)


def quarter_values(fps: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Each fingerprint's four 16-bit values."""
    bits = bits_of_values(fps)[:, order]
    return np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view("<u2").astype(np.int64)


class Costs:
    """Estimated candidates of the parts, from the counts of the quarters' values."""

    def __init__(self, counts: np.ndarray, distance: int):
        self.n, self.distance = max(1.0, float(counts[0].sum())), distance
        index, near = np.arange(1 << WIDTH), np.zeros((QUARTERS, distance + 1, 1 << WIDTH))
        near[:, 0] = counts
        for bit in range(WIDTH):  # values that differ in exactly t bits
            for t in range(distance, 0, -1):
                near[:, t] += near[:, t - 1][:, index ^ (1 << bit)]
        self.share = (near / self.n).astype(np.float32)

    def of_part(self, part: tuple[int, ...], values: np.ndarray) -> np.ndarray:
        """The cost of each threshold from -1 on, by fingerprint."""
        exact = [self.share[part[0], t][values[:, part[0]]] for t in range(self.distance + 1)]
        for q in part[1:]:
            other = [self.share[q, t][values[:, q]] for t in range(self.distance + 1)]
            exact = [sum(exact[s] * other[t - s] for s in range(t + 1)) for t in range(self.distance + 1)]
        within, width = np.cumsum(exact, axis=0) * self.n, WIDTH * len(part)
        probes = [sum(comb(width, s) for s in range(t + 1)) for t in range(self.distance + 1)]
        return np.stack([np.zeros(len(values)), *(PROBE * probes[t] + within[t] for t in range(self.distance + 1))])

    def thresholds(self, layout: tuple, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By fingerprint, the thresholds of the parts that cost least, and their cost."""
        m, n = len(layout), len(values)
        goal = self.distance + 1  # thresholds plus one, summed
        best, picks = np.full((goal + 1, n), np.inf), []
        best[0] = 0
        for part in layout:
            cost = self.of_part(part, values)
            totals = np.full((goal + 1, goal + 1, n), np.inf)  # by sum and by this part's share of it
            for s in range(goal + 1):
                for t in range(s + 1):
                    totals[s, t] = best[s - t] + cost[t]
            picks.append(totals.argmin(1))
            best = totals.min(1)
        out, left, at = np.zeros((n, m), np.int64), np.full(n, goal), np.arange(n)
        for i in reversed(range(m)):
            taken = picks[i][left, at]
            out[:, i], left = taken - 1, left - taken
        return out, best[goal]


@lru_cache(64)
def flips(width: int, t: int) -> np.ndarray:
    """All masks of 1 to ``t`` of ``width`` bits."""
    return np.array([sum(1 << b for b in bits) for k in range(1, t + 1) for bits in combinations(range(width), k)], np.int64)


def part_keys(layout: tuple, values: np.ndarray) -> np.ndarray:
    """The fingerprints' values of each part, with the part's number above them."""
    keys = [sum(values[:, q] << (WIDTH * k) for k, q in enumerate(part)) + (i << 2 * WIDTH) for i, part in enumerate(layout)]
    return np.stack(keys, axis=1)


#: Roles in a bucket: listed only, listed and probing, probing only.
LISTED, BOTH, PROBING = 0, 1, 2


def bucket_rows(fps: np.ndarray, layout: tuple, order: np.ndarray, costs: Costs) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``key, fp, role`` of all entries of some fingerprints."""
    values = quarter_values(fps, order)
    keys, (limits, _) = part_keys(layout, values), costs.thresholds(layout, values)
    for i, part in enumerate(layout):
        yield keys[:, i], fps, np.where(limits[:, i] >= 0, BOTH, LISTED)
        for t in range(1, costs.distance + 1):
            rows = np.flatnonzero(limits[:, i] == t)
            masks = flips(WIDTH * len(part), t) if len(rows) else np.zeros(0, np.int64)
            step = max(1, PAIRS // max(1, len(masks)))
            for k in range(0, len(rows), step):
                some = rows[k: k + step]
                yield (keys[some, i][:, None] ^ masks).ravel(), np.repeat(fps[some], len(masks)), np.full(len(some) * len(masks), PROBING)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same components as ``a, b``, one fewer than their vertices each."""
    vertices, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, label = ends[: len(a)], ends[len(a):], np.arange(len(vertices))
    while True:
        least, before = np.minimum(label[x], label[y]), label.copy()
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        label = label[label]
        if (label == before).all():
            break
    joined = np.flatnonzero(label != np.arange(len(label)))
    return vertices[label[joined]], vertices[joined]


def bucket_links(group: np.ndarray, fps: np.ndarray, role: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of entries that lie together by group (sorted), as forests."""

    def near(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (role[i] != LISTED) & (role[j] != PROBING) & (fps[i] != fps[j]) & (np.bitwise_count(fps[i] ^ fps[j]) <= distance)
        return forest(*(fps[np.broadcast_to(k, ok.shape)[ok]] for k in (i, j)))

    head = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    size = np.diff(np.append(head, len(group)))
    small = np.flatnonzero((size > 1) & (size <= SMALL))
    ends = np.cumsum(size[small] ** 2)
    for k in np.split(small, np.searchsorted(ends, np.arange(PAIRS, ends[-1] if len(ends) else 0, PAIRS))):
        squares = size[k] ** 2
        inside = np.arange(int(squares.sum())) - np.repeat(np.cumsum(squares) - squares, squares)
        first, width = np.repeat(head[k], squares), np.repeat(size[k], squares)
        yield near(first + inside // width, first + inside % width)
    for k in np.flatnonzero(size > SMALL).tolist():
        members, step = np.arange(head[k], head[k] + size[k]), max(1, PAIRS // int(size[k]))
        for at in range(0, len(members), step):
            yield near(members[at: at + step, None], members[None, :])


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links that join all components of the distinct fingerprints ``fp``."""
    context = distinct.sparkSession.sparkContext
    only = distinct.select("fp")

    def joint(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for part in parts:
            bits = bits_of_values(part.column("fp").to_numpy().view(np.uint64)).astype(np.float32)
            for k in range(0, len(bits), BLOCK):
                total += bits[k: k + BLOCK].T @ bits[k: k + BLOCK]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel().astype(np.int64))], ["at", "n"])

    counted = map_arrow(only, joint, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(4096)
    matrix[counted["at"].to_numpy()] = counted["n"].to_numpy()
    order = correlated_quarters(matrix.reshape(64, 64), distinct.count())

    def tally(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(QUARTERS << WIDTH, np.int64)
        for part in parts:
            values = quarter_values(part.column("fp").to_numpy().view(np.uint64), order) + (np.arange(QUARTERS) << WIDTH)
            total += np.bincount(values.ravel(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    counted = map_arrow(only, tally, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(QUARTERS << WIDTH)
    counts[counted["at"].to_numpy()] = counted["n"].to_numpy()
    costs = context.broadcast(Costs(counts.reshape(QUARTERS, -1), distance))

    def price(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(LAYOUTS))
        for part in parts:
            values = quarter_values(part.column("fp").to_numpy().view(np.uint64), order)
            total += [costs.value.thresholds(layout, values)[1].sum() for layout in LAYOUTS]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(LAYOUTS))), pa.array(total)], ["layout", "cost"])

    prices = map_arrow(only, price, "layout long, cost double").groupBy("layout").agg(F.sum("cost").alias("cost")).collect()
    layout = LAYOUTS[min(prices, key=lambda r: (r.cost, r.layout)).layout if prices else 0]

    def entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for key, fps, role in bucket_rows(part.column("fp").to_numpy().view(np.uint64), layout, order, costs.value):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps.view(np.int64)), pa.array(role.astype(np.int8))], ["key", "fp", "role"])

    listed = map_arrow(only, entries, "key long, fp long, role byte")
    hot = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > UNIT)
    hot = stored(hot.select("key", F.ceil(F.col("n") / UNIT).alias("blocks")), "hot-buckets")
    cut = listed.join(hot, "key", "left").withColumn("block", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    units = cut.select("key", "fp", "role", "block", other.alias("other")).select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "fp", "role")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "low", "high", "fp", "role"]
        held = [np.zeros(0, np.int64) for _ in names]

        def found(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(rows[0]):
                group = np.cumsum(np.append(True, np.any([c[1:] != c[:-1] for c in rows[:3]], axis=0)))
                for a, b in bucket_links(group, rows[3].view(np.uint64), rows[4], distance):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for part in parts:
            held = [np.concatenate([old, part.column(c).to_numpy().astype(np.int64)]) for old, c in zip(held, names)]
            if not len(held[0]):
                continue
            same = np.all([c == c[-1] for c in held[:3]], axis=0)
            whole = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # the last group may go on
            yield from found([c[:whole] for c in held])
            held = [c[whole:] for c in held]
        yield from found(held)

    dealt = units.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return map_arrow(dealt, compare, "a long, b long")


def simhash_dedup(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: its fingerprint in hex and its component's smallest id."""
    held = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(held.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    joined = stored(links(distinct, distance), "links")
    labels = components(joined).select(F.col("v").alias("fp"), "label")
    placed = stored(distinct.join(labels, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label")), "placed")
    least = stored(placed.groupBy("label").agg(F.min("least").alias("component_id")), "least")
    placed = stored(placed.join(least, "label").select("fp", "component_id"), "placed")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return held.join(placed, "fp").select("doc_id", digits, "component_id")
