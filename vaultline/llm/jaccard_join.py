"""N-gram Jaccard join through a token-group matrix.

A document's set holds the hashes of its distinct shingles; documents of equal sets are one class. Two kinds of marks
bring the classes together that can be linked:

* Parts, for sets of ``parts_from`` tokens or more. Linked sets differ in a bounded number of tokens. Tokens are dealt
  to a few more parts than that by their hash, so at least one part holds the same tokens in both. (Sizes are cut into
  bands that fix the number of parts; a class also enters the band below where it can have a partner there. A class
  with more empty parts than the spare ones lists these too, others need not.) A part of several tokens is seldom
  shared by chance, as single three-word shingles are.
* Prefixes, for pairs whose smaller set is smaller than that: in any one order of all tokens, linked sets share one of
  their first tokens, as many as they can differ in and one more. Tokens that several documents of one batch hold come
  last, so that a passage which many documents share brings no two of them together. The order decides what is
  compared, never what is found.

The classes that share marks with the same smallest class form its group. Every class has the counts of its tokens by
bins, a byte for each few tokens that bound what two sets can have in common; only what these do not rule out gets its
tokens. Large sets have more bins, as with a fixed number any two sets of some thousand tokens would look alike.
Each member is first compared with the group's smallest class. Members that aren't in one component with it are queries: the group is cut into groups of similar members, for
each of which the union of tokens is kept, as rows of a matrix of tokens by members. A query's overlap with the union
bounds its overlap with any member, and only groups that reach what the query needs are opened; members already in the
query's component are passed over. No link between components is lost, and no pairs are emitted but links that join
components.

Filters that decide what needs to be shuffled have a fixed number of bits. A hot mark costs one row a task before its
counting, and the join back to it is an ordinary one that can be split; a large group is cut into units of bounded
size, queries by members.

Defined results: a null or empty text has no shingles and is its own component; a text of fewer than three words is one
shingle; repeated rows are in one class; a component's id is its smallest id that isn't null (null if all are); an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import delete, documents, drop, map_arrow, row_key, shared_folder, shuffles_freed, stored
from vaultline.llm.components import bits_of, components, has_bit

#: Words in a shingle, and similarity in percent.
SHINGLE = 3
PERCENT = 90

BAND = 1.5
MARK_BITS, MOST_MARK_BITS = 26, 28
PARTS_FROM = 60
COMMON = 3
CLASS_BITS = 27
GROUP = 32
UNIT = 1024
BINS, PER_BIN, FULL_BIN = 256, 8, 255


def shingle_sets(chunk: T.Chunk, n: int = SHINGLE) -> list[np.ndarray]:
    """Each document's sorted distinct shingle hashes."""
    chunk = chunk.lower()
    starts, ends, first = chunk.runs(T.NON_SPACE)
    words = chunk.hashes(starts, ends)
    grams, at = T.ngram_hashes(words, n), first.tolist()
    out = []
    for a, b in zip(at, at[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a: b - n + 1]))
        else:
            out.append(T.mix(T.ngram_hashes(words[a:b], b - a) + T.U64(b - a)) if b > a else np.zeros(0, T.U64))
    return out


def class_of(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def edges_of_bands(parts_from: int, most: int) -> list[int]:
    """Smallest sizes of the bands."""
    out = [parts_from]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


@lru_cache(4096)
def number_of_parts(least: int, most: int, percent: int) -> tuple[int, int]:
    """For a band of set sizes: one part more than two linked sets can differ in, and spare parts for those that stay
    empty, a few deviations more than are expected; the sum, and the spare ones."""
    needed, spare = most * (100 - percent) // percent + 1, 2
    for _ in range(20):
        n = needed + spare
        empty = n * math.exp(-least / n)
        spare = max(spare, math.ceil(empty + 4 * math.sqrt(empty)) + 1)
    return needed + spare, spare


def parts_of(tokens: np.ndarray, percent: int = PERCENT, parts_from: int = PARTS_FROM) -> np.ndarray:
    """Hashes of the parts of one set, for all bands that it belongs to."""
    size = len(tokens)
    edges = edges_of_bands(parts_from, size)
    band = int(np.searchsorted(edges, size, "right")) - 1
    out = []
    for b in (band, band - 1):
        if b < 0 or (b < band and percent * size > 100 * (edges[b + 1] - 1)):
            continue
        n, spare = number_of_parts(edges[b], edges[b + 1] - 1, percent)
        scrambled = T.mix(tokens + T.U64(b + 1))
        part = ((scrambled >> T.U64(33)) % T.U64(n)).astype(np.int64)
        sums, filled = np.zeros(n, T.U64), np.zeros(n, bool)
        np.add.at(sums, part, scrambled)
        filled[part] = True
        hashes = T.mix(sums * T.U64(0x9E3779B97F4A7C15) + np.arange(n).astype(np.uint64) * T.U64(2654435761) + T.U64((b + 1) << 40))
        out.append(hashes if n - filled.sum() > spare else hashes[filled])
    return np.concatenate(out) if out else np.zeros(0, T.U64)


def prefix_of(tokens: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The first tokens of a set, by hash, those with a bit in ``common`` last."""
    n = len(tokens) - -(-percent * len(tokens) // 100) + 1
    return tokens[np.lexsort((tokens, has_bit(common, tokens)))[:n]]


def in_prefixes(size: int, percent: int, parts_from: int | None) -> bool:
    """Whether a set can have a partner of which the smaller one is below ``parts_from``."""
    return parts_from is None or percent * size < 100 * parts_from


def marks_of(tokens: np.ndarray, common: np.ndarray, percent: int, parts_from: int | None) -> np.ndarray:
    prefix = T.mix(prefix_of(tokens, common, percent)) if in_prefixes(len(tokens), percent, parts_from) else np.zeros(0, T.U64)
    parts = parts_of(tokens, percent, parts_from) if parts_from and len(tokens) >= parts_from else np.zeros(0, T.U64)
    return np.concatenate([prefix, parts])


def common_tokens(texts: DataFrame, n: int, percent: int, parts_from: int | None) -> np.ndarray:
    """A filter of the tokens that ``COMMON`` classes or more of one batch hold, over all batches."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sets = [s for _, s in dict(_by_class(part, n)).items() if in_prefixes(len(s), percent, parts_from)]
            if sets:
                tokens, times = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[times >= COMMON].view(np.int64))], ["h"])

    return bits_of(map_arrow(texts, run, "h long"), MARK_BITS)


def _by_class(part: pa.RecordBatch, n: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """The distinct classes of each chunk, with their sets; not the empty one."""
    for chunk in T.chunks(part.column("text")):
        sets = {class_of(s): s for s in shingle_sets(chunk, n) if len(s)}
        yield from sets.items()


def _binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def classes(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``doc_id, row, n_shingles, class`` of every document; the class is null for an empty set."""
    docs = documents(docs).withColumn("row", row_key())
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row binary, n_shingles long, class binary"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                sets = shingle_sets(chunk, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(chunk.first, chunk.n), part.column("row").slice(chunk.first, chunk.n), pa.array([len(s) for s in sets], pa.int64()),
                     _binary([class_of(s) if len(s) else None for s in sets])], ["doc_id", "row", "n_shingles", "class"]
                )

    return map_arrow(docs, run, schema)


def candidate_stars(
    docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, parts_from: int | None = PARTS_FROM
) -> tuple[DataFrame, DataFrame]:
    """``a, b, na, nb``: each class with the smallest class of every mark that it shares with another, and set sizes;
    and what is stored of all classes, with ``class, bins``, repeated where documents are copies."""
    texts, context = documents(docs).select("text"), docs.sparkSession.sparkContext
    common = context.broadcast(common_tokens(texts, n, percent, parts_from))

    def mark(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            names, sizes, found, bins = [], [], [], []
            for name, s in _by_class(part, n):
                names.append(name)
                sizes.append(len(s))
                found.append(marks_of(s, common.value, percent, parts_from))
                bins.append(bins_of_set(s))
            if names:
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                marks = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))
                yield pa.RecordBatch.from_arrays([_binary(names), pa.array(sizes, pa.int32()), marks, _binary(bins)], ["class", "n", "marks", "bins"])

    marked = stored(map_arrow(texts, mark, "class binary, n int, marks array<long>, bins binary"), "marks")
    shared = stored(marked.select(F.explode("marks").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "shared-marks")
    repeated = context.broadcast(bits_of(shared, min(MOST_MARK_BITS, max(MARK_BITS, (16 * shared.count()).bit_length()))))
    drop(shared)

    def members(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            marks = part.column("marks")
            h = marks.flatten()
            use = has_bit(repeated.value, h.to_numpy().view(np.uint64))
            row = np.repeat(np.arange(len(part)), marks.value_lengths().to_numpy())[use]
            yield pa.RecordBatch.from_arrays([h.filter(pa.array(use)), part.column("class").take(pa.array(row)), part.column("n").take(pa.array(row))], ["h", "class", "n"])

    held = stored(map_arrow(marked.select("class", "n", "marks"), members, "h long, class binary, n int"), "mark-members")
    leaders = held.groupBy("h").agg(F.min(F.struct("class", "n")).alias("least"), F.max("class").alias("z")).where("least.class <> z")
    leaders = leaders.select("h", F.col("least.class").alias("a"), F.col("least.n").alias("na"))
    stars = held.join(leaders, "h").where("class <> a").select("a", F.col("class").alias("b"), "na", F.col("n").alias("nb")).distinct()
    found = stored(stars, "stars")
    drop(held)
    return found, marked


def comparable(stars: DataFrame, percent: int) -> DataFrame:
    """``c``: the classes that have another of a size within reach in one of their groups: one of the same size, or else
    the next larger or the next smaller size if any is. A group's sizes are counted first, so what is put in order is
    its distinct sizes and not its members."""
    members = stars.select("a", F.col("b").alias("c"), F.col("nb").alias("n")).unionByName(stars.select("a", F.col("a").alias("c"), F.col("na").alias("n")).distinct())
    sizes = members.groupBy("a", "n").agg(F.count(F.lit(1)).alias("times"))
    by_size = Window.partitionBy("a").orderBy("n")
    near = (F.col("times") > 1) | (100 * F.lag("n").over(by_size) >= percent * F.col("n")) | (100 * F.col("n") >= percent * F.lead("n").over(by_size))
    reached = stored(sizes.withColumn("near", near).where("near").select("a", "n"), "near-sizes")
    return members.join(reached, ["a", "n"], "left_semi").select("c").distinct()


@contextmanager
def bucketed(sets: DataFrame) -> Iterator[DataFrame]:
    """The sets stored by class, so that no join on it moves them again. They go, with their catalog entry, when the block
    ends."""
    spark = sets.sparkSession
    name, path = f"vaultline_sets_{uuid.uuid4().hex}", shared_folder(spark, "sets")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sets.repartition(n, "class").dropDuplicates(["class"])
    dealt.write.bucketBy(n, "class").sortBy("class").option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"drop table if exists {name}")
        delete(spark, path)


def sets_of(docs: DataFrame, wanted: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``class, tokens`` of the wanted classes ``c`` and some others, which a filter of a size set by their number lets
    through."""
    first = F.conv(F.hex(F.substring("c", 1, 7)), 16, 10).cast("long").alias("h")
    log_bits = min(CLASS_BITS, max(16, int(64 * wanted.count()).bit_length()))
    filter_ = docs.sparkSession.sparkContext.broadcast(bits_of(wanted.select(first), log_bits))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_.value
        for part in parts:
            names, sets = [], []
            for name, s in _by_class(part, n):
                if has_bit(bits, np.array([int.from_bytes(name[:7], "big")], np.uint64))[0]:
                    names.append(name)
                    sets.append(s)
            if names:
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [_binary(names), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))], ["class", "tokens"]
                )

    return map_arrow(documents(docs).select("text"), run, "class binary, tokens array<long>")


def number_of_bins(size: int) -> int:
    """For a set of some size: a power of two, so that the bins of a larger set can be added up to those of a smaller."""
    return max(BINS, 1 << (-(-size // PER_BIN) - 1).bit_length())


def bins_of_set(tokens: np.ndarray) -> bytes:
    """How many tokens of a set fall into each of its bins, a byte each."""
    n = number_of_bins(len(tokens))
    counts = np.bincount((T.mix(tokens) >> T.U64(32)).astype(np.int64) % n, minlength=n)
    return np.minimum(counts, FULL_BIN).astype(np.uint8).tobytes()


def linked(common: F.Column, left: F.Column, right: F.Column, percent: int) -> F.Column:
    return 100 * common >= percent * (left + right - common)


def counts_of(bins: list[bytes], n: int) -> np.ndarray:
    """A row of ``n`` bins for each set, of which none has less."""
    counts = np.frombuffer(b"".join(bins), np.uint8)
    full = counts == FULL_BIN
    counts = np.where(full, np.int64(1 << 40), counts) if full.any() else counts.astype(np.int32)  # a full bin bounds nothing
    if len(counts) == n * len(bins):
        return counts.reshape(-1, n)
    ends = np.cumsum([len(x) for x in bins]).tolist()
    return np.array([counts[a:b].reshape(-1, n).sum(0) for a, b in zip([0, *ends], ends)])


def at_a_time(n: int) -> int:
    """Sets of which the counts by ``n`` bins are held at once."""
    return max(1, UNIT * BINS // n)


def common_at_most(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """For sets side by side, the sum of their bins' smaller counts."""
    out = np.zeros(len(left), np.int64)
    widths = np.array([min(len(a), len(b)) for a, b in zip(left, right)])
    for n in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == n)
        for at in range(0, len(rows), at_a_time(n)):
            some = rows[at: at + at_a_time(n)]
            out[some] = np.minimum(counts_of([left[i] for i in some], n), counts_of([right[i] for i in some], n)).sum(1)
    return out


def possible_stars(stars: DataFrame, bins: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs of ``stars`` that neither sizes nor the counts by bins rule out: two sets have at most the sum of their
    bins' smaller counts in common."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, len(part), UNIT):
                some = part.slice(at, UNIT)
                common = common_at_most(some.column("bins_a").to_pylist(), some.column("bins_b").to_pylist())
                sizes = some.column("na").to_numpy().astype(np.int64) + some.column("nb").to_numpy()
                yield some.select(["a", "b", "na", "nb"]).filter(pa.array((100 + percent) * common >= percent * sizes))

    within = stars.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    met = within.join(bins.select(F.col("class").alias("a"), F.col("bins").alias("bins_a")), "a").join(bins.select(F.col("class").alias("b"), F.col("bins").alias("bins_b")), "b")
    return map_arrow(met, run, "a binary, b binary, na int, nb int")


def compare_stars(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The linked ones of some pairs."""
    a = sets.select(F.col("class").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("class").alias("b"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(a, "a").join(b, "b").where(linked(common, F.col("na"), F.col("nb"), percent)).select("a", "b")


class Matrix:
    """One group's tokens by members."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        self.union, at = np.unique(flat, return_inverse=True)
        self.cells = np.zeros((len(self.union), len(sets)), np.uint8)
        self.cells[at, np.repeat(np.arange(len(sets)), [len(s) for s in sets])] = 1
        self.sizes = np.array([len(s) for s in sets])

    def open(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members that reach the similarity; the group is opened only if its union has what the query needs."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if 100 * len(at) < percent * len(query):
            return np.zeros(0, np.int64)
        common = self.cells[at].sum(0, dtype=np.int64)
        return np.flatnonzero(100 * common >= percent * (len(query) + self.sizes - common))


def unit_links(queries: list[tuple], members: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join components, of queries with members, both as (class, component, tokens)."""
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    out = []
    members = sorted(members, key=lambda m: (m[1], int(m[2][0]), m[0]))
    for at in range(0, len(members), GROUP):
        group = members[at: at + GROUP]
        matrix = Matrix([m[2] for m in group])
        for name, component, tokens in queries:
            mine = find(component)
            if all(find(m[1]) == mine for m in group):
                continue
            for k in matrix.open(tokens, percent).tolist():
                other = find(group[k][1])
                if other != mine:
                    out.append((name, group[k][0]))
                    root[other] = mine
    return out


def within_bounds(queries: list[tuple], members: list[tuple], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which queries, and which members, may have a link with another component's, both as (class, component, size,
    bins). What a query has in common with any of a group is bounded by the greatest counts of the group's bins; only
    groups that can reach what the query needs are opened."""

    order = sorted(range(len(members)), key=lambda i: (members[i][1], members[i][2], members[i][0]))
    members = [members[i] for i in order]
    q_use, m_use = np.zeros(len(queries), bool), np.zeros(len(members), bool)
    if len(queries) and len(members):
        names = {c: i for i, c in enumerate({r[1] for r in queries} | {r[1] for r in members})}
        (q_of, q_size), (m_of, m_size) = ((np.array([names[r[1]] for r in rows]), np.array([r[2] for r in rows], np.int64)) for rows in (queries, members))
        q_width = np.array([len(r[3]) for r in queries])
        for at in range(0, len(members), GROUP):
            some = slice(at, at + GROUP)
            bins = [r[3] for r in members[some]]
            least, most = int(m_size[some].min()), int(m_size[some].max())
            narrowest, widest = min(map(len, bins)), max(map(len, bins))
            # the least that a query of some size has to share with any member: what the smallest one asks for
            fits = (100 * q_size >= percent * least) & (100 * most >= percent * q_size)
            fits &= (q_of[:, None] != m_of[None, some]).any(1)
            needed = percent * (q_size + np.maximum(least, percent * q_size // 100))
            for n in np.unique(np.minimum(q_width[fits], narrowest)).tolist():
                counts = counts_of(bins, n)
                union = counts.max(0)
                rows = np.flatnonzero(fits & (np.minimum(q_width, narrowest) == n))
                for first in range(0, len(rows), at_a_time(n)):
                    part = rows[first: first + at_a_time(n)]
                    q_counts = counts_of([queries[q][3] for q in part], n)
                    for i in np.flatnonzero((100 + percent) * np.minimum(q_counts, union).sum(1) >= needed[part]).tolist():
                        q = part[i]
                        near = (m_of[some] != q_of[q]) & (100 * m_size[some] >= percent * q_size[q]) & (100 * q_size[q] >= percent * m_size[some])
                        near &= (100 + percent) * np.minimum(q_counts[i], counts).sum(1) >= percent * (q_size[q] + m_size[some])
                        if n < min(q_width[q], widest) and near.any():
                            k = np.flatnonzero(near)
                            near[k] = (100 + percent) * common_at_most([queries[q][3]] * len(k), [bins[x] for x in k]) >= percent * (q_size[q] + m_size[some][k])
                        if near.any():
                            q_use[q] = True
                            m_use[some] |= near
    out = np.zeros(len(members), bool)
    out[order] = m_use
    return q_use, out


def compare_groups(
    docs: DataFrame, stars: DataFrame, bins: DataFrame, labels: DataFrame, n: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Links ``a, b`` between components within groups; queries are the members in another component than their
    group's smallest class.

    Rows first carry the counts of their tokens by bins, a few hundred bytes. Only queries and members that these cannot
    tell apart get their tokens, for the matrix of tokens by members.
    """
    label_a = labels.select(F.col("v").alias("a"), F.col("label").alias("la"))
    label_b = labels.select(F.col("v").alias("b"), F.col("label").alias("lb"))
    marked = stars.join(label_a, "a", "left").join(label_b, "b", "left").select(
        "a", "b", F.col("nb").alias("n"), F.coalesce("lb", "b").alias("component"), (F.coalesce("la", "a") != F.coalesce("lb", "b")).alias("query")
    )
    marked = stored(marked, "marked")
    sized = marked.groupBy("a").agg(F.count(F.lit(1)).alias("rows"), F.count_if("query").alias("q")).where("q > 0 and rows > 1")
    sized = sized.select("a", F.ceil(F.col("rows") / UNIT).cast("int").alias("blocks"), F.ceil(F.col("q") / UNIT).cast("int").alias("query_blocks"))
    rows = marked.join(stored(sized, "group-sizes"), "a")
    spread = F.pmod(F.xxhash64("b"), F.col("blocks").cast("long")).cast("int")
    query_spread = F.pmod(F.xxhash64("b"), F.col("query_blocks").cast("long")).cast("int")
    is_query = F.col("query") & (F.col("query_block") == query_spread)
    as_member = rows.withColumn("block", spread).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    as_member = as_member.withColumn("query", is_query).withColumn("member", F.lit(True))
    as_query = rows.where("query").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(F.col("block") != spread)
    as_query = as_query.withColumn("query_block", query_spread).withColumn("member", F.lit(False))
    unit = ["a", "block", "query_block"]
    names = [*unit, "b", "component", "query", "member"]  # a class is once in a unit, whatever it is there
    units = as_member.select(*names, "n").unionByName(as_query.select(*names, "n")).join(bins.select(F.col("class").alias("b"), "bins"), "b")

    def bound(rows: pa.Table) -> pa.Table:
        roles = [rows.column(c).to_numpy() for c in ("query", "member")]
        at = [np.flatnonzero(r) for r in roles]
        sides = [list(zip(*(rows.column(c).take(pa.array(k)).to_pylist() for c in ("b", "component", "n", "bins")))) for k in at]
        used = [np.zeros(len(rows), bool), np.zeros(len(rows), bool)]
        for side, k, use in zip(used, at, within_bounds(*sides, percent)):
            side[k] = use
        out = rows.select(names[:-2]).append_column("query", pa.array(used[0])).append_column("member", pa.array(used[1]))
        return out.filter(pa.array(used[0] | used[1]))

    def run(rows: pa.Table) -> pa.Table:
        queries, members = [], []
        for name, component, query, member, tokens in zip(*(rows.column(c).to_pylist() for c in ("b", "component", "query", "member")), rows.column("tokens")):
            entry = (name, component, tokens.values.to_numpy().view(np.uint64))
            for side, use in ((queries, query), (members, member)):
                if use:
                    side.append(entry)
        found = unit_links(queries, members, percent)
        return pa.table([_binary([x for x, _ in found]), _binary([y for _, y in found])], ["a", "b"])

    kinds = dict(units.dtypes)
    near = stored(units.groupBy(*unit).applyInArrow(bound, ", ".join(f"{c} {kinds[c]}" for c in names)), "near-members")
    sets = sets_of(docs, near.select(F.col("b").alias("c")).distinct(), n).dropDuplicates(["class"])
    return near.join(sets.select(F.col("class").alias("b"), "tokens"), "b").groupBy(*unit).applyInArrow(run, "a binary, b binary")


def link_classes(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, parts_from: int | None = PARTS_FROM) -> DataFrame:
    """``v, label``: the component of every class that is linked with another."""
    stars, every = candidate_stars(docs, n, percent, parts_from)
    wanted = comparable(stars, percent).withColumnRenamed("c", "class")
    bins = stored(every.select("class", "bins").join(wanted, "class", "left_semi").groupBy("class").agg(F.min("bins").alias("bins")), "bins")
    drop(every)
    pairs = stored(possible_stars(stars, bins, percent), "pairs")
    with bucketed(sets_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct(), n)) as sets:
        near = stored(compare_stars(pairs, sets, percent), "near")
    labels = stored(components(near), "labels")
    more = stored(compare_groups(docs, stars, bins, labels, n, percent), "links")
    return components(near.unionByName(more)) if more.limit(1).count() else labels


def jaccard_join(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, parts_from: int | None = PARTS_FROM) -> DataFrame:
    """One row per document: its set's size, its component's smallest id, and its row key."""
    with shuffles_freed(docs.sparkSession):
        held = stored(classes(docs, n), "classes")
        labels = link_classes(docs, n, percent, parts_from).select(F.col("v").alias("class"), "label")
        placed = stored(held.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class")), "placed")
        drop(held)
    least = placed.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "row", "label"
    )


def keep_one(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, parts_from: int | None = PARTS_FROM) -> DataFrame:
    """One document of each component, with all its columns: the one of the smallest id (of equal ids, the smallest
    row key; rows alike in id and text are one). Documents without shingles stay."""
    found = jaccard_join(docs, n, percent, parts_from)
    first = found.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("row"))
    chosen = first.select(F.col("row").alias("_kept_row")).distinct()
    names = docs.columns
    keyed = docs.select(F.struct(*[docs[c] for c in names]).alias("_doc"), row_key().alias("_row"), (F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", "")) == 0).alias("_blank"))
    alike = keyed.where("not _blank").join(chosen, F.col("_row") == F.col("_kept_row")).groupBy("_row").agg(F.first("_doc").alias("_doc"))
    return alike.select("_doc.*").unionByName(keyed.where("_blank").select("_doc.*"))
