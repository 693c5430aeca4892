"""Conversation prefix trie in balanced parentheses.

A conversation is a path of turns, and every distinct beginning of a path is a node of a trie. What two conversations
begin with alike has to be computed once; the trie says what that saves.

1. A turn becomes a 128-bit hash of its role and text and its number of words; texts are not moved again. Equal paths
   are one row, with the number of their conversations and the smallest id.
2. The distinct paths are put in order of their hashes and cut into shards: ranges of about equal numbers of turns. In
   that order a node's paths are neighbours, so a shard shares with the next only the nodes of the beginning that its
   last path and the next one's first path have in common: the spine.
3. Each shard writes its trie as balanced parentheses. Blocks of the sequence keep the least and the last excess, under
   a tree of least values: ``find_close`` goes to the parenthesis that ends a subtree. The number of pairs "()" between
   the two is the number of leaves, and sums of conversations and words over preorder give members and savings.
4. A spine node belongs to the first shard that has it: only there do its words, and its place among its parent's
   children, count. Then all its figures are sums (or least values) over shards, and the shards' spines merge by one
   grouping of a few rows. A node where a path ends and the next shard goes on is a leaf in neither.
5. The hashes of ending members are taken over blocks of ids, joined in parallel in order and digested block by block.

A node's savings are the sum over its subtree of (members - 1) x words; the sums of members x words and of words are kept
apart, since both add up over shards. A turn that a third of all conversations begin with costs one row a shard, and a
conversation of which there are many copies one row.

Defined results: rows without ``conv_id`` belong to no conversation; null turns come first, and rows of equal turn go by
role and then text, repeated rows as often as they occur; null role or text counts as empty; a conversation's turns are
one row of hashes and numbers, texts of any length are read once; ids are whole numbers; further columns are not looked
at; an empty table gives an empty result, without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import map_arrow, stored

#: Fixed value: conversations whose beginnings are rebuilt from the first of each such run of ids.
FAMILY = 20
HEAD = 4

SHARD_TURNS, LEAST_TURNS = 1_000_000, 1000
#: Turns of a path that decide its shard; paths alike in all of them lie in one.
LEADING = 32
PARENS_BLOCK = 64
NONE = np.iinfo(np.int64).max


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn`` with positions from 0; a turn holds its hash and words."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return (
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
        .withColumn("pos", F.row_number().over(in_order) - 1)
        .select("conv_id", "pos", F.struct(digest.alias("digest"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")).alias("turn"))
    )


def rebuilt(turns: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """``conv_id, path``: every conversation with its first h turns replaced by those of its family's first, where h is
    the CRC-32 of its id's digits modulo ``head``."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(head)).cast("int")
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "turn"))).alias("own"))
    own = stored(own.select("conv_id", F.transform("own", lambda x: x["turn"]).alias("own"), h.alias("h")), "paths")
    base = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("own", 1, head - 1).alias("first"))
    with_base = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(base, "base", "left")
    start = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.slice("own", 1, 0))
    return with_base.select("conv_id", F.concat(start, F.slice("own", F.col("h") + 1, F.size("own"))).alias("path"))


def distinct_paths(paths: DataFrame) -> DataFrame:
    """``id, digests, words, n, least`` of each distinct path."""
    digests = F.transform("path", lambda t: t["digest"])
    rows = paths.select("conv_id", path_id(digests).alias("id"), "path")
    least = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"))
    return least.select("id", digests.alias("digests"), F.transform("path", lambda t: t["words"]).alias("words"), "n", "least")


def path_id(digests: F.Column) -> F.Column:
    return F.unhex(F.md5(F.array_join(F.transform(digests, lambda d: F.hex(d)), "").cast("binary")))


def ends_of(paths: DataFrame) -> DataFrame:
    """``id, ends_sha256``: the SHA-256 of each path's ids in order, joined by commas. Ids are joined where a range of
    (path, id) lies; only the blocks of one path meet, in order, and are digested as they come."""
    digests = F.transform("path", lambda t: t["digest"])
    ids = paths.select(path_id(digests).alias("id"), "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")

    def join(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            conv = part.column("conv_id").to_numpy()
            keys = part.column("id").to_pylist()
            head = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
            texts = [",".join(map(str, conv[a:b].tolist())).encode() for a, b in zip(head, [*head[1:], len(keys)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in head], pa.binary()), pa.array(conv[head]), pa.array(texts, pa.binary())], ["id", "first", "block"]
            )

    def digest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for part in parts:
            ids, out = part.column("id").to_pylist(), []
            for k, block in zip(ids, part.column("block")):
                if k == key:
                    state.update(b",")
                elif key is not None:
                    out.append((key, state.hexdigest()))
                if k != key:
                    key, state = k, hashlib.sha256()
                state.update(block.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["id", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    blocks = map_arrow(ids, join, "id binary, first long, block binary")
    return map_arrow(blocks.repartition("id").sortWithinPartitions("id", "first"), digest, "id binary, ends_sha256 string")


class Parens:
    """A balanced sequence of parentheses, with the least and last excess of blocks and a tree of least values."""

    def __init__(self, is_open: np.ndarray):
        self.is_open, n = is_open, len(is_open)
        step = np.where(is_open, 1, -1).astype(np.int64)
        blocks = max(1, -(-n // PARENS_BLOCK))
        padded = np.zeros(blocks * PARENS_BLOCK, np.int64)
        padded[:n] = step
        self.excess = np.cumsum(padded)  # of the sequence up to and including a place
        self.levels = [self.excess.reshape(blocks, PARENS_BLOCK).min(1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            low = np.append(low, NONE) if len(low) % 2 else low
            self.levels.append(np.minimum(low[::2], low[1::2]))
        self.opens = np.concatenate([[0], np.cumsum(is_open)])
        pairs = np.zeros(n + 1, np.int64)
        pairs[2:] = np.cumsum(is_open[:-1] & ~is_open[1:])
        self.pairs = pairs

    def _first_below(self, at: np.ndarray, end: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place in [at, end) whose excess is at most ``goal``, or ``end``."""
        out, todo = at.copy(), np.arange(len(at))
        while True:
            todo = todo[out[todo] < end[todo]]
            todo = todo[self.excess[out[todo]] > goal[todo]]
            if not len(todo):
                return out
            out[todo] += 1

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The closing parentheses of opening ones: the first place after each whose excess is below the opening's."""
        goal, block = self.excess[at] - 1, at // PARENS_BLOCK
        end = (block + 1) * PARENS_BLOCK
        out = self._first_below(at + 1, end, goal)
        todo = np.flatnonzero(out == end)  # not in the same block: up the tree, then down to the first low block
        if len(todo):
            node, level, goals = block[todo], np.zeros(len(todo), np.int64), goal[todo]
            climbing = np.ones(len(todo), bool)
            while climbing.any():
                for lv in np.unique(level[climbing]).tolist():
                    rows = np.flatnonzero(climbing & (level == lv))
                    low = np.append(self.levels[lv], NONE)
                    right = np.where(node[rows] % 2 == 0, np.minimum(node[rows] + 1, len(low) - 1), len(low) - 1)
                    found = low[right] <= goals[rows]
                    node[rows] = np.where(found, right, node[rows] // 2)
                    climbing[rows[found]] = False
                    level[rows[~found]] += 1
            while level.any():
                for lv in np.unique(level[level > 0]).tolist():
                    rows = np.flatnonzero(level == lv)
                    left = self.levels[lv - 1][2 * node[rows]] <= goals[rows]
                    node[rows] = 2 * node[rows] + ~left
                    level[rows] -= 1
            first = node * PARENS_BLOCK
            out[todo] = self._first_below(first, first + PARENS_BLOCK, goals)
        return out

    def rank_open(self, at: np.ndarray) -> np.ndarray:
        """Opening parentheses before a place."""
        return self.opens[at]

    def leaves(self, at: np.ndarray, close: np.ndarray) -> np.ndarray:
        """Pairs "()" from an opening parenthesis to its closing one."""
        return self.pairs[close + 1] - self.pairs[at + 1]


def common_lengths(paths: list[list[bytes]]) -> np.ndarray:
    """Turns that each path has in common with the one before it."""
    out = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        most = min(len(a), len(b))
        k = 0
        while k < most and a[k] == b[k]:
            k += 1
        out[i] = k
    return out


class Trie:
    """The trie of some distinct paths in order. Nodes are in preorder; the root, which has no turn, comes first."""

    def __init__(self, paths: list[list[bytes]], words: list[list[int]], n: np.ndarray, least: np.ndarray):
        size = np.array([len(p) for p in paths], np.int64)
        common = common_lengths(paths)
        new = size - common
        opened = int(new.sum()) + 1
        self.depth = np.zeros(opened, np.int64)
        turn = np.arange(opened - 1) - np.repeat(np.cumsum(new) - new, new)
        self.depth[1:] = np.repeat(common, new) + turn + 1
        # parentheses: the root's, then for each path the closing ones of the last path's rest and its own openings
        closed = np.append(size[:-1] - common[1:], size[-1] + 1)
        moves = np.ones(1 + 2 * len(paths), np.int64)
        moves[1::2], moves[2::2] = new, closed
        is_open = np.ones(len(moves), bool)
        is_open[2::2] = False
        self.parens = Parens(np.repeat(is_open, moves))
        self.at = np.flatnonzero(self.parens.is_open)
        self.close = self.parens.find_close(self.at)
        self.first = self.parens.rank_open(self.at)
        self.end = self.parens.rank_open(self.close)
        self.leaves = self.parens.leaves(self.at, self.close)
        self.path = np.repeat(np.arange(len(paths)), new)  # the first path through each node but the root
        self.words = np.zeros(opened, np.int64)
        self.words[1:] = [w for p, k in zip(words, common.tolist()) for w in p[k:]]
        last = np.cumsum(new)  # the node where each path ends: its last new one (the root, if it has no turn)
        ends, low = np.zeros(opened, np.int64), np.full(opened, NONE)
        ends[last] = n
        low[last] = least
        self.ends_at = last
        self.members = self._sum(ends)
        self.worth = self._sum(self.members * self.words)
        self.parent = self._parents()
        self.least = low
        for d in range(int(self.depth.max()), 0, -1):
            rows = self._by_depth[self._depth_at[d]: self._depth_at[d + 1]]
            np.minimum.at(self.least, self.parent[rows], self.least[rows])

    def _sum(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees, from sums in preorder."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.end] - total[self.first]

    def _parents(self) -> np.ndarray:
        """In preorder, a node's parent is the last node before it of one depth less."""
        self._by_depth = np.argsort(self.depth, kind="stable")
        self._depth_at = np.searchsorted(self.depth[self._by_depth], np.arange(int(self.depth.max()) + 2))
        out = np.full(len(self.depth), -1, np.int64)
        for d in range(1, int(self.depth.max()) + 1):
            above = self._by_depth[self._depth_at[d - 1]: self._depth_at[d]]
            rows = self._by_depth[self._depth_at[d]: self._depth_at[d + 1]]
            out[rows] = above[np.searchsorted(above, rows) - 1]
        return out


def node_ids(trie: Trie, digests: list[list[bytes]]) -> list[bytes]:
    """128-bit ids of a trie's nodes, from the parent's id and the turn; the root's is empty."""
    out, depth, path = [b""] * len(trie.depth), trie.depth.tolist(), trie.path.tolist()
    for v, p in enumerate(trie.parent.tolist()):
        if v:
            out[v] = hashlib.md5(out[p] + digests[path[v - 1]][depth[v] - 1]).digest()
    return out


NODE = (
    "id binary, depth long, parent binary, shared boolean, parent_shared boolean, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, worth long, words long, path binary"
)


def shard_nodes(rows: dict[str, list], before: int, after: int) -> pa.RecordBatch:
    """All nodes of a shard; ``before`` and ``after`` are the turns that its first path has in common with the shard
    before, and its last one with the shard after (-1 where there is none). Spine nodes are marked as shared."""
    digests = rows["digests"]
    trie = Trie(digests, rows["words"], np.array(rows["n"], np.int64), np.array(rows["least"], np.int64))
    ids, nodes = node_ids(trie, digests), np.arange(len(trie.depth))
    # the first path's nodes are the first in preorder, the last one's are those still open at its end
    continued = (nodes <= len(digests[0])) & (trie.depth <= before)
    goes_on = (trie.end == len(nodes)) & (trie.depth <= after)
    owned = ~continued
    child = np.bincount(trie.parent[1:][owned[1:]], minlength=len(nodes))
    leaves = trie.leaves.copy()
    last = int(trie.ends_at[-1])
    if after >= 0 and after == trie.depth[last]:  # the last path goes on in the next shard, so its end is no leaf
        v = last
        while v >= 0:
            leaves[v] -= 1
            v = int(trie.parent[v])
    path = [None] * len(nodes)
    for i, v in enumerate(trie.ends_at.tolist()):
        path[v] = rows["id"][i]
    shared = continued | goes_on
    parent = trie.parent.tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.binary()), pa.array(trie.depth), pa.array([ids[p] if p >= 0 else None for p in parent], pa.binary()),
         pa.array(shared), pa.array(np.append(False, shared[trie.parent[1:]])), pa.array(trie.least),
         pa.array([int(trie.least[p]) if p >= 0 else None for p in parent], pa.int64()), pa.array(trie.members), pa.array(child.astype(np.int64)),
         pa.array(leaves), pa.array(trie.worth), pa.array(trie._sum(np.where(owned, trie.words, 0))), pa.array(path, pa.binary())],
        [c.split()[0] for c in NODE.split(", ")],
    )


def _shard_rows(parts: Iterator[pa.RecordBatch]) -> dict[str, list]:
    rows: dict[str, list] = {c: [] for c in ("id", "digests", "words", "n", "least")}
    for part in parts:
        for c, out in rows.items():
            out += part.column(c).to_pylist()
    return rows


def trie_nodes(paths: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conv_id, path`` (turns of digest and words)."""
    paths = stored(paths, "rebuilt")
    spark = paths.sparkSession
    distinct = stored(distinct_paths(paths), "distinct-paths")
    turns = distinct.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
    number = max(1, min(-(-turns // LEAST_TURNS), max(-(-turns // SHARD_TURNS), spark.sparkContext.defaultParallelism)))
    leading = F.array_join(F.transform(F.slice("digests", 1, LEADING), lambda d: F.hex(d)), "")
    ranged = distinct.withColumn("leading", leading).repartitionByRange(number, "leading").withColumn("shard", F.spark_partition_id())
    ranged = stored(ranged, "trie-shards")
    # first and last path of each shard, as two rows a shard
    edges = ranged.groupBy("shard").agg(F.min("digests").alias("first"), F.max("digests").alias("last"))
    in_order = Window.orderBy("shard")
    shorter = F.least(F.size("last"), F.size(F.lead("first").over(in_order)))
    differs = F.array_position(F.zip_with(F.slice("last", F.lit(1), "shorter"), F.slice("next", F.lit(1), "shorter"), lambda a, b: a == b), False)
    spine = edges.select("shard", "last", F.lead("first").over(in_order).alias("next"), shorter.alias("shorter"))
    spine = spine.select("shard", F.when(F.col("next").isNull(), -1).when(differs == 0, F.col("shorter")).otherwise(differs - 1).cast("long").alias("after"))
    spine = stored(spine.select("shard", F.coalesce(F.lag("after").over(in_order), F.lit(-1).cast("long")).alias("before"), "after"), "spines")

    def build(shard: pa.Table) -> pa.Table:
        rows = _shard_rows(shard.combine_chunks().to_batches())
        return pa.Table.from_batches([shard_nodes(rows, shard["before"][0].as_py(), shard["after"][0].as_py())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard = None
        for part in parts:
            at = part.column("shard").to_numpy()
            for cut in np.split(np.arange(len(at)), np.flatnonzero(at[1:] != at[:-1]) + 1):
                if not len(cut):
                    continue
                if shard is not None and at[cut[0]] != shard:
                    yield from build(pa.Table.from_batches(held)).to_batches()
                    held = []
                shard = int(at[cut[0]])
                held.append(part.slice(int(cut[0]), len(cut)))
        if held:
            yield from build(pa.Table.from_batches(held)).to_batches()

    dealt = ranged.drop("leading").join(spine, "shard").repartition(number, "shard").sortWithinPartitions("shard", "digests")
    nodes = stored(map_arrow(dealt, run, NODE), "trie-nodes")
    merged = nodes.where("shared").groupBy("id").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("worth").alias("worth"), F.sum("words").alias("words"), F.max("path").alias("path"),
    )
    merged = stored(merged, "spine-nodes")
    above = merged.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    figures = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "worth", "words", "path"]
    whole = merged.join(above, "parent", "left").withColumnRenamed("above", "parent_conv_id").select(figures)
    inner = nodes.where("not shared and not parent_shared").select(figures)
    under = nodes.where("not shared and parent_shared").drop("parent_conv_id").join(above, "parent").withColumnRenamed("above", "parent_conv_id").select(figures)
    every = whole.unionByName(inner).unionByName(under)
    ends = ends_of(paths).withColumnRenamed("id", "path")
    nothing = hashlib.sha256(b"").hexdigest()
    ended = every.where("path is not null").join(ends, "path").unionByName(every.where("path is null").withColumn("ends_sha256", F.lit(nothing)))
    return ended.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("worth") - F.col("words")).alias("saved_tokens"), "ends_sha256",
    )


def prefix_trie(conversations: DataFrame, family: int = FAMILY, head: int = HEAD) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie_nodes(rebuilt(turns_of(conversations), family, head))
