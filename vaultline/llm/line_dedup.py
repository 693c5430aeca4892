"""Line dedup by levelled sorted runs of line hashes.

Documents come in batches. A batch's line keys, 128-bit hashes with the number of its documents that hold them, are
anti-joined with the keys that the runs before it have already found often enough, and the rest is added as a sorted
run of its own; when a level has ``FANOUT`` runs they are merged into one run of the next level, their counts added.
In the end, the keys found in ``MIN_DOCS`` documents or more lose all their lines in every document.

Counts are summed by task before anything is shuffled, so a line that most documents share costs one row a task. If
the frequent keys number no more than ``broadcast_keys``, they are sent to all tasks and the texts stay where they are;
otherwise the documents' keys are joined with them, and the documents with their lists of dropped lines.

Defined results: a null or empty text is one empty line, which stays; blank lines stay; each repeated row counts as a
document and gets its own result; ids are passed on, null as well; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow, row_key, shared_folder

#: What is stripped at both ends of a line, and when a line is frequent.
BLANK = b" \t\n\v\f\r"
MIN_DOCS = 10

BATCHES = 4
FANOUT = 2
BROADCAST_KEYS = 2_000_000
COUNTED = 200_000


def line_keys(text: bytes) -> list[bytes | None]:
    """The hash of each line's key, None for lines without one. Only A-Z are lower-cased."""
    return [xxhash.xxh3_128_digest(k) if (k := line.strip(BLANK)) and (k := k.lower()) else None for line in text.split(b"\n")]


def _texts(column: pa.Array) -> Iterator[tuple[int, bytes]]:
    for chunk in T.chunks(column):
        data, at = chunk.data.tobytes(), chunk.offsets.tolist()
        for d in range(chunk.n):
            yield chunk.first + d, data[at[d]: at[d + 1]]


def _as_longs(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)


def batch_keys(docs: DataFrame, batches: int) -> DataFrame:
    """``batch, k1, k2, n``: how many documents of a part of a batch hold a key. Whole tasks make up a batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, count = TaskContext.get().partitionId() % batches, Counter()

        def flush() -> pa.RecordBatch:
            longs = _as_longs(list(count))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(count), number, np.int32)), pa.array(longs[:, 0]), pa.array(longs[:, 1]), pa.array(list(count.values()), pa.int64())],
                ["batch", "k1", "k2", "n"],
            )

        for part in parts:
            for _, text in _texts(part.column("text")):
                count.update({k for k in line_keys(text) if k})
                if len(count) > COUNTED:
                    yield flush()
                    count.clear()
        if count:
            yield flush()

    return map_arrow(documents(docs).select("text"), run, "batch int, k1 long, k2 long, n long")


class Runs:
    """Sorted runs of ``k1, k2, n`` by level, each stored in the shared folder."""

    def __init__(self, spark, least: int, fanout: int = FANOUT):
        self.spark, self.least, self.fanout, self.levels = spark, least, fanout, []

    def _write(self, counts: DataFrame, level: int) -> None:
        path = shared_folder(self.spark, f"line-run-{level}")
        counts.sortWithinPartitions("k1", "k2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._write(self.merged(merged), level + 1)

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def merged(self, paths: list[str]) -> DataFrame:
        runs = self.spark.read.schema("k1 long, k2 long, n long").parquet(*paths)
        return runs.groupBy("k1", "k2").agg(F.sum("n").alias("n"))

    def frequent(self) -> DataFrame:
        """The keys that the runs hold often enough."""
        return self.merged(self.paths()).where(F.col("n") >= self.least).select("k1", "k2")

    def add(self, keys: DataFrame) -> None:
        """Merges a batch: what is frequent already is left out, the rest becomes a run."""
        counts = keys.groupBy("k1", "k2").agg(F.sum("n").alias("n"))
        if self.paths():
            counts = counts.join(self.frequent(), ["k1", "k2"], "left_anti")
        self._write(counts, 0)


def frequent_lines(docs: DataFrame, least: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Keys held by ``least`` documents or more."""
    spark = docs.sparkSession
    path = shared_folder(spark, "line-keys")
    batch_keys(docs, batches).write.partitionBy("batch").parquet(path)
    stored = spark.read.schema("k1 long, k2 long, n long, batch int").parquet(path)
    runs = Runs(spark, least, fanout)
    for number in range(batches):
        runs.add(stored.where(F.col("batch") == number))
    return runs.frequent()


def _digest(lines: list[bytes], dropped: np.ndarray) -> tuple[int, int, str]:
    kept = [line for line, d in zip(lines, dropped.tolist()) if not d] if dropped.any() else lines
    return len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()


def _rows(ids: pa.Array, results: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, c = zip(*results) if results else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    )


def _found(keys: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Which keys are among the frequent ones, both as pairs of longs; the latter are sorted."""
    low = np.searchsorted(frequent[:, 0], keys[:, 0], "left")
    high = np.searchsorted(frequent[:, 0], keys[:, 0], "right")
    out = np.zeros(len(keys), bool)
    for k in range(int((high - low).max(initial=0))):
        at = np.minimum(low + k, len(frequent) - 1)
        out |= (low + k < high) & (frequent[at, 1] == keys[:, 1])
    return out


def drop_lines(docs: DataFrame, frequent: DataFrame, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """One row per document: its lines, how many are dropped, and the hash of what stays."""
    docs = documents(docs)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_lines long, n_dropped long, kept_sha256 string"
    some = frequent.limit(broadcast_keys + 1).toArrow()
    if len(some) > broadcast_keys:
        return _drop_joined(docs, frequent, schema)
    pairs = np.column_stack([some[k].to_numpy() for k in ("k1", "k2")])
    shared = docs.sparkSession.sparkContext.broadcast(pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            results = []
            for _, text in _texts(part.column("text")):
                keys = line_keys(text)
                dropped, real = np.zeros(len(keys), bool), [i for i, k in enumerate(keys) if k]
                if real:
                    dropped[real] = _found(_as_longs([keys[i] for i in real]), shared.value)
                results.append(_digest(text.split(b"\n"), dropped))
            yield _rows(part.column("doc_id"), results)

    return map_arrow(docs, run, schema)


def _drop_joined(docs: DataFrame, frequent: DataFrame, schema: str) -> DataFrame:
    """The same by two joins, for any number of frequent keys: document keys with frequent keys, then documents with
    the numbers of their dropped lines."""
    keyed = docs.withColumn("row", row_key())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = part.column("row")
            for d, text in _texts(part.column("text")):
                at: dict[bytes, list[int]] = {}
                for i, k in enumerate(line_keys(text)):
                    if k:
                        at.setdefault(k, []).append(i)
                if at:
                    longs = _as_longs(list(at))
                    yield pa.RecordBatch.from_arrays(
                        [rows.take(pa.array(np.full(len(at), d))), pa.array(longs[:, 0]), pa.array(longs[:, 1]), pa.array(list(at.values()), pa.list_(pa.int32()))],
                        ["row", "k1", "k2", "lines"],
                    )

    held = map_arrow(keyed.select("row", "text"), run, "row binary, k1 long, k2 long, lines array<int>")
    hits = held.join(frequent, ["k1", "k2"]).groupBy("row").agg(F.flatten(F.collect_set("lines")).alias("lines"))

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            results = []
            for d, text in _texts(part.column("text")):
                lines = text.split(b"\n")
                dropped = np.zeros(len(lines), bool)
                dropped[part.column("lines")[d].as_py() or []] = True
                results.append(_digest(lines, dropped))
            yield _rows(part.column("doc_id"), results)

    return map_arrow(keyed.join(hits, "row", "left").select("doc_id", "text", "lines"), finish, schema)


def line_dedup(docs: DataFrame, least: int = MIN_DOCS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    return drop_lines(docs, frequent_lines(docs, least), broadcast_keys)
