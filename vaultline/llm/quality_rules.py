"""Quality rules: counts of a text and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed one- and two-word features are counted, one over all trusted documents (those with a
listed id) and one over all documents. A document's score is the mean, over its features, of the log ratio of their
smoothed probabilities; a document is kept when that mean reaches a fixed threshold and no base rule refuses it. Every
document is counted and scored whole; counts are integers, so reruns agree.

Trusted documents are found by a join on the id, whatever the number of ids. A filter with a fixed number of bits keeps
most other texts from being shuffled for it; what it lets through by mistake, the join refuses.

Defined results: a null or empty text has no words, counts of 0 and fails the base rule; repeated rows are counted and
judged each; a null id is never trusted; an empty table gives an empty result; without trusted documents the ratio is
0 for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow, stored
from vaultline.llm.components import bits_of, has_bit

#: The symbols counted, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

BUCKETS = 1 << 16
THRESHOLD = -0.2
SMOOTHING = 1.0
ID_BITS = 26

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_NOT_BREAK = np.arange(256) != 10
_CONTENT = T.NON_SPACE & ((np.arange(256) & 0xC0) != 0x80)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, llr double"
)


def features(chunk: T.Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all one- and two-word features, and each feature's document."""
    starts, ends, first = chunk.runs(T.NON_SPACE)
    words, doc = chunk.hashes(starts, ends), T.doc_of(first)
    ok = T.within(first, 2)
    pairs = T.ngram_hashes(words, 2)[ok]
    mask = T.U64(buckets - 1)
    return (
        np.concatenate([words & mask, pairs & mask]).astype(np.int64),
        np.concatenate([doc, doc[: len(ok)][ok]]),
    )


def trusted_documents(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a listed id."""
    ids = trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ids = stored(ids, "trusted-ids")
    shared = docs.sparkSession.sparkContext.broadcast(bits_of(ids.select(F.xxhash64("doc_id").alias("h")), ID_BITS))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use = has_bit(shared.value, batch.column("h").to_numpy().view(np.uint64))
            yield batch.select(["doc_id", "text"]).filter(pa.array(use))

    hashed = _long_ids(docs).where("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    return map_arrow(hashed, maybe, "doc_id long, text string").join(ids, "doc_id", "left_semi")


def bucket_counts(docs: DataFrame, buckets: int) -> np.ndarray:
    """How often all texts hold each bucket. ``buckets`` bounds what a task sends and what the driver receives."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in T.chunks(batch.column("text")):
                n += np.bincount(features(chunk, buckets)[0], minlength=buckets)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used])], ["bucket", "n"])

    counted = map_arrow(docs.select("text"), count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets)
    out[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    return out


def model(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of each bucket. The raw multinomial counts every document, the trusted one every trusted document."""
    raw, good = bucket_counts(documents(docs), buckets), bucket_counts(trusted_documents(docs, trusted_ids), buckets)
    if not good.sum():
        return np.zeros(buckets)
    return np.log((good + smoothing) / (good.sum() + smoothing * buckets)) - np.log((raw + smoothing) / (raw.sum() + smoothing * buckets))


def _long_ids(docs: DataFrame) -> DataFrame:
    return documents(docs).withColumn("doc_id", F.col("doc_id").cast("long"))


def _repeated(words: np.ndarray, first: np.ndarray, n: int = 3) -> np.ndarray:
    """Marks words inside an n-word window that its document holds twice or more."""
    inside = np.zeros(len(words), bool)
    ok = T.within(first, n)
    if not ok.any():
        return inside
    at = np.flatnonzero(ok)
    keys = T.mix(T.ngram_hashes(words, n)[at] + T.doc_of(first)[at].astype(np.uint64) * T.U64(0xD6E8FEB86659FD93))
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[times[back] > 1]
    for k in range(n):
        inside[again + k] = True
    return inside


def _dup_lines(chunk: T.Chunk, word_starts: np.ndarray) -> np.ndarray:
    """Per document, the lines with a word that equal an earlier line. Lines without a word are left out at once, so
    the runs of bytes other than a line feed are the lines that remain to be compared."""
    starts, ends, first = chunk.runs(_NOT_BREAK)
    worded = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    docs = T.doc_of(first)[worded]
    if not len(docs):
        return np.zeros(chunk.n, np.int64)
    keys = T.mix(chunk.hashes(starts[worded], ends[worded]) + docs.astype(np.uint64) * T.U64(0xD6E8FEB86659FD93))
    _, earliest = np.unique(keys, return_index=True)
    later = np.ones(len(keys), bool)
    later[earliest] = False
    return np.bincount(docs[later], minlength=chunk.n)


def judge_chunk(chunk: T.Chunk, ratio: np.ndarray, threshold: float) -> list[np.ndarray]:
    starts, ends, first = chunk.runs(T.NON_SPACE)
    words = chunk.hashes(starts, ends)
    n_words = np.diff(first)
    inside = np.zeros(len(words) + 1, np.int64)
    np.cumsum(_repeated(words, first), out=inside[1:])
    repeat = inside[first[1:]] - inside[first[:-1]]
    bucket, doc = features(chunk, len(ratio))
    n_features = np.bincount(doc, minlength=chunk.n)
    llr = np.bincount(doc, weights=ratio[bucket], minlength=chunk.n) / np.maximum(n_features, 1)
    failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
    return [
        n_words, chunk.sums(_CONTENT[chunk.data]), chunk.sums(_SYMBOL[chunk.data]), _dup_lines(chunk, starts), repeat,
        failed, ~failed & (llr >= threshold), llr,
    ]


def judge(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its counts, the base rule, the mean log ratio and the verdict."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ratio.astype(np.float64))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in T.chunks(batch.column("text")):
                columns = judge_chunk(chunk, shared.value, threshold)
                ids = batch.column("doc_id").slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c) for c in columns]], names)

    return map_arrow(_long_ids(docs), run, SCHEMA)


def quality_rules(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """Counts both multinomials over all of ``docs``, then judges every document."""
    return judge(docs, model(docs, trusted_ids, buckets), threshold)
