"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network in numpy, and
probabilities calibrated by a temperature.

Tokens are runs of letters and digits, and runs of other signs; each falls into one of ``BUCKETS`` buckets. A bucket's
index vector is sparse, random and fixed; its context vector is the sum of the index vectors of all tokens next to its
own, over every document of the corpus. A document is the weighted mean of its tokens' vectors, beside how much its
index vectors agree, near each other and on the whole (repetition), and its length. The network learns from at most ``MAX_LABELLED`` labelled documents
(those of the smallest hashes), held-out rows excepted; a fifth of them sets the temperature. Everything else covers
all documents whole. Bounds on buckets, dimensions and labelled rows bound all that a task or the driver receives.

Defined results: a null or empty text has the features of no tokens and gets a score like any other; repeated rows get
equal scores; a null id is not held out and never labelled; of several labels of an id the least counts; without
labels of both kinds every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm import text as T
from vaultline.llm.common import documents, map_arrow

#: Rows with this remainder of crc32(id) by 3 are held out.
FOLDS, HELD_OUT = 3, 1

BUCKETS = 1 << 13
DIMENSIONS = 48
NONZERO = 2
REACH = 2
COMMON = 1e-3
MAX_LABELLED = 20_000
HIDDEN = 32
SEED = 11
#: Bytes of text, and tokens of a longer document, that get their vectors at a time: ``DIMENSIONS + 1`` floats each.
SCORED_BYTES = 1 << 18
WIDTH = 2 * DIMENSIONS + 4 + REACH

_KIND = np.full(256, 2, np.uint8)
_KIND[:0x20] = 0
_KIND[T.SPACE] = 0
_KIND[T.LETTERS] = 1
_KIND[ord("A"): ord("Z") + 1] = 1


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the index vectors' entries other than zero."""
    rng = np.random.default_rng(SEED)
    place = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return place.astype(np.int64), rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def tokens(chunk: T.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a chunk's tokens, and per document the first token's index."""
    n = len(chunk.data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(chunk.n + 1, np.int64)
    kind = _KIND[chunk.data]
    new = np.ones(n, bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[chunk.offsets[chunk.offsets < n]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    return (chunk.hashes(starts, ends) & T.U64(BUCKETS - 1)).astype(np.int64), np.searchsorted(starts, chunk.offsets)


def context_sums(docs: DataFrame) -> np.ndarray:
    """Per bucket the sum of its neighbours' index vectors, and its count: integers, added up by task, then by Spark."""
    names = [f"c{i}" for i in range(DIMENSIONS + 1)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = _index_vectors()
        sums, count = np.zeros(BUCKETS * DIMENSIONS), np.zeros(BUCKETS, np.int64)
        for part in parts:
            for chunk in T.chunks(part.column("text")):
                bucket, first = tokens(chunk)
                count += np.bincount(bucket, minlength=BUCKETS)
                doc = T.doc_of(first)
                for reach in range(1, REACH + 1):
                    ok = doc[:-reach] == doc[reach:]
                    a, b = bucket[:-reach][ok], bucket[reach:][ok]
                    for word, near in ((a, b), (b, a)):
                        for k in range(NONZERO):
                            sums += np.bincount(word * DIMENSIONS + place[near, k], sign[near, k], BUCKETS * DIMENSIONS)
        used = np.flatnonzero(count)
        table = np.column_stack([np.rint(sums).astype(np.int64).reshape(BUCKETS, DIMENSIONS), count])[used]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(np.ascontiguousarray(c)) for c in table.T]], ["bucket", *names])

    schema = "bucket int, " + ", ".join(f"{n} long" for n in names)
    summed = map_arrow(documents(docs).select("text"), run, schema).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((BUCKETS, DIMENSIONS + 1))
    out[summed["bucket"].to_numpy()] = np.column_stack([summed[n].to_numpy() for n in names])
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context vectors of length one with a weight that falls with the word's frequency: vector times weight, weight."""
    vectors, count = sums[:, :-1], sums[:, -1]
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    weight = COMMON / (COMMON + count / max(count.sum(), 1))
    return np.column_stack([vectors * weight[:, None], weight]).astype(np.float32)


def features(chunk: T.Chunk, vectors: np.ndarray) -> np.ndarray:
    """A row for each document."""
    bucket, first = tokens(chunk)
    counts = np.diff(first)
    pooled, own = np.zeros((chunk.n, DIMENSIONS + 1)), np.zeros((chunk.n, DIMENSIONS))
    doc = T.doc_of(first)
    place, sign = _index_vectors()
    for at in range(0, len(bucket), SCORED_BYTES):  # once, unless a document is longer
        some, owner = bucket[at: at + SCORED_BYTES], doc[at: at + SCORED_BYTES]
        cut = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        pooled[owner[cut]] += np.add.reduceat(vectors[some], cut, axis=0)
        for k in range(NONZERO):
            own += np.bincount(owner * DIMENSIONS + place[some, k], sign[some, k], chunk.n * DIMENSIONS).reshape(chunk.n, DIMENSIONS)
    agree = np.zeros((chunk.n, REACH))
    for reach in range(1, REACH + 1):
        same = (bucket[:-reach] == bucket[reach:]) & (doc[:-reach] == doc[reach:])
        agree[:, reach - 1] = np.bincount(doc[reach:][same], minlength=chunk.n)
    n = np.maximum(counts, 1)[:, None]
    mean = pooled[:, :-1] / np.maximum(pooled[:, -1:], 1e-9)
    own /= n
    return np.column_stack([mean, np.linalg.norm(mean, axis=1), pooled[:, -1:] / n, own, np.linalg.norm(own, axis=1), agree / n, np.log1p(counts)])


@dataclass
class Model:
    """Word vectors, scaling of the features, the network's two layers, and the temperature."""

    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(np.clip((rows - self.mean) / self.scale, -8, 8) @ a + b) @ c + d

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, epochs: int = 60, batch: int = 256, rate: float = 3e-3, decay: float = 1e-4) -> Model:
    """Adam on the log loss of four fifths of the rows; the temperature least in log loss on the rest."""
    rng = np.random.default_rng(SEED)
    if not len(y) or y.min() == y.max():
        return Model(vectors, np.zeros(WIDTH), np.ones(WIDTH), [np.zeros((WIDTH, 1)), np.zeros(1), np.zeros(1), np.zeros(())], 1.0)
    order = rng.permutation(len(y))
    rest, use = order[: len(y) // 5], order[len(y) // 5:]
    mean, scale = x[use].mean(0), np.maximum(x[use].std(0), 1e-6)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    model = Model(vectors, mean, scale, layers, 1.0)
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    inputs = np.clip((x - mean) / scale, -8, 8)
    for _ in range(epochs):
        shuffled = rng.permutation(use)
        for at in range(0, len(shuffled), batch):
            rows, target = inputs[shuffled[at: at + batch]], y[shuffled[at: at + batch]]
            hidden = np.tanh(rows @ layers[0] + layers[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -40, 40))) - target) / len(target)
            back = np.outer(error, layers[2]) * (1 - hidden**2)
            gradients = [rows.T @ back + decay * layers[0], back.sum(0), hidden.T @ error + decay * layers[2], error.sum()]
            step += 1
            for i, g in enumerate(gradients):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g**2
                layers[i] = layers[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    if len(rest):
        logits, sign = model.logits(x[rest]), 2 * y[rest] - 1
        choices = np.geomspace(0.25, 8, 61)
        model.temperature = float(min(choices, key=lambda t: np.logaddexp(0, -sign * logits / t).mean()))
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def labelled(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """The labels to learn from: one row per id that isn't held out, ``limit`` at most."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    return rows.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    vectors = word_vectors(context_sums(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text"), SCORED_BYTES):
                rows = features(chunk, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(chunk.first, chunk.n), part.column("quality").slice(chunk.first, chunk.n),
                     pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), WIDTH).cast(pa.list_(pa.float64()))],
                    ["doc_id", "quality", "features"],
                )

    known = documents(docs).withColumn("doc_id", F.col("doc_id").cast("long")).join(F.broadcast(labelled(labels, limit)), "doc_id")
    rows = map_arrow(known, run, "doc_id long, quality int, features array<double>").toArrow()
    x = rows["features"].combine_chunks().flatten().to_numpy().reshape(len(rows), WIDTH)
    order = np.lexsort((*x.T[:3], rows["doc_id"].to_numpy()))  # whatever the order of tasks
    return fit(x[order], rows["quality"].to_numpy().astype(np.float64)[order], vectors)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: whether it is held out, its score, and the class at 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = documents(docs).withColumn("held_out", held_out(F.col("doc_id")))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for chunk in T.chunks(part.column("text"), SCORED_BYTES):
                scores = shared.value.scores(features(chunk, shared.value.vectors))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).slice(chunk.first, chunk.n) for c in ("doc_id", "held_out")]
                    + [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
                )

    return map_arrow(docs, run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents of predicted class 1, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            kept = [shared.value.scores(features(c, shared.value.vectors)) >= 0.5 for c in T.chunks(part.column("text"), SCORED_BYTES)]
            yield part.filter(pa.array(np.concatenate(kept))) if kept else part

    return map_arrow(docs, run, docs.schema)
