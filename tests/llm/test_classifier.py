import tracemalloc
import zlib

import numpy as np
import pandas as pd

from vaultline.llm import classifier
from vaultline.llm import text as T
from vaultline.llm.queries import QUERIES
from vaultline.llm.text import Chunk

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op2_quality_classifier"](spark, SF).toPandas()
    assert len(rows) == 1000 and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(rows.doc_id, rows.held_out))
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.97
    assert ((held.score - held.quality) ** 2).mean() < 0.03


def test_learns_nothing_from_held_out_rows_and_ids(spark):
    """Turning round the labels of held-out rows, or the columns other than the text, changes no score."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = classifier.held_out(labels["doc_id"])
    other = labels.selectExpr("doc_id", "quality").withColumn("quality", classifier.F.when(held, 1 - labels["quality"]).otherwise(labels["quality"]))
    a = classifier.train(docs, labels)
    b = classifier.train(docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as source").repartition(5), other)
    texts = [T.Chunk.of([t.encode()]) for t in ("", "A text of words.", "a a a a a a", "$$$ | !! |")]
    for chunk in texts:
        one, two = (m.scores(classifier.features(chunk, m.vectors))[0] for m in (a, b))
        assert abs(one - two) < 1e-6


def test_context_sums_match_brute_force(spark):
    texts = ["a b c a", "", "b b", "c"]
    sums = classifier.context_sums(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    place, sign = classifier._index_vectors()
    dense = np.zeros((classifier.BUCKETS, classifier.DIMENSIONS))
    for k in range(classifier.NONZERO):
        dense[np.arange(classifier.BUCKETS), place[:, k]] += sign[:, k]
    want = np.zeros((classifier.BUCKETS, classifier.DIMENSIONS + 1))
    for t in texts:
        b = classifier.tokens(T.Chunk.of([t.encode()]))[0]
        for i, x in enumerate(b):
            want[x, -1] += 1
            for j in range(max(0, i - 2), min(len(b), i + 3)):
                if j != i:
                    want[x, :-1] += dense[b[j]]
    assert (sums == want).all()


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = classifier.train(edges, labels)
    rows = classifier.score(edges, model).collect()
    assert len(rows) == edges.count() and all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.doc_id is None][0].held_out
    plain = classifier.train(nothing, labels)
    assert {r.score for r in classifier.score(edges, plain).collect()} == {0.5}
    assert classifier.score(nothing, plain).count() == 0
    assert classifier.keep_good(edges, plain).count() == edges.count() and classifier.keep_good(edges, plain).columns == edges.columns


def test_memory_of_a_long_document():
    """Tokens get their vectors some at a time, however long the document is; the features are those of all of them."""
    text = b"alpha beta gamma delta " * 400_000
    vectors = np.random.default_rng(1).random((classifier.BUCKETS, classifier.DIMENSIONS + 1)).astype(np.float32)
    tracemalloc.start()
    some = classifier.features(Chunk.of([b"one two", text, b"three"]), vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(text)
    alone = np.concatenate([classifier.features(Chunk.of([t]), vectors) for t in (b"one two", text, b"three")])
    assert np.allclose(some, alone, rtol=1e-4)
    short = classifier.features(Chunk.of([text[:23_000]]), vectors)
    assert np.allclose(some[1, : classifier.DIMENSIONS], short[0, : classifier.DIMENSIONS], rtol=1e-3)
