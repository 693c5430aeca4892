import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as near
from tokenizers import Tokenizer

import corpus_pipeline
from vaultline.llm import classifier

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage and after the last, as frames of rows."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs.toPandas())
    for _, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.toPandas())
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output",
    ]


def test_columns(stages):
    for frame in stages[:-1]:
        assert list(frame.columns) == COLUMNS


def test_quality(spark, stages):
    before, after = stages[:2]
    docs = spark.createDataFrame(before[["doc_id", "text"]])
    model = classifier.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.predicted for r in classifier.score(docs, model).collect()}
    assert set(after.doc_id) == {i for i, p in scores.items() if p == 1}
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    assert labels[labels.index.isin(after.doc_id)].mean() > labels.mean()


def test_near_duplicates(stages):
    before, after = (f.sort_values("doc_id").reset_index(drop=True) for f in stages[1:3])
    first = [before.doc_id[c] for _, c in near(before.text.tolist(), 5, 80)]
    assert set(after.doc_id) == set(first) and len(after) < len(before)


def test_decontamination(stages):
    before, after = stages[2:4]
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    hit = [r[-1] for r in leaks(before.text.tolist(), list(zip(bench.item_id, bench.text)))]
    assert set(after.doc_id) == set(before.doc_id[~np.array(hit)]) and any(hit)


def test_source_mix(stages):
    before, after = stages[3:5]
    assert set(after.doc_id) <= set(before.doc_id) and after.groupby("doc_id").size().max() <= 3
    words = lambda f: f.assign(n=f.text.str.count(r"[^\x20\x09-\x0D]+")).groupby("source").n
    sizes, total, most = words(before).sum(), words(before).sum().sum(), words(before).max()
    got = words(after).sum().reindex(sizes.index, fill_value=0)
    weights = dict(zip(sorted(sizes.index), [1, 2, 3] * len(sizes)))
    left, open_, goal = total, set(sizes.index), {}
    while over := {s for s in open_ if weights[s] * left / sum(weights[x] for x in open_) > 3 * sizes[s]}:
        goal |= {s: 3 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    goal |= {s: weights[s] * left / sum(weights[x] for x in open_) for s in open_}
    assert all(abs(got[s] - goal[s]) <= most[s] / 2 + 1 for s in sizes.index)


def test_token_output(stages):
    before, after = stages[4:]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = before.sort_values("doc_id")
    want = []
    for doc_id, text in zip(rows.doc_id, rows.text):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    got = after.sort_values("start")
    assert list(zip(got.doc_id, got.n_tokens, got.ids_crc32)) == want
    assert got.start.tolist() == [0, *np.cumsum(got.n_tokens)[:-1].tolist()]


def test_run(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(stages[-1].itertuples(index=False, name=None))


def test_edges(spark, edges, nothing):
    """Each stage keeps the columns and stands nulls, empty and long texts, repeated rows and empty tables."""
    for docs in (edges, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns, name
            stage(spark, docs, SF).count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
