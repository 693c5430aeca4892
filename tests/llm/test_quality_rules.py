import re
from collections import Counter

import numpy as np
import pandas as pd

from vaultline.llm import quality_rules
from vaultline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeat = {j for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for j in range(i, i + 3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed


def test_matches_brute_force(spark, sample):
    rows = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF).collect()}
    assert len(rows) == len(sample)
    for doc_id, text in zip(sample.doc_id, sample.text):
        r = rows[doc_id]
        assert tuple(r)[1:7] == brute(text), doc_id
        assert r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD)


def test_model_counts_all_documents(spark, sample):
    """The ratio equals one counted without batches or tasks, feature by feature."""
    from vaultline.llm import text as T

    labels = pd.read_parquet(f"{SF}/labels.parquet")
    good = set(labels[labels.quality == 1].doc_id)
    frame = spark.createDataFrame(sample[["doc_id", "text"]])
    ratio = quality_rules.model(frame.repartition(5), spark.createDataFrame([(i,) for i in good], "doc_id long"), 1 << 12)
    raw, ok = np.zeros(1 << 12), np.zeros(1 << 12)
    for doc_id, text in zip(sample.doc_id, sample.text):
        bucket, _ = quality_rules.features(T.Chunk.of([text.encode()]), 1 << 12)
        raw += np.bincount(bucket, minlength=1 << 12)
        if doc_id in good:
            ok += np.bincount(bucket, minlength=1 << 12)
    want = np.log((ok + 1) / (ok.sum() + 4096)) - np.log((raw + 1) / (raw.sum() + 4096))
    assert np.allclose(ratio, want)


def test_edges(spark, edges, nothing):
    none = spark.createDataFrame([], "doc_id long")
    rows = quality_rules.quality_rules(edges, none).collect()
    assert sorted(tuple(r)[1:7] for r in rows) == sorted(brute(r.text) for r in edges.collect())
    assert quality_rules.quality_rules(nothing, none).count() == 0


def test_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op9_quality_rules"](spark, sf).toPandas().merge(labels, on="doc_id")
    long = rows[~rows.base_failed]
    assert long[long.quality == 1].kept.mean() > 0.99 and long[long.quality == 0].kept.mean() < 0.2


def test_every_trusted_document_counts(spark):
    """More trusted ids than any list of fixed length; repeated and null ones, and documents without an id."""
    from vaultline.llm import text as T

    docs = spark.sql(
        "select if(id % 1000 = 7, null, id) as doc_id, concat('word', id % 11, ' tail') as text from range(240000) "
        "union all select 4, 'again' from range(5000)"
    )
    trusted = spark.sql("select id as doc_id from range(0, 240000, 2) union all select 4 from range(3000) union all select null")
    ratio = quality_rules.model(docs.repartition(6), trusted, 1 << 10)
    raw, ok = np.zeros(1 << 10), np.zeros(1 << 10)
    texts = [(f"word{k} tail", len(range(k, 240000, 11)), len([i for i in range(k, 240000, 11) if i % 2 == 0])) for k in range(11)]
    for text, n, good in [*texts, ("again", 5000, 5000)]:
        bucket, _ = quality_rules.features(T.Chunk.of([text.encode()]), 1 << 10)
        raw += n * np.bincount(bucket, minlength=1 << 10)
        ok += good * np.bincount(bucket, minlength=1 << 10)
    assert np.array_equal(ratio, np.log((ok + 1) / (ok.sum() + 1024)) - np.log((raw + 1) / (raw.sum() + 1024)))
