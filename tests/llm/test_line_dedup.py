import hashlib
from collections import Counter

import pytest
from oracle import compare, connect

from vaultline.llm import line_dedup
from vaultline.llm.queries import QUERIES
from vaultline.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(texts, least):
    keys = [[line.strip(" \t\n\v\f\r").translate(UPPER) for line in (t or "").split("\n")] for t in texts]
    count = Counter(k for ks in keys for k in set(ks))
    out = []
    for t, ks in zip(texts, keys):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, ks) if not k or count[k] < least]
        out.append((len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, "lines", QUERIES["op3_line_dedup"], ORACLES["op3_line_dedup"])[0] == []


@pytest.mark.parametrize("broadcast_keys", [10**6, 0])
@pytest.mark.parametrize("least", [2, 3])
def test_matches_brute_force(spark, sample, broadcast_keys, least):
    frame = spark.createDataFrame(sample[["doc_id", "text"]]).repartition(7)
    got = {r[0]: tuple(r)[1:] for r in line_dedup.line_dedup(frame, least, broadcast_keys).collect()}
    assert got == dict(zip(sample.doc_id, brute(sample.text.tolist(), least)))


@pytest.mark.parametrize("broadcast_keys", [10**6, 0])
def test_edges(spark, edges, nothing, broadcast_keys):
    got = line_dedup.line_dedup(edges, 2, broadcast_keys).collect()
    rows = edges.collect()
    want = [(r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], 2))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert line_dedup.line_dedup(nothing, 2, broadcast_keys).count() == 0


def test_runs_are_levelled_and_add_up(spark):
    runs = line_dedup.Runs(spark, least=5, fanout=2)
    for _ in range(5):
        runs.add(spark.createDataFrame([(1, 1, 2), (2, 2, 1), (3, 3, 9)], "k1 long, k2 long, n long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    counts = {r.k1: r.n for r in runs.merged(runs.paths()).collect()}
    assert counts == {1: 6, 2: 5, 3: 9}  # what was frequent was not counted on
    assert {r.k1 for r in runs.frequent().collect()} == {1, 2, 3}
