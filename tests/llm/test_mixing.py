import random
from collections import defaultdict

import duckdb
import pytest
from oracle import compare, connect

from vaultline.llm import mixing
from vaultline.llm.queries import QUERIES
from vaultline.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


def test_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, "mix", QUERIES["op6_source_mix"], ORACLES["op6_source_mix"])[0] == []


def water(sizes, weights=(1, 2, 3), cap=3):
    """Shares by weight; what is over a cap goes round again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, goal = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * left / total > cap * sizes[s] + 1e-9}
        if not over:
            goal.update({s: weight[s] * left / total for s in open_})
            break
        for s in over:
            goal[s] = cap * sizes[s]
        left -= sum(cap * sizes[s] for s in over)
        open_ -= over
    return goal


@pytest.mark.parametrize("seed", range(3))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 50, 1000, 20000]) for i in range(8)} | {None: 7}
    rows = mixing.targets(spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")).collect()
    goal = water(sizes)
    assert {r.source for r in rows} == set(sizes)
    for r in rows:
        assert r.target == pytest.approx(goal[r.source], abs=1e-6)


def test_exact_budgets_and_edges(spark, edges, nothing):
    rows = mixing.mix(edges, range_rows=1).collect()
    assert len(rows) == edges.count()
    taken = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for r in rows:
        assert abs(taken[r.source] - r.target) <= 0.5
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix(edges).collect()), key=str)  # ranges change nothing
    assert mixing.mix(nothing).count() == 0
    assert mixing.mix(edges.where("text is null or text = ''")).select("target", "taken").distinct().collect() == [(0.0, 0)]


def test_sql_words():
    sql = duckdb.sql(r"select len(regexp_extract_all(e'a\u00a0b c\x0bd', '[^\x20\x09-\x0D]+'))")
    assert sql.fetchall()[0][0] == 3
