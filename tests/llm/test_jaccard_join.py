import random
import re
import time
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

from vaultline.llm import jaccard_join as J
from vaultline.llm.common import SHUFFLE_CLEANUP, shuffles_freed
from vaultline.llm.components import components
from vaultline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return set(zip(*[w[i:] for i in range(k)])) if len(w) >= k else {tuple(w)} - {()}


def brute(texts, k=3, percent=90):
    """Set size and first linked position of each text."""
    sets, parent = [shingles(t, k) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and 100 * n >= percent * (len(a) + len(sets[j]) - n):
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_matches_brute_force(spark, sample):
    rows = sorted(zip(sample.doc_id.tolist(), sample.text))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_jaccard_join"](spark, SF).collect()}
    assert got == {rows[i][0]: (n, rows[c][0]) for i, (n, c) in enumerate(brute([t for _, t in rows]))}


@pytest.mark.parametrize(("seed", "k", "percent", "parts_from"), [(0, 3, 90, 60), (1, 3, 90, 12), (2, 5, 80, None), (3, 5, 80, 30)])
def test_chains_at_the_border(spark, monkeypatch, seed, k, percent, parts_from):
    """Texts that drift by a word at a time: links exactly at the limit, members linked with each other and not with
    their group's smallest class, groups cut into many units."""
    monkeypatch.setattr(J, "UNIT", 4)
    monkeypatch.setattr(J, "GROUP", 3)
    rng = random.Random(seed)
    texts = []
    for size in (3, 9, 11, 12, 20, 21, 30, 60, 200):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(size + 2)]
        for _ in range(12):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.choice([1, 1, 2, max(1, size // 60)])):
                if rng.random() < 0.5:
                    base[rng.choice([0, -1, rng.randrange(len(base))])] = f"w{rng.randint(0, 10**6)}"
                elif rng.random() < 0.5:
                    base.append(f"w{rng.randint(0, 10**6)}")
                else:
                    base.pop(0)
    rng.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(frame, k, percent, parts_from).collect()}
    want = dict(enumerate(brute(texts, k, percent)))
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < len(texts)
    kept = {r.doc_id for r in J.keep_one(frame, k, percent, parts_from).collect()}
    assert kept == {c for _, c in want.values()}


def test_marks_of_near_sets_agree():
    """Any two sets at the limit share a mark, whatever their sizes and whatever is common."""
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 1 << 10, dtype=np.uint64)
    for size in [*range(9, 60), 100, 333, 1000, 5000]:
        for _ in range(5):
            big = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            gone = int(rng.integers(0, len(big) // 10 + 1))
            small = np.sort(rng.permutation(big)[: len(big) - gone])
            if 100 * len(small) >= 90 * len(big):
                for parts_from in (60, 20, None):
                    a, b = (set(J.marks_of(x, common, 90, parts_from).tolist()) for x in (big, small))
                    assert a & b


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100 + rng.randint(0, 40), 100 + rng.randint(0, 40)) for _ in range(30)] + [(200, 200 + i) for i in range(50)]
    parent = defaultdict(lambda: None)

    def find(x):
        while parent[x] is not None:
            x = parent[x]
        return x

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        if p != q:
            parent[q] = p
    got = {r.v: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: find(v) for a, b in links if a != b for v in (a, b)}


def test_edges(spark, edges, nothing):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_join(edges).collect()}
    assert {(None, 3, None), (2, 0, 2), (3, 0, 3), (4, 0, 4)} <= rows
    assert len([1 for r in J.jaccard_join(edges).collect()]) == edges.count()
    assert J.jaccard_join(nothing).count() == 0
    kept = J.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 2, 3, 4, 5, 6]
    assert J.keep_one(nothing).count() == 0


def test_comparable_orders_sizes_not_members(spark, plan, monkeypatch):
    """Groups with equal, near and far sizes against all pairs; the window sees each size of a group once."""
    rng = random.Random(5)
    rows = [(bytes([g]), bytes([g, k]), 100 + g, rng.choice([100 + g, 120 + 5 * g, 200, 7 * k + 10])) for g in range(12) for k in range(rng.choice([1, 2, 40]))]
    stars = spark.createDataFrame(rows, "a binary, b binary, na int, nb int")
    want, every = set(), {r[0] for r in rows} | {r[1] for r in rows}
    for g in {r[0] for r in rows}:
        members = {(b, nb) for a, b, _, nb in rows if a == g} | {(a, na) for a, _, na, _ in rows if a == g}
        want |= {c for c, n in members for d, m in members if c != d and 100 * min(n, m) >= 90 * max(n, m)}
    plans = []
    monkeypatch.setattr(J, "stored", lambda df, name, f=J.stored: plans.append(plan(df)) or f(df, name))
    found = J.comparable(stars.repartition(3), 90)
    assert {bytes(r.c) for r in found.collect()} == want and 0 < len(want) < len(every)
    plans.append(plan(found))
    windows = [text for text in plans if "Window" in text]
    assert windows and all("count(1)" in text[text.rindex("Window"):] for text in windows)


def near_sets(rng, size, other, shared):
    """Two sets of random tokens, with their sizes and what they share."""
    tokens = np.unique(rng.integers(0, 2**63, 2 * (size + other), dtype=np.uint64))
    rng.shuffle(tokens)
    return np.sort(tokens[:size]), np.sort(np.concatenate([tokens[:shared], tokens[size: size + other - shared]]))


@pytest.mark.parametrize("sizes", [(9000, 9000), (40000, 36000), (4100, 4090), (300, 290)])
def test_large_sets_are_told_apart_by_their_bins(sizes):
    """Sets of some thousand tokens with nothing in common are ruled out, those at the limit never are."""
    rng = np.random.default_rng(sum(sizes))
    for shared, want in ((0, False), (min(sizes), True)):
        a, b = near_sets(rng, *sizes, shared)
        rows = [(name, name, len(s), J.bins_of_set(s)) for name, s in ((b"a", a), (b"b", b))]
        for one, two in (rows, rows[::-1]):
            q, m = J.within_bounds([one], [two, (b"c", one[1], one[2], one[3])], 80)
            assert q.tolist() == [want] and m.tolist() == [want, False]


def test_bins_never_bound_too_low():
    """Whatever the widths: a set against one of another number of bins, one bin full, groups of mixed sizes."""
    rng, percent = np.random.default_rng(4), 80
    pairs = [near_sets(rng, size, size - size // 10, size - size // 10) for size in (8, 200, 2048, 2200, 4096, 4300, 9000, 17000)]
    pairs.append((np.arange(1, 300, dtype=np.uint64), np.arange(1, 290, dtype=np.uint64)))
    bins = [[J.bins_of_set(s) for s in pair] for pair in pairs]
    assert len({len(x) for pair in bins for x in pair}) > 4 and any(len(a) != len(b) for a, b in bins)
    at_most = J.common_at_most([a for a, _ in bins], [b for _, b in bins])
    assert all(n >= len(np.intersect1d(*pair)) for n, pair in zip(at_most.tolist(), pairs))
    full = bytes([J.FULL_BIN]) + bytes(J.BINS - 1)
    assert J.common_at_most([full], [full])[0] >= 2**31
    queries = [(b"q%d" % i, b"q%d" % i, len(a), bins[i][0]) for i, (a, _) in enumerate(pairs)]
    members = [(b"m%d" % i, b"m%d" % i, len(b), bins[i][1]) for i, (_, b) in enumerate(pairs)]
    q, m = J.within_bounds(queries, members, percent)
    assert q.all() and m.all()


def test_a_class_is_once_in_a_unit(spark, monkeypatch):
    """Members that are queries as well bring their tokens to a unit once."""
    monkeypatch.setattr(J, "UNIT", 4)
    rng, seen = random.Random(8), []
    texts = []
    for _ in range(3):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(40)]
        for _ in range(12):
            texts.append(" ".join(base))
            base = list(base)
            base[rng.randrange(40)] = f"w{rng.randint(0, 10**6)}"
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)

    def kept(df, name, f=J.stored):
        out = f(df, name)
        if name == "near-members":
            seen.extend((r.a, r.block, r.query_block, r.b) for r in out.collect())
        return out

    monkeypatch.setattr(J, "stored", kept)
    got = {r.doc_id: r.component_id for r in J.jaccard_join(frame, 3, 80, None).collect()}
    assert got == {i: c for i, (_, c) in enumerate(brute(texts, 3, 80))}
    assert seen and len(seen) == len(set(seen))


def test_disk_is_given_back(spark, sample):
    """Marks and sets have gone when the rows are read, and the session's setting is as before."""
    frame = spark.createDataFrame([(int(i), t) for i, t in zip(sample.doc_id[:60], sample.text[:60])], "doc_id long, text string").repartition(3)
    folder = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    names = lambda: {p.name for p in folder.rglob("*-*") if p.is_dir() and any(p.glob("*.parquet"))}
    before = names()
    setting = spark.conf.get(SHUFFLE_CLEANUP, None)
    found = J.jaccard_join(frame, 3, 80, None)
    left = {n.rsplit("-", 1)[0] for n in names() - before}
    assert "placed" in left and not left & {"marks", "mark-members", "shared-marks", "sets", "classes"}
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert sorted(found.collect()) == sorted(found.collect()) and found.count() == 60


def test_shuffles_are_freed(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    local = [Path(d.getPath()) for d in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    count = lambda: {f.name for d in local for f in d.rglob("shuffle_*")}
    before = count()
    with shuffles_freed(spark):
        spark.range(1000).repartition(3, "id").groupBy("id").count().write.parquet(str(tmp_path / "x"))
    for _ in range(100):  # they go in the background
        if not (left := count() - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.read.parquet(str(tmp_path / "x")).count() == 1000
