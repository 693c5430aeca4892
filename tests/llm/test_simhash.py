import random
import re
from itertools import product

import numpy as np
import pytest
import xxhash

from vaultline.llm import simhash as S
from vaultline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    grams = [" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance=3):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if a < b and (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    return {f: find(f) for f in parent}


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    root, least = components(set(fps)), {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return sorted(((i, f"{f:016x}", least.get(root[f])) for (i, _), f in zip(rows, fps)), key=str)


def found(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in frame.collect()), key=str)


def test_matches_brute_force(spark, sample):
    assert found(QUERIES["op11_simhash_dedup"](spark, SF)) == expected(list(zip(sample.doc_id.tolist(), sample.text)))


def test_edges(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(S.simhash_dedup(edges)) == expected(rows)
    assert S.simhash_dedup(nothing).count() == 0


def test_long_texts_in_blocks(monkeypatch):
    texts = ["a b  c\td e f " * 50, "", "x", "one two", "Q " * 500]
    whole = S.chunk_fingerprints(S.T.Chunk.of([t.encode() for t in texts])).tolist()
    monkeypatch.setattr(S, "BLOCK", 7)
    assert S.chunk_fingerprints(S.T.Chunk.of([t.encode() for t in texts])).tolist() == whole == [fingerprint(t) for t in texts]


@pytest.mark.parametrize(("seed", "unit", "layout"), [(0, 4096, None), (1, 8, None), (2, 50, 1), (3, 4096, 2)])
def test_links_of_crowded_fingerprints(spark, monkeypatch, seed, unit, layout):
    """Many fingerprints within a few bits of each other, chains at the limit, and values that fill buckets."""
    rng = random.Random(seed)
    monkeypatch.setattr(S, "UNIT", unit)
    monkeypatch.setattr(S, "SMALL", 4)
    if layout is not None:
        monkeypatch.setattr(S, "LAYOUTS", (S.LAYOUTS[layout],))
    fps = {rng.getrandbits(64) for _ in range(200)} | {rng.getrandbits(12) << 30 for _ in range(150)}
    for _ in range(15):
        f = rng.getrandbits(64)
        for _ in range(20):
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 4])):
                f ^= 1 << b
            fps.add(f)
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long").repartition(5)
    got = S.links(frame).collect()
    pairs = {(r.a % 2**64, r.b % 2**64) for r in got}
    assert all((a ^ b).bit_count() and a in fps and b in fps for a, b in pairs)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    want = components(fps)
    assert len({(find(f), want[f]) for f in fps}) == len(set(want.values())) == len({find(f) for f in fps})


def test_thresholds_cost_least_and_are_complete():
    rng = np.random.default_rng(5)
    fps = np.concatenate([rng.integers(0, 2**63, 300).astype(np.uint64), rng.integers(0, 50, 100).astype(np.uint64)])
    order = np.arange(64)
    values = S.quarter_values(fps, order)
    counts = np.stack([np.bincount(values[:, q], minlength=1 << S.WIDTH) for q in range(S.QUARTERS)])
    costs = S.Costs(counts, 3)
    for layout in S.LAYOUTS:
        limits, cost = costs.thresholds(layout, values)
        assert (limits.sum(1) == 3 - len(layout) + 1).all() and (limits >= -1).all()
        by_part = [costs.of_part(p, values) for p in layout]
        choices = [c for c in product(range(5), repeat=len(layout)) if sum(c) == 4]
        for i in (0, 7, 350):
            assert cost[i] == pytest.approx(min(sum(by_part[k][t, i] for k, t in enumerate(c)) for c in choices))
    exact = costs.of_part((2,), values)[1] - S.PROBE
    assert exact[:5].tolist() == pytest.approx([float((values[:, 2] == v).sum()) for v in values[:5, 2]])


def test_correlated_bits_share_a_quarter():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (4000, 64)).astype(float)
    for k in range(1, 6):
        bits[:, k * 9] = np.where(rng.random(4000) < 0.95, bits[:, 0], bits[:, k * 9])
    order = S.correlated_quarters(bits.T @ bits, 4000)
    assert sorted(order.tolist()) == list(range(64))
    assert {0, 9, 18, 27, 36, 45} <= set(order[:16].tolist())
