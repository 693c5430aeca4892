import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle import compare, connect

from vaultline.llm import collocations as C
from vaultline.llm.queries import QUERIES
from vaultline.llm.sql import ORACLES

SF = "/root/testdata/sf0.01"
UPPER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER))]


def brute(rows, support, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for words in pieces(text):
            total[lang or "und"] += len(words)
            for k in range(1, 6):
                counts[lang or "und"].update(tuple(words[i: i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, found in counts.items():
        frequent = {p: a for p, a in found.items() if a >= support and len(p) > 1}
        kept = []
        for p, a in frequent.items():
            if any(b >= a and len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in frequent.items()):
                continue
            score, k = min((1000 * a * total[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_agrees_with_sql(spark):
    problems, _ = compare(spark, connect(SF), SF, "op13_collocations", QUERIES["op13_collocations"], ORACLES["op13_collocations"])
    assert not problems


@pytest.mark.parametrize(("support", "shard_words"), [(4, 12_000_000), (4, 500), (2, 3000), (9, 1500)])
def test_matches_brute_force(spark, sample, monkeypatch, support, shard_words):
    """Any number of shards, so that the lowered support is anything from the support to one."""
    monkeypatch.setattr(C, "SHARD_WORDS", shard_words)
    monkeypatch.setattr(C, "MOST_WORDS", shard_words)
    monkeypatch.setattr(C, "LEAST_SHARDS", 3)
    monkeypatch.setattr(C, "HELD", 50)
    rows = [(r.lang if i % 7 else None, " ".join(r.text.split(" ")[:60])) for i, r in enumerate(sample.itertuples())][:120]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    want = brute(rows, support, 40)
    assert want and found(C.collocations(frame, support, top=40)) == want


def test_edges(spark, edges, nothing):
    rows = [(r.lang, r.text) for r in edges.collect()]
    assert found(C.collocations(edges, 2)) == brute(rows, 2)
    assert found(C.collocations(nothing, 2)) == []
    ties = [("und", "b c. a b. a b"), (None, "b c; A\tB,,c"), ("x", "p q r s t u v\vp q r s t u v"), ("x", None), ("x", "q p")]
    frame = spark.createDataFrame(ties, "lang string, text string")
    assert found(C.collocations(frame, 2)) == brute(ties, 2)


def test_long_texts_keep_their_hashes():
    text = (b"ab cd. efg  " * 400 + b"x" * 700 + b" end")
    chunk = C.T.Chunk.of([text, b"", b"one two"])
    starts, ends, _ = chunk.runs(C.WORDS)
    whole = chunk.hashes(starts, ends)
    assert (chunk.hashes(starts, ends, block=64) == whole).all()
    assert (chunk.hashes(starts[::-1], ends[::-1], block=64) == whole[::-1]).all()


def test_products_beyond_64_bits(spark):
    big = 4 * 10**12
    frequent = spark.createDataFrame([("x", "p q", 2, big), ("x", "p", 1, big + 1), ("x", "q", 1, big + 2)], "lang string, phrase string, words int, a long")
    totals = spark.createDataFrame([("x", 9 * 10**15)], "lang string, n long")
    row = C.scored(frequent, totals).first()
    assert row.score == 1000 * big * 9 * 10**15 // ((big + 1) * (big + 2))


@pytest.mark.parametrize("size", [10**6, 90])
def test_shards_are_mined_completely(monkeypatch, size):
    monkeypatch.setattr(C, "PASS", size)
    monkeypatch.setattr(C, "BLOCK", 64)
    rng = np.random.default_rng(3)
    words, joined = rng.integers(0, 6, 400).astype(np.uint64) * 977, rng.random(400) < 0.9
    kinds, times = C.mine(words, joined, 5, 11)
    got, want = dict(zip(kinds.tolist(), times.tolist())), {}
    for n in range(1, 6):
        at = np.array([i for i in range(400 - n + 1) if joined[i: i + n - 1].all()])
        kinds, times = np.unique(C.hashes_at(words, at, n, 11), return_counts=True)
        want |= dict(zip(kinds[times >= 5].tolist(), times[times >= 5].tolist()))
    assert got == want
