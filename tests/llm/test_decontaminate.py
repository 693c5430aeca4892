import hashlib
import random
import re

import pytest
from oracle import compare, connect

from vaultline.llm import decontaminate
from vaultline.llm.queries import QUERIES
from vaultline.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i: i + window]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, got = words(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if found := wins.get(tuple(w[i: i + n])):
                    hit.update(range(i, i + n))
                    got |= found
        out.append((len(w), len(hit), len(got), hashlib.sha256(",".join(sorted(got)).encode()).hexdigest(), bool(hit)))
    return out


def test_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, "leaks", QUERIES["op4_decontamination"], ORACLES["op4_decontamination"])[0] == []


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_matches_brute_force(spark, block_words):
    """Few words, so that windows overlap and repeat; items of every length, repeated and without words."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice("a b C, dé E9 f".split()) for _ in range(n))
    items = [(i // 2 if i % 5 else None, text(rng.choice([0, 1, 2, 3, 4, 9, 10, 11, 15]))) for i in range(25)] + [(99, None), (98, "...")]
    items = [(i, t) for i, t in items if len(words(t)) not in (1, 2) or i == 3]
    docs = [(i, text(rng.choice([0, 1, 5, 20, 300]))) for i in range(120)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r[0]: tuple(r)[1:6] for r in decontaminate.contamination(frame, bench, block_words=block_words).collect()}
    want = brute([t for _, t in docs], items)
    assert got == dict(enumerate(want))
    assert any(x[-1] for x in want) and not all(x[-1] for x in want)
    kept = {r.doc_id for r in decontaminate.remove_contaminated(frame, bench, block_words=block_words).collect()}
    assert kept == {i for i, x in enumerate(want) if not x[-1]}


def test_longest_matches(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(1, f"x y {passage} z"), (2, " ".join(f"w{i}" for i in range(5, 17)))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, f"q {passage}"), (8, "x y")], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.verbatim_matches(docs, bench).collect()))
    assert got == [(1, 0, 2, "8"), (1, 2, 25, "7"), (2, 0, 12, "7")]


def test_edges(spark, edges, nothing):
    bench = spark.createDataFrame([(1, "another text under the same id"), (None, "more or less"), (2, None), (3, "word " * 12)], "item_id long, text string")
    rows = edges.collect()
    got = sorted((tuple(r)[:6] for r in decontaminate.contamination(edges, bench).collect()), key=str)
    assert got == sorted(((r.doc_id, *b) for r, b in zip(rows, brute([r.text for r in rows], [(r.item_id, r.text) for r in bench.collect()]))), key=str)
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(edges, bench.limit(0)).collect())
    assert decontaminate.remove_contaminated(edges, bench).columns == edges.columns
