import hashlib
import random

import numpy as np
import pytest

from vaultline.llm import substring_dedup as S
from vaultline.llm.queries import QUERIES
from vaultline.llm.suffix_array import suffix_arrays

SF = "/root/testdata/sf0.001"


def brute(docs, length=100):
    """Documents in order, as (any key, bytes)."""
    seen, out = set(), {}
    for key, data in docs:
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            w = data[s: s + length]
            if w in seen:
                gone[s: s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(100):
        strings = []
        for _ in range(rng.randint(1, 9)):
            kinds = rng.choice([1, 2, 3, 26])
            s = [rng.randint(1, kinds) for _ in range(rng.randint(0, 50))]
            strings.append(s * rng.choice([1, 1, 3]) + [0])
        offsets = np.cumsum([0, *map(len, strings)])
        got = suffix_arrays(np.array([x for s in strings for x in s]), offsets)
        for s, a in zip(strings, offsets):
            assert (got[a: a + len(s)] - a).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_matches_brute_force(spark, sample):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op1_substring_dedup"](spark, SF).collect()}
    want = brute([(i, t.encode()) for i, t in sorted(zip(sample.doc_id.tolist(), sample.text))])
    assert got == want and sum(x[1] for x in want.values()) > 0


@pytest.mark.parametrize("split", [(64, 4096), (1, 4096), (1, 1)])
@pytest.mark.parametrize("seed", range(3))
def test_planted_passages(spark, monkeypatch, seed, split):
    """Passages with different surroundings, within and across documents, periodic texts and single letters; anchors
    whole, in pieces, and by single strings."""
    monkeypatch.setattr(S, "SPLIT", split)
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefghij é\n") for _ in range(n))
    passages = [noise(rng.choice([95, 99, 100, 101, 130, 400])) for _ in range(6)] + ["x" * 230, "ab" * 90, "abc" * 70]
    docs = []
    for i in range(80):
        text = "".join(rng.choice([noise(rng.randint(0, 120)), rng.choice(passages)]) for _ in range(rng.randint(0, 6)))
        docs.append((i, text))
    docs += [(80 + k, docs[k][1]) for k in range(5)]
    frame = spark.createDataFrame(rng.sample(docs, len(docs)), "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in S.substring_dedup(frame).collect()}
    assert got == brute([(i, t.encode()) for i, t in docs])


def test_edges(spark, edges, nothing):
    rows = edges.collect()
    got = S.substring_dedup(edges).collect()
    assert len(got) == len(rows)
    texts = sorted({(r.doc_id is not None, r.doc_id, (r.text or "").encode()) for r in rows}, key=str)
    want = brute([(k, k[2]) for k in texts])
    assert sorted(tuple(r) for r in got if r.doc_id) == sorted((r.doc_id, *want[True, r.doc_id, (r.text or "").encode()]) for r in rows if r.doc_id)
    assert S.substring_dedup(nothing).count() == 0


def test_null_and_equal_ids_are_ordered(spark):
    text = "a passage " * 3 + "".join(chr(97 + i * i % 26) for i in range(120))
    frame = spark.createDataFrame([(5, "z" + text), (None, text), (5, text + "!"), (5, text + "!")], "doc_id long, text string")
    rows = sorted(map(tuple, S.substring_dedup(frame).collect()), key=str)
    assert [r[2] for r in rows if r[0] is None] == [0]
    assert [r[2] for r in rows if r[0] == 5] == [len(text)] * 3


@pytest.mark.parametrize("split", [(64, 4096), (1, 4096)])
def test_a_stretch_is_brought_to_the_arrays_once(spark, monkeypatch, split):
    """The rows of the operator's tasks, but for those that read every document's anchors, do not grow with copies."""
    made, map_arrow = [], S.map_arrow

    def counted(df, run, schema):
        out = map_arrow(df, run, schema)
        made.append((run.__qualname__.split(".")[0], out))
        return out

    monkeypatch.setattr(S, "SPLIT", split)
    monkeypatch.setattr(S, "map_arrow", counted)
    rng = random.Random(1)
    noise = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = noise(150)
    texts = [noise(200) + passage + noise(200) for _ in range(12)]
    rows = {}
    for times in (1, 6):
        made.clear()
        docs = [(k * len(texts) + i, t) for k in range(times) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartitionByRange(times, "doc_id")
        got = {r[0]: tuple(r)[1:] for r in S.substring_dedup(frame).collect()}
        assert got == brute([(i, t.encode()) for i, t in docs])
        rows[times] = {k: df.count() for k, df in made if k not in ("repeated_anchors", "occurrences", "array_ranges", "remove")}
    assert rows[1]["stretch_bytes"] > 0 and rows[1] == rows[6]
