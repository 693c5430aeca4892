import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from oracle import compare, connect

from vaultline.llm import prefix_trie as P
from vaultline.llm.queries import QUERIES
from vaultline.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuild(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    paths = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(paths.get(c - int(np.fmod(c, 20)), [])[:h] + own[h:])
    return out


def brute(paths):
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        yield node
        for child in children[node]:
            yield from below(child)

    out = []
    for node, convs in members.items():
        subtree = list(below(node))
        saved = sum((len(members[v]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", v[-1][1])) for v in subtree if v)
        ends = ",".join(str(c) for c in convs if paths[c] == node)
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children[node]),
                    sum(not children[v] for v in subtree), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


def random_rows(seed, n, longest=6):
    rng, rows = random.Random(seed), []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        hot = rng.random() < 0.5
        for t in range(rng.randint(1, longest)):
            text = "hello  there" if hot and t < 2 else rng.choice(["a", "b c", "", None, "d\te\nf"])
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", None]) if not hot else "user", text))
    return rows


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_agrees_with_sql(spark, sf):
    problems, n = compare(spark, connect(sf), sf, "op12_prefix_trie", QUERIES["op12_prefix_trie"], ORACLES["op12_prefix_trie"])
    assert not problems and n


@pytest.mark.parametrize(("seed", "shards"), [(0, 1), (1, 3), (2, 17), (3, 60)])
def test_matches_brute_force(spark, monkeypatch, seed, shards):
    """Few turns to choose from, so that many conversations share beginnings and shards cut through them."""
    rows = random_rows(seed, 150)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    paths = P.rebuilt(P.turns_of(frame))
    turns = sum(len(p) + 1 for p in set(rebuild(rows).values()))
    monkeypatch.setattr(P, "SHARD_TURNS", -(-turns // shards))
    monkeypatch.setattr(P, "LEAST_TURNS", 1)
    assert found(P.trie_nodes(paths)) == brute(rebuild(rows))


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, pos int, path string"
    rows = [
        (None, 1, "user", "no conversation"), (3, None, None, None), (3, 1, "user", "x " * 300_000), (3, 1, "user", "x " * 300_000), (7, 5, "b", "tie"),
        (7, 5, "a", "tie"), (24, 1, "user", "only"), (-5, 1, "user", "only"), (40, 1, "u", "ser:"), (60, 1, "us", "er:"), (61, 2, "us", "er:"),
    ]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], schema)
    assert found(P.prefix_trie(frame)) == brute(rebuild(rows))
    assert found(P.prefix_trie(spark.createDataFrame([], schema))) == []


def test_long_conversations(spark):
    rows = [(c, t, "user", f"turn {t}" if t < 3000 or c == 1 else f"own {t}") for c in (0, 1) for t in range(3200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes = {(r.depth, r.conv_id): r for r in P.prefix_trie(frame).collect()}
    assert nodes[0, 0].n_leaves == 2 and nodes[3000, 0].n_children == 2 and len(nodes) == 3401 and nodes[0, 0].saved_tokens == 6000


@pytest.mark.parametrize("n", [1, 2, 40, 3000])
def test_parentheses(n):
    rng = np.random.default_rng(n)
    sequence, depth = [True], 1
    while len(sequence) < n or depth:
        is_open = depth > 0 and len(sequence) < n and rng.random() < 0.6
        sequence.append(bool(is_open))
        depth += 1 if is_open else -1
        if depth == 0:
            break
    stack, close = [], {}
    for i, is_open in enumerate(sequence):
        if is_open:
            stack.append(i)
        else:
            close[stack.pop()] = i
    parens = P.Parens(np.array(sequence))
    at = np.array(sorted(close))
    found_ = parens.find_close(at)
    assert found_.tolist() == [close[i] for i in at.tolist()]
    pairs = [sum(sequence[k] and not sequence[k + 1] for k in range(a, b)) for a, b in zip(at.tolist(), found_.tolist())]
    assert parens.leaves(at, found_).tolist() == pairs
