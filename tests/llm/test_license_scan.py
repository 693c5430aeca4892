import re

import pytest

from vaultline.llm.license_scan import BASE, automaton, evaluate, license_scan, parse, scan
from vaultline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, BASE[p]) for p in BASE for i in range(len(words)) if words[i: i + len(p.split())] == p.split()]
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({x for _, x in places})))


def test_base_matches_brute_force(spark, sample):
    got = {r["doc_id"]: r for r in QUERIES["op5_license_scan"](spark, SF).collect()}
    assert len(got) == len(sample)
    for doc_id, text in zip(sample.doc_id, sample.text):
        r = got[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_edges(spark, edges, nothing):
    rows = license_scan(edges).collect()
    assert len(rows) == edges.count() and all(r.n_base == 0 and r.first_word is None and r.labels == "" for r in rows)
    assert license_scan(nothing).count() == 0


@pytest.mark.parametrize(("text", "labels", "score"), [
    ("CC  BY\n\nand the MIT-License, MIT license", "cc-by,mit", 0.9),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */", "apache,gpl,mit", 1.0),
    ("SPDX-License-Identifier: (MIT OR", "", 0.3),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc", 0.9),
    ("a cc bypass, an xmit license", "", 0.0),
    ("Mozilla Public License", "mpl", 0.6),
])
def test_labels(spark, text, labels, score):
    row = license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, row.score) == (labels, score)
    assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == brute(text)


def test_expressions():
    assert evaluate(parse("a or b and c with d"))[1] == "(a or (b and (c with d)))"
    assert evaluate(parse("(a or b) and c"))[1] == "((a or b) and c)"
    assert evaluate(parse("a and b and c"))[1] == "((a and b) and c)"
    assert [parse(x) for x in ("", "and", "a and", "(a", "a)", "()")] == [None] * 6


def test_many_phrases_in_one_long_text():
    """A hundred thousand phrases take time in proportion to the text."""
    import time

    machine, start = automaton(), time.time()
    found = scan(b"mit license and more. " * 100_000, machine)
    assert found[:5] == (400_000, 100_000, 0, 4 * 99_999, "mit") and time.time() - start < 20
