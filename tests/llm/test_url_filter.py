import random

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from vaultline.llm import url_filter
from vaultline.llm.queries import QUERIES
from vaultline.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


def test_agrees_with_sql(spark):
    assert compare(spark, connect(SF), SF, "url", QUERIES["op10_url_filter"], ORACLES["op10_url_filter"])[0] == []


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_cascade_is_exact(spark, monkeypatch, bits):
    """Filters too small to be of use alone give many levels, and still exact membership."""
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", bits)
    monkeypatch.setattr(url_filter, "PROBES", 2)
    rng = random.Random(bits)
    keys = [(f"k{i}", rng.random() < 0.3) for i in range(800)]
    frame = spark.createDataFrame(keys, "key string, listed boolean")
    levels = url_filter.cascade(frame)
    assert len(levels) > (1 if bits < 12 else 0)
    wrong = frame.where(url_filter.member(levels, "key") != F.col("listed"))
    assert wrong.count() == 0


def test_list_is_bounded(spark):
    frame = spark.createDataFrame([(f"k{i}", True) for i in range(9)], "key string, listed boolean")
    with pytest.raises(ValueError, match="max_keys"):
        url_filter.cascade(frame, max_keys=8)


def test_more_keys_than_a_cascade_may_hold(spark, monkeypatch):
    """Every page is judged, by the cascade of its part, in later levels as well as in the first."""
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 4)
    monkeypatch.setattr(url_filter, "PROBES", 2)
    hosts = [(i, f"http://h{i}.com/{'de' if i % 4 == 0 else 'it'}/") for i in range(160)]
    pages = spark.createDataFrame([*hosts, *[(i + 160, f"http://h{i}.com/x") for i in range(160)], (999, None)], "page_id long, url string")
    keys = url_filter.judged_hosts(pages)
    with pytest.raises(ValueError, match="max_keys"):
        url_filter.cascade(keys, max_keys=15)
    parts = url_filter.cascades(keys, max_keys=15)
    assert len(parts) > 2 and sum(1 / m for m, _, _ in parts) == 1
    got = {r.page_id: r.verdict for r in url_filter.url_filter_parts(pages, parts).collect()}
    assert got == {999: "allow"} | {i + k: "allow" if i % 4 else "block" for i in range(160) for k in (0, 160)}


def test_edges(spark):
    urls = [None, "", "no scheme.org/", "http://", "HTTP://WWW.Example.ORG/es/x?y", "x://example.org/en/15#a://b", "x://example.org:80/es/",
            "http://a.com?q=/de/", "http://a.com/de/", "http://a.com/it/", "http://ÄB.com/fr/", "http://notexample.org/es/", "http://a.com/de/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    levels = url_filter.cascade(url_filter.judged_hosts(pages))
    got = {r.page_id: tuple(r)[1:5] for r in url_filter.url_filter(pages, levels).collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("www.example.org", "/es/x", "example.org/es/", "block"), 5: ("example.org", "/en/15", "example.org/en/1", "block"),
        6: ("example.org:80", "/es/", None, "allow"), 7: ("a.com", "", None, "block"), 8: ("a.com", "/de/", "com/de/", "block"),
        9: ("a.com", "/it/", None, "block"), 10: ("Äb.com", "/fr/", "com/fr/", "allow"), 11: ("notexample.org", "/es/", "org/", "allow"),
        12: ("a.com", "/de/", "com/de/", "block"),
    }
    empty = pages.limit(0)
    assert url_filter.url_filter(empty, url_filter.cascade(url_filter.judged_hosts(empty))).count() == 0


def test_no_python_in_the_plan(spark, plan):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    text = plan(url_filter.url_filter(pages, url_filter.cascade(url_filter.judged_hosts(pages))))
    assert "Python" not in text and "Arrow" not in text and "Join" not in text
