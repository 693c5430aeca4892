import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vaultline.operators import profile
from vaultline.sources.readers import read_csv, read_stored


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "smooth": rng.normal(0, 50, 4001), "lumpy": rng.choice([1.0, 2.0, 2.0, 2.0, 9.0], 4001),
        "heavy": np.where(rng.random(4001) < 0.01, 1e12, rng.random(4001)), "whole": rng.integers(-5, 6, 4001),
    })
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize(("size", "share"), [(64, 0.05), (512, 0.01), (profile.SKETCH_SIZE, profile.BRACKET_SHARE)])
def test_describe_is_exact_at_any_sketch_accuracy(numbers, monkeypatch, size, share):
    monkeypatch.setattr(profile, "SKETCH_SIZE", size)
    monkeypatch.setattr(profile, "BRACKET_SHARE", share)
    pdf, df = numbers
    want = pdf.describe().T
    for r in profile.describe(df).collect():
        w = want.loc[r.column_nm]
        assert r.value_count == w["count"] and r.min_value == w["min"] and r.max_value == w["max"]
        assert (r.p25, r.p50, r.p75) == pytest.approx((w["25%"], w["50%"], w["75%"]), rel=1e-12)
        assert (r.mean_value, r.std_value) == pytest.approx((w["mean"], w["std"]), rel=1e-9)


def test_describe_edges(spark):
    df = spark.createDataFrame([(1.0, None, None), (2.0, 5.0, float("nan")), (4.0, None, None), (9.0, None, None)], "a double, b double, c double")
    got = {r.column_nm: r for r in profile.describe(df).collect()}
    assert (got["a"].p25, got["a"].p50, got["a"].p75) == (1.75, 3.0, 5.25)
    assert got["b"].value_count == 1 and got["b"].p50 == 5.0 and got["b"].std_value is None
    assert got["c"].value_count == 0 and got["c"].p50 is None


@pytest.mark.parametrize("bins", [1, 5, 20, 50])
def test_histogram_as_numpy(numbers, bins):
    pdf, df = numbers
    for column in pdf.columns:
        counts, edges = np.histogram(pdf[column], bins)
        got = sorted(profile.histogram(df, column, bins).collect(), key=lambda r: r.bin)
        assert [r.row_count for r in got] == list(counts)
        assert [r.bin_low for r in got] == pytest.approx(edges[:-1])
        assert got[-1].bin_high == pytest.approx(edges[-1])


def test_histogram_edges(spark):
    same = spark.createDataFrame([(3.0,), (3.0,), (None,)], "v double")
    got = sorted(profile.histogram(same, "v", 4).collect(), key=lambda r: r.bin)
    assert [r.row_count for r in got] == list(np.histogram([3.0, 3.0], 4)[0])
    assert profile.histogram(same.where("v is null"), "v", 4).isEmpty()
    with pytest.raises(ValueError):
        profile.histogram(same, "v", 0)


def test_value_counts_and_pairs(spark, rows):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "v string, n int")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [("b", 2), ("a", 1)]
    assert rows(profile.pairs(df, "n", "v"), "x") == [(1,), (2,), (3,), (4,)]
    assert profile.pairs(df, "n", "v", 0.0).isEmpty()


def test_csv(spark, tmp_path, rows):
    path = tmp_path / "t.csv"
    path.write_text("YEAR,DEC,NOV\n1990/91,-1.5,2\n1991/92,,3.25\n")
    df = read_csv(spark, str(path))
    assert df.dtypes == [("YEAR", "string"), ("DEC", "double"), ("NOV", "double")]
    assert rows(profile.describe(df), "column_nm", "value_count") == [("DEC", 1), ("NOV", 2)]
    assert read_csv(spark, str(path), "YEAR string, DEC string, NOV string").dtypes[1] == ("DEC", "string")


def test_read_stored(spark, tmp_path):
    assert read_stored(spark, str(tmp_path / "none")) is None
    spark.range(3).select(F.col("id")).write.parquet(str(tmp_path / "some"))
    assert read_stored(spark, str(tmp_path / "some")).count() == 3


def test_no_sketch_of_all_rows_and_no_window_over_a_column(numbers, plan):
    _, df = numbers
    text = plan(profile._summary(df.repartition(4), ["smooth", "heavy"]))
    assert "percentile_approx" not in text and text.count("kll_merge_agg_double") >= 2
    assert "hashpartitioning(_group" in text


def test_a_sample_of_pairs_has_its_size_and_is_the_same_again(numbers, plan):
    _, df = numbers
    first = profile.pairs(df, "smooth", "whole", rows=50)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, profile.pairs(df.repartition(7), "smooth", "whole", rows=50).collect()))
    assert first.count() == 50 and "TakeOrderedAndProject" in plan(first)
