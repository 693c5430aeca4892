import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vaultline.operators import cdc, scd2
from vaultline.specs import GEOMETRY, ColumnSpec, TableSpec

SPEC = TableSpec("people", (
    ColumnSpec("id", "int", is_key=True), ColumnSpec("sub", is_key=True), ColumnSpec("name"), ColumnSpec("city"),
    ColumnSpec("note", keep_history=False),
))
SCHEMA = "id int, sub string, name string, city string, note string"
VERSIONED = SCHEMA + ", start_dt timestamp_ntz, end_dt timestamp_ntz, curr_ind string"
STORED = [
    (1, "A", "ann", "rome", "x"), (2, "A", "bob", "oslo", "x"), (3, "A", "cat", None, "x"),
    (4, "A", "dan", "bern", "x"), (5, "A", "eve", "wien", "x"),
]
STAGED = [
    (1, "A", "ann", "rome", "x"), (2, "A", "bob", "paris", "x"), (3, "A", "cat", "lima", "x"),
    (4, "A", "dan", "bern", "CHANGED"), (6, "A", "fay", "roma", "x"), (7, None, "gus", "nice", "x"),
    (None, "A", "hal", "pisa", "x"),
]
CHANGES = [
    ("ADD", 6, "A", "fay", "N", "roma", "N"),
    ("MODIFY", 2, "A", "bob", "N", "paris", "Y"),
    ("REMOVE", 5, "A", "eve", "N", "wien", "N"),
]
SHOWN = ("dlt_operation_nm", "id", "sub", "name", "name_upd_ind", "city", "city_upd_ind")


def history(spark, data, start="2024-01-01 00:00:00"):
    df = spark.createDataFrame(data, SCHEMA)
    return df.select(
        "*", F.lit(start).cast("timestamp_ntz").alias("start_dt"),
        F.lit("9999-12-31 00:00:00").cast("timestamp_ntz").alias("end_dt"), F.lit("Y").alias("curr_ind"),
    )


@pytest.fixture(scope="module")
def stg(spark):
    return spark.createDataFrame(STAGED, SCHEMA)


@pytest.fixture(scope="module")
def sds(spark):
    return history(spark, STORED)


def test_reference_comparison(stg, sds, rows):
    assert rows(cdc.delta(stg, sds, SPEC), *SHOWN) == CHANGES


def test_null_safe_sees_null_to_value(stg, sds, rows):
    got = rows(cdc.delta(stg, sds, SPEC, null_safe=True), *SHOWN)
    assert got == sorted([*CHANGES, ("MODIFY", 3, "A", "cat", "N", "lima", "Y")])


def test_null_keys_kept_as_the_host_does(stg, sds, rows):
    got = rows(cdc.delta(stg, sds, SPEC, on_null_key="ref"), *SHOWN)
    extra = [("ADD", None, None, None, "N", None, "N"), ("ADD", 7, None, "gus", "N", "nice", "N")]
    assert got == sorted([*CHANGES, *extra], key=lambda t: [(v is not None, str(v)) for v in t])


def test_null_keys_listed(stg, rows):
    assert rows(cdc.null_keyed(stg, SPEC), "name") == [("gus",), ("hal",)]


def test_null_keys_fail(stg, sds):
    with pytest.raises(Exception, match="NULL natural key"):
        cdc.delta(stg, sds, SPEC, on_null_key="error").collect()


def test_error_mode_passes_clean_data(stg, sds, rows):
    clean = stg.dropna(subset=["id", "sub"])
    assert rows(cdc.delta(clean, sds, SPEC, on_null_key="error"), *SHOWN) == CHANGES


def test_changes_only_snapshot_removes_nothing(stg, sds, rows):
    got = rows(cdc.delta(stg, sds, SPEC, snapshot_type="DELTA"), *SHOWN)
    assert got == [c for c in CHANGES if c[0] != "REMOVE"]


def test_closed_versions_do_not_take_part(spark, stg, sds, rows):
    closed = history(spark, [(6, "A", "old", "old", "x")]).withColumn("curr_ind", F.lit("N"))
    assert rows(cdc.delta(stg, sds.unionByName(closed), SPEC), *SHOWN) == CHANGES


def test_repeated_staged_key_is_classified_row_by_row(spark, sds, rows):
    twice = spark.createDataFrame([(2, "A", "bob", "paris", "x"), (2, "A", "bob", "oslo", "x"), (9, "A", "n", "n", "x"),
                                   (9, "A", "n", "n", "x")], SCHEMA)
    got = rows(cdc.delta(twice, sds, SPEC, snapshot_type="DELTA"), "dlt_operation_nm", "id", "city")
    assert got == [("ADD", 9, "n"), ("ADD", 9, "n"), ("MODIFY", 2, "paris")]


def test_snapshot_against_itself(spark):
    sds = history(spark, STORED)
    assert cdc.delta(spark.createDataFrame(STORED, SCHEMA), sds, SPEC, null_safe=True).isEmpty()


def test_empty_sides(stg, sds):
    gone = cdc.operation_counts(cdc.delta(stg.limit(0), sds, SPEC)).collect()
    assert [tuple(r) for r in gone] == [("REMOVE", 5)]
    new = cdc.operation_counts(cdc.delta(stg, sds.limit(0), SPEC)).collect()
    assert [tuple(r) for r in new] == [("ADD", 5)]
    assert cdc.delta(stg.limit(0), sds.limit(0), SPEC).isEmpty()


def test_geometry(spark, rows):
    spec = TableSpec("places", (ColumnSpec("id", "int", is_key=True), ColumnSpec("shape", GEOMETRY)))
    new = spark.createDataFrame([(1, b"AB"), (2, b"ab"), (3, None), (4, b"X")], "id int, shape binary")
    old = spark.createDataFrame([(1, b"ab"), (2, b"ab"), (3, b"ab"), (4, None)], "id int, shape binary")
    old = old.withColumn("curr_ind", F.lit("Y"))
    assert rows(cdc.delta(new, old, spec), "dlt_operation_nm", "id", "shape_upd_ind") == [("MODIFY", 1, "Y")]

    def same_letters(a, b):
        return F.lower(a.cast("string")) == F.lower(b.cast("string"))

    assert cdc.delta(new, old, spec, geom_equal=same_letters).isEmpty()


def test_apply(stg, sds, rows):
    delta = cdc.delta(stg, sds, SPEC)
    got = rows(scd2.apply(sds, delta, SPEC, "2024-02-01 00:00:00").select(
        "id", "city", F.col("start_dt").cast("string"), F.col("end_dt").cast("string"), "curr_ind"))
    forever, first, second = "9999-12-31 00:00:00", "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    assert got == sorted([
        (1, "rome", first, forever, "Y"), (3, None, first, forever, "Y"), (4, "bern", first, forever, "Y"),
        (2, "oslo", first, "2024-01-31 23:59:59", "N"), (5, "wien", first, "2024-01-31 23:59:59", "N"),
        (2, "paris", second, forever, "Y"), (6, "roma", second, forever, "Y"),
    ], key=lambda t: [(v is not None, str(v)) for v in t])


@pytest.mark.parametrize("options", [{}, {"hot_share": None}, {"null_safe": True}, {"on_null_key": "ref"}, {"snapshot_type": "DELTA"}])
def test_advance_is_delta_and_apply(stg, sds, rows, options):
    date = "2024-02-01 00:00:00"
    delta = cdc.delta(stg, sds, SPEC, **options)
    now = scd2.advance(stg, sds, SPEC, date, **options)
    assert rows(now.select(*sds.columns)) == rows(scd2.apply(sds, delta, SPEC, date).select(*sds.columns))
    assert rows(now.where("dlt_operation_nm is not null").select(*delta.columns)) == rows(delta)
    assert now.agg(scd2.before_rows()).first()[0] == 5


def test_advance_keeps_stored_rows_without_key(spark, stg, sds, rows):
    odd = sds.unionByName(history(spark, [(None, "A", "odd", "odd", "x"), (8, None, "odd", "odd", "x")]))
    now = scd2.advance(stg, odd, SPEC, "2024-02-01 00:00:00")
    assert rows(now.where("name = 'odd'"), "id", "curr_ind") == [(None, "Y"), (8, "Y")]
    assert now.agg(scd2.before_rows()).first()[0] == 7


def test_advance_with_the_same_file_date_fails(stg, sds):
    with pytest.raises(Exception, match="not after the start"):
        scd2.advance(stg, sds, SPEC, "2024-01-01 00:00:00").collect()


def test_same_file_date_twice_fails(stg, sds):
    delta = cdc.delta(stg, sds, SPEC)
    with pytest.raises(PySparkException, match="not after the start"):
        scd2.apply(sds, delta, SPEC, "2024-01-01 00:00:00").collect()


def test_as_of(stg, sds, rows):
    after = scd2.apply(sds, cdc.delta(stg, sds, SPEC), SPEC, "2024-02-01 00:00:00")
    assert rows(scd2.as_of(after, "2024-01-31 23:59:59"), "id", "city") == rows(sds, "id", "city")
    assert [r[0] for r in rows(scd2.as_of(after, "2024-02-01 00:00:00"), "id")] == [1, 2, 3, 4, 6]


@pytest.mark.parametrize("seed", range(3))
def test_random_snapshots_keep_history_whole(spark, rows, seed):
    """After each apply, current rows equal the snapshot, keys are unique, versions do not overlap."""
    rng = random.Random(seed)

    def snapshot():
        ids = rng.sample(range(40), 25)
        return [(i, "A", rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), "n") for i in ids]

    sds = history(spark, snapshot())
    for month in (2, 3, 4):
        data = snapshot()
        stg = spark.createDataFrame(data, SCHEMA)
        delta = cdc.delta(stg, sds, SPEC, null_safe=True)
        result = scd2.apply(sds, delta, SPEC, f"2024-0{month}-01 00:00:00").collect()
        sds = spark.createDataFrame(result, VERSIONED)
        assert rows(cdc.current(sds), "id", "name", "city") == rows(stg, "id", "name", "city")
    assert scd2.key_violations(sds, SPEC).isEmpty()
    by_key = {}
    for r in sorted(sds.collect(), key=lambda r: (r.id, r.start_dt)):
        assert r.start_dt <= r.end_dt
        if r.id in by_key:
            assert by_key[r.id] < r.start_dt
        by_key[r.id] = r.end_dt


def test_planned_counts_at_larger_scale(spark):
    """Counts worked out by hand in the fixture notes, with edits by key."""
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)")
    old = orders.select(
        "o_orderkey", price.alias("o_totalprice"),
        F.when(key % 29 != 0, F.col("o_orderpriority")).alias("o_orderpriority"), F.lit("Y").alias("curr_ind"),
    )
    kept = orders.where(key % 17 != 0).select(
        "o_orderkey", F.when(key % 13 == 0, price + 100).otherwise(price).alias("o_totalprice"),
        F.when(key % 19 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    new = orders.where(key % 23 == 0).select((key + 1000000).alias("o_orderkey"), price.alias("o_totalprice"), "o_orderpriority")
    spec = TableSpec("orders", (
        ColumnSpec("o_orderkey", "bigint", is_key=True), ColumnSpec("o_totalprice", "decimal(18,2)"), ColumnSpec("o_orderpriority"),
    ))
    stg = kept.unionByName(new)
    for null_safe, modified in ((False, 1086), (True, 2174)):
        counts = dict(map(tuple, cdc.operation_counts(cdc.delta(stg, old, spec, null_safe=null_safe)).collect()))
        assert counts == {"ADD": 653, "MODIFY": modified, "REMOVE": 883}


def test_hot_keys_are_compared_in_one_join(spark, plan):
    """One scan a side, whether staged or stored keys repeat; the rows are those of the ordinary join."""
    spec = TableSpec("o", (ColumnSpec("k", "bigint", is_key=True), ColumnSpec("o_totalprice", "double")))
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    hot = orders.select(F.when(F.col("o_orderstatus") == "F", 7).otherwise(F.col("o_orderkey")).alias("k"), "o_totalprice")
    stored = orders.select(F.col("o_orderkey").alias("k"), F.round("o_totalprice").alias("o_totalprice"), F.lit("Y").alias("curr_ind"))
    for stg, sds in ((hot, stored), (stored.drop("curr_ind"), hot.withColumn("curr_ind", F.lit("Y")))):
        salted = cdc.delta(stg, sds, spec, hot_share=10, stored_hot_share=10)
        plain = cdc.delta(stg, sds, spec, hot_share=None)
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            text = plan(cdc.delta(stg, sds, spec, snapshot_type="FULL", hot_share=10, stored_hot_share=10))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # One scan a side, and one of the stored side for rows without a key.
        assert text.count("FullOuter") == 1 and text.count("FileScan") == 3 and "_left_salt" in text
