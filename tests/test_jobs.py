"""Stored histories, metadata tables and layouts."""

import pytest
from pyspark.sql import functions as F

from vaultline.operators import cdc, scd2, screens
from vaultline.plans import history_jobs
from vaultline.plans.materialize import cut_lineage
from vaultline.sources import metadata, tables
from vaultline.specs import ColumnSpec, TableSpec

SPEC = TableSpec("accounts", (ColumnSpec("id", "int", is_key=True), ColumnSpec("v", "decimal(10,2)")), 1, 7)
OTHER = TableSpec("owners", (ColumnSpec("id", "int", is_key=True), ColumnSpec("v", "decimal(10,2)")), 2, 7)


def staged(spark, *pairs):
    return spark.createDataFrame([(i, str(v)) for i, v in pairs], "id int, v string")


def load(spark, root, batch, previous, day, *pairs, **options):
    stg = {"accounts": staged(spark, *pairs), "owners": staged(spark, (1, 1))}
    files = [SPEC, OTHER, TableSpec("bare", (), 3, 7)]
    return history_jobs.load_group(spark, files, 7, stg, root, batch, previous, day, **options)


def shown(df):
    picked = df.select("id", F.col("v").cast("int"), F.col("start_dt").cast("date").cast("string"), "curr_ind").collect()
    return sorted(tuple(r) for r in picked)


@pytest.mark.parametrize("one_pass", [True, False])
def test_three_batches_and_a_rerun(spark, tmp_path, rows, one_pass):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1), (2, 2), one_pass=one_pass)
    load(spark, root, 2, 1, "2024-02-01", (1, 5), (3, 3), one_pass=one_pass)
    load(spark, root, 3, 2, "2024-03-01", (1, 5), (2, 2), (3, 4), one_pass=one_pass)
    # The same batch again, by the other way.
    after = load(spark, root, 3, 2, "2024-03-01", (1, 5), (2, 2), (3, 4), one_pass=not one_pass)["accounts"]
    assert shown(after) == [
        (1, 1, "2024-01-01", "N"), (1, 5, "2024-02-01", "Y"), (2, 2, "2024-01-01", "N"), (2, 2, "2024-03-01", "Y"),
        (3, 3, "2024-02-01", "N"), (3, 4, "2024-03-01", "Y")]
    assert scd2.key_violations(after, SPEC).isEmpty()
    # Earlier batches stay readable.
    folder = f"{root}/accounts"
    second = history_jobs.read_history(spark, SPEC, folder, 2)
    assert shown(second) == [(1, 1, "2024-01-01", "N"), (1, 5, "2024-02-01", "Y"), (2, 2, "2024-01-01", "N"), (3, 3, "2024-02-01", "Y")]
    # Both ways keep the same delta.
    apart = spark.read.parquet(f"{folder}/delta/batch={2 if not one_pass else 3}")
    inside = history_jobs.read_changes(spark, SPEC, folder, 2 if one_pass else 3)
    assert apart.columns == inside.columns
    expected = {2: {"ADD": 1, "MODIFY": 1, "REMOVE": 1}, 3: {"ADD": 1, "MODIFY": 1}}
    for frame, batch in ((apart, 2 if not one_pass else 3), (inside, 2 if one_pass else 3)):
        assert dict(map(tuple, cdc.operation_counts(frame).collect())) == expected[batch]
    assert history_jobs.read_current(spark, OTHER, f"{root}/owners", 3).count() == 1


def test_repeated_staged_key_is_refused(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1))
    with pytest.raises(ValueError, match="not unique"):
        load(spark, root, 2, 1, "2024-02-01", (1, 1), (1, 1))


def test_repeated_new_key_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="not unique"):
        load(spark, str(tmp_path), 1, None, "2024-01-01", (9, 1), (9, 2))
    assert history_jobs.commits(spark, f"{tmp_path}/accounts") == {}


@pytest.mark.parametrize("one_pass", [True, False])
def test_refused_batch_is_no_part_of_a_later_history(spark, tmp_path, one_pass):
    root, folder = str(tmp_path), f"{tmp_path}/accounts"
    load(spark, root, 1, None, "2024-01-01", (1, 1), (2, 2), one_pass=one_pass)
    with pytest.raises(ValueError, match="not unique"):
        load(spark, root, 2, 1, "2024-02-01", (1, 5), (9, 9), (9, 9), one_pass=one_pass)
    with pytest.raises(ValueError, match="not committed"):
        history_jobs.read_history(spark, SPEC, folder, 2)
    after = load(spark, root, 3, 1, "2024-03-01", (1, 7), (2, 2), one_pass=one_pass)["accounts"]
    assert shown(after) == [(1, 1, "2024-01-01", "N"), (1, 7, "2024-03-01", "Y"), (2, 2, "2024-01-01", "Y")]
    # The two-step way refuses the delta already, and leaves no attempt.
    assert len(history_jobs.forget_attempts(spark, folder)) == int(one_pass)


@pytest.mark.parametrize("one_pass", [True, False])
def test_bad_values_never_close_stored_rows(spark, tmp_path, one_pass):
    root, spec = str(tmp_path), SPEC
    text = lambda *pairs: spark.createDataFrame(list(pairs), "id string, v string")

    def run(batch, previous, day, stg, **options):
        if one_pass:
            return history_jobs.advance_file(stg, spec, root, batch, previous, day, **options)
        history_jobs.write_delta(stg, spec, root, batch, previous, **options)
        return history_jobs.apply_delta(spark, spec, root, batch, previous, day)

    run(1, None, "2024-01-01", text(("1", "1"), ("2", "2"), ("3", "3")))
    bad = text(("1x", "5"), ("2", "bad"), (None, "1"), ("4", "4"))
    with pytest.raises(ValueError, match="3 staged rows cannot be loaded"):
        run(2, 1, "2024-02-01", bad)
    assert set(history_jobs.commits(spark, root)) == {1}
    after = run(2, 1, "2024-02-01", bad, on_bad="quarantine")
    assert shown(after) == [(1, 1, "2024-01-01", "Y"), (2, 2, "2024-01-01", "Y"), (3, 3, "2024-01-01", "Y"), (4, 4, "2024-02-01", "Y")]
    kept = history_jobs.read_quarantine(spark, spec, root, 2)
    assert sorted((r.id or "", r.v, tuple(r.load_reasons)) for r in kept.collect()) == [
        ("", "1", ("id: missing",)), ("1x", "5", ("id: unreadable",)), ("2", "bad", ("v: unreadable",))]
    # Where every key can be read, absence still removes.
    again = run(3, 2, "2024-03-01", text(("1", "1"), ("2", "bad"), ("4", "4")), on_bad="quarantine")
    assert [r for r in shown(again) if r[3] == "N"] == [(3, 3, "2024-01-01", "N")]


def test_current_rows_are_pruned_by_partition(spark, tmp_path, plan):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1))
    text = plan(history_jobs.read_current(spark, SPEC, f"{root}/accounts", 1))
    assert "(curr_ind#" in text.split("PartitionFilters: [")[1] and "batch#" in text.split("PartitionFilters: [")[1]


@pytest.mark.parametrize("one_pass", [True, False])
def test_failed_batch_leaves_the_history_readable(spark, tmp_path, one_pass):
    root = str(tmp_path)
    load(spark, root, 1, None, "2024-01-01", (1, 1))
    with pytest.raises(Exception, match="not after the start"):
        load(spark, root, 2, 1, "2024-01-01", (1, 2), one_pass=one_pass)
    assert history_jobs.read_history(spark, SPEC, f"{root}/accounts", 1).count() == 1
    load(spark, root, 2, 1, "2024-02-01", (1, 2), one_pass=one_pass)
    assert history_jobs.read_history(spark, SPEC, f"{root}/accounts", 2).count() == 2


def test_checkpoint_cuts_the_plan(spark, plan):
    left = spark.range(10).join(spark.range(5), "id")
    assert "Join" not in plan(cut_lineage(left))


def test_bucketed_tables_join_without_shuffle(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        stg = tables.save_bucketed(spark.range(100).withColumn("v", F.lit("a")), "b_stg", ["id"], 4)
        sds = tables.save_bucketed(
            spark.range(50, 150).withColumn("v", F.lit("b")).withColumn("curr_ind", F.lit("Y")), "b_sds", ["id"], 4)
        spec = TableSpec("b", (ColumnSpec("id", "bigint", is_key=True), ColumnSpec("v")))
        for share in (None, 10):
            delta = cdc.delta(stg, sds, spec, hot_share=share)
            assert "Exchange hashpartitioning" not in plan(delta)
        assert dict(map(tuple, cdc.operation_counts(delta).collect())) == {"ADD": 50, "MODIFY": 50, "REMOVE": 50}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists b_stg")
        spark.sql("drop table if exists b_sds")


def test_delta_plan(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
        history = orders.withColumn("curr_ind", F.lit("Y"))
        spec = TableSpec("o", (ColumnSpec("o_orderkey", "bigint", is_key=True), ColumnSpec("o_totalprice", "double")))
        unique, guarded = plan(cdc.delta(orders, history, spec, hot_share=None)), plan(cdc.delta(orders, history, spec))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Each side is shuffled once for the join; hot keys cost a count of keys and broadcasts.
    assert unique.count("Exchange hashpartitioning") == 2 and unique.count("FullOuter") == 1
    # Where no key is hot, which is found once before, the plan is the same: one scan of each side, and one for NULL keys.
    assert guarded.count("FullOuter") == 1 and "LeftSemi" not in guarded and guarded.count("FileScan") == 3
    for text in (unique, guarded):
        assert "Cartesian" not in text and "NestedLoop" not in text
        assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_table_and_screen_metadata(spark):
    files = spark.createDataFrame(
        [(1, "ORDERS", "FULL", 7), (2, "ITEMS", "DELTA", 7), (3, "ELSE", "FULL", 8)],
        "SRC_FILE_ID int, SRC_TABLE_NM string, SNAPSHOT_TYPE string, SRC_FILE_GROUP_ID int")
    columns = spark.createDataFrame(
        [(1, 2, "PRICE", "NUMBER", 12, 2, "N", "Y"), (1, 1, "ID", "NUMBER", 10, None, "Y", "N"), (1, 3, "AT", "DATE", None, None, "N", "N"),
         (1, 4, "SHAPE", "SDO_GEOMETRY", None, None, "N", "Y"), (1, 5, "NAME", "VARCHAR2", 30, None, "N", "Y")],
        "SRC_FILE_ID int, SRC_COLUMN_ID int, SRC_COLUMN_NM string, DATA_TYPE string, LENGTH_NUM int, SCALE_NUM int,"
        " IS_NATURAL_KEY_IND string, PRESERVE_HISTORY_IND string")
    orders, items = metadata.table_specs(files, columns, 7)
    assert [(c.name, c.data_type) for c in orders.columns] == [
        ("ID", "decimal(10,0)"), ("PRICE", "decimal(12,2)"), ("AT", "timestamp_ntz"), ("SHAPE", "geometry"), ("NAME", "string")]
    assert orders.keys == ["ID"] and [c.name for c in orders.tracked] == ["PRICE", "SHAPE", "NAME"]
    assert items.snapshot_type == "DELTA" and items.columns == () and cdc.group_files([orders, items], 7) == [orders]
    assert len(metadata.table_specs(files, columns)) == 3

    spark.createDataFrame([("5",), ("6",)], "id string").createOrReplaceTempView("bad_ids")
    rows_ = [(1, "cheap", 1, 1, "PASS", "price < 3"), (2, "named", 1, 2, "REJECT", "select id from bad_ids")]
    screen_table = spark.createDataFrame(
        rows_, "SCREEN_ID int, SCREEN_NM string, SRC_FILE_ID int, SCREEN_ORDER int, EXCEPTION_ACTION string, SCREEN_SQL string")
    found = metadata.screen_specs(screen_table, [1])
    assert found[0].predicate == "price < 3" and found[1].query().columns == ["row_id"]
    data = spark.createDataFrame([(1, 2.0), (5, 9.0)], "id int, price double")
    spec = TableSpec("o", (ColumnSpec("id", "int", is_key=True), ColumnSpec("price", "double")), 1)
    batches = spark.createDataFrame([(1, 1)], "batch_id int, src_file_id int")
    events = screens.validate(data, found, spec, batches, "2024-01-01").events
    assert sorted((r.screen_id, r.row_id) for r in events.collect()) == [(1, "1"), (2, "5"), (2, "6")]
    assert [r.id for r in screens.without_rejected(data, events, spec).collect()] == [1]
    checks = spark.createDataFrame(
        [("C", "n", None, "G", 0.0, None, "select 1")],
        "dq_check_id string, dq_check_name string, dq_check_desc string, dq_check_group string, target_min_value double,"
        " target_max_value double, sql_query string")
    assert metadata.check_specs(checks)[0].target_max is None
