import pytest
from pyspark.sql import functions as F

from vaultline.functions.keys import row_id
from vaultline.operators import checks, report, screens
from vaultline.plans import quality_jobs
from vaultline.plans.materialize import store_addressed, with_addresses
from vaultline.specs import CheckSpec, ColumnSpec, ScreenSpec, TableSpec

LOG = "2024-02-01 00:00:00"
SPEC = TableSpec("orders", (ColumnSpec("id", "int", is_key=True), ColumnSpec("price", "int"), ColumnSpec("status")), 1, 9)
OTHER = TableSpec("items", (ColumnSpec("item", "int", is_key=True),), 2, 9)
SCREENS = [
    ScreenSpec(1, 1, 10, "PASS", "price < 10"), ScreenSpec(2, 1, 20, "REJECT", "price is null"),
    ScreenSpec(3, 1, 30, "STOP", "status = 'X'"), ScreenSpec(4, 1, 40, "PASS", "price > 50"),
]


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([(1, 5, "O"), (2, None, "O"), (3, 70, "X"), (4, 20, "O"), (5, None, "X")], "id int, price int, status string")


@pytest.fixture(scope="module")
def batches(spark):
    return spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "batch_id int, src_file_id int")


def test_stop_ends_the_run_after_its_own_events(orders, batches, rows):
    result = screens.validate(orders, SCREENS, SPEC, batches, LOG)
    assert rows(result.events, "screen_id", "row_id", "batch_id") == [
        (1, "1", 2), (2, "2", 2), (2, "5", 2), (3, "3", 2), (3, "5", 2)]
    with pytest.raises(screens.DQStop) as stopped:
        result.raise_on_stop()
    assert (stopped.value.screen_id, stopped.value.failures) == (3, 2)


def test_without_failures_all_screens_run(orders, batches, rows):
    calm = orders.withColumn("status", F.lit("O"))
    result = screens.validate(calm, SCREENS, SPEC, batches, LOG)
    assert rows(result.events, "screen_id", "row_id")[-1] == (4, "3")
    result.raise_on_stop()


def test_only_pass_screens(orders, batches):
    result = screens.validate(orders, SCREENS[:1], SPEC, batches, LOG)
    result.raise_on_stop()
    assert result.events.count() == 1


def test_file_without_batch(spark, orders, rows):
    none = spark.createDataFrame([], "batch_id int, src_file_id int")
    assert rows(screens.validate(orders, SCREENS[:1], SPEC, none, LOG).events, "batch_id") == [(None,)]


def test_query_screens_and_their_stop(spark, orders, batches, rows):
    cheap = ScreenSpec(8, 1, 5, "STOP", query=lambda: orders.where("price = 20").select(F.col("id").cast("string").alias("row_id")))
    result = screens.validate(orders, [*SCREENS, cheap], SPEC, batches, LOG)
    assert rows(result.events, "screen_id", "row_id") == [(8, "4")]
    with pytest.raises(screens.DQStop):
        result.raise_on_stop()


def test_group_stops_later_files(spark, orders, batches, rows):
    items = spark.createDataFrame([(1,), (2,)], "item int")
    all_screens = [*SCREENS, ScreenSpec(5, 2, 1, "PASS", "item > 0")]
    files = [(OTHER, items), (SPEC, orders)]
    stopped = screens.validate_group(files, all_screens, 9, batches, LOG)
    assert {r.screen_id for r in stopped.events.collect()} == {1, 2, 3}
    calm = screens.validate_group([(OTHER, items), (SPEC, orders.withColumn("status", F.lit("O")))], all_screens, 9, batches, LOG)
    assert {r.screen_id for r in calm.events.collect()} == {1, 2, 4, 5}
    assert calm.stop.isEmpty()


def test_screens_share_one_scan(orders, plan, spark, tmp_path):
    orders.write.parquet(str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    assert plan(screens.failing(stored, SCREENS, SPEC)).count("FileScan") == 1
    assert "Exchange" not in plan(screens.accepted(stored, SCREENS, SPEC))


def test_rejects(orders, batches, rows):
    by_filter = screens.accepted(orders, SCREENS, SPEC)
    events = screens.validate(orders, SCREENS, SPEC, batches, LOG).events
    assert rows(by_filter, "id") == rows(screens.without_rejected(orders, events, SPEC), "id") == [(1,), (3,), (4,)]
    assert screens.accepted(orders, SCREENS[:1], SPEC).count() == 5


def test_metadata_is_checked():
    with pytest.raises(ValueError, match="share one order"):
        screens.in_order([SCREENS[0], ScreenSpec(9, 1, 10, "PASS", "true")], 1)
    with pytest.raises(ValueError, match="unknown action"):
        ScreenSpec(1, 1, 1, "WARN", "true")
    with pytest.raises(ValueError, match="predicate or a query"):
        ScreenSpec(1, 1, 1, "PASS")


def test_events_are_kept_when_a_stop_is_raised(spark, orders, batches, tmp_path):
    path = str(tmp_path / "events")
    with pytest.raises(screens.DQStop):
        quality_jobs.validate_file(orders, SCREENS, SPEC, batches, LOG, path, 1)
    assert spark.read.parquet(path).count() == 5
    rest = quality_jobs.validate_file(orders.withColumn("status", F.lit("O")), SCREENS, SPEC, batches, LOG, path, 2)
    assert rest.count() == 3
    with pytest.raises(screens.DQStop):
        quality_jobs.validate_group([(SPEC, orders)], SCREENS, 9, batches, LOG, str(tmp_path / "group"), 3)
    assert spark.read.parquet(path).count() == 5 + 4
    # A rerun replaces its part of the log.
    quality_jobs.validate_file(orders.withColumn("status", F.lit("O")), SCREENS, SPEC, batches, LOG, path, 2)
    assert spark.read.parquet(path).count() == 5 + 4


def test_rows_with_clashing_key_texts_stay_apart(spark, batches, tmp_path):
    """Key texts that are equal for different keys, missing keys and repeated rows: only the rows refused go."""
    spec = TableSpec("t", (ColumnSpec("a", is_key=True), ColumnSpec("b", is_key=True), ColumnSpec("v", "int")), 1)
    data = spark.createDataFrame([("x|y", "z", 1), ("x", "y|z", 2), (None, "z", 1), (None, "z", 2), ("p", "q", 2), ("p", "q", 2)], "a string, b string, v int")
    stored = store_addressed(data, str(tmp_path / "rows"))
    screen = [ScreenSpec(1, 1, 1, "REJECT", "v = 1")]
    events = screens.validate(stored, screen, spec, batches, LOG).events
    kept = screens.without_rejected(stored, events, spec).drop(screens.ROW_ADDRESS)
    assert sorted(map(str, kept.collect())) == sorted(map(str, data.where("v = 2").collect()))
    by_query = [*screen, ScreenSpec(2, 1, 2, "REJECT", query=lambda: spark.createDataFrame([("p|q",)], "row_id string"))]
    rest = quality_jobs.validate_file(data, by_query, spec, batches, LOG, str(tmp_path / "events"), 1)
    assert rest.columns == ["a", "b", "v"] and sorted(r.b for r in rest.collect()) == ["y|z", "z"]


@pytest.mark.parametrize("value, low, high, passed", [
    (5, 0, 10, 1), (10, 0, 10, 1), (10.01, 0, 10, 0), (-1, 0, 10, 0), (5, None, 10, 1), (11, None, 10, 0),
    (5, None, None, 1), (None, None, None, 0), (0, 0, 0, 1),
])
def test_flag(spark, value, low, high, passed):
    number = [F.lit(v).cast("decimal(38,2)") for v in (value, low, high)]
    assert spark.range(1).select(checks.flag(*number)).first()[0] == passed


def test_checks_by_query_text_and_frame(spark, rows, tmp_path):
    spark.range(5).createOrReplaceTempView("five")
    specs = [
        CheckSpec("A", "with f as (select * from five) select count(*) from f", 5, 5),
        CheckSpec("B", lambda s: s.range(0).selectExpr("max(id)"), None, None),
        CheckSpec("C", "select id from five where id < 0", 0, 1),
    ]
    log = quality_jobs.run_checks(spark, specs, LOG, str(tmp_path / "log"))
    got = rows(log.select("dq_check_id", F.col("actual_value").cast("int"), "dq_check_passed_flag"))
    assert got == [("A", 5, 1), ("B", None, 0), ("C", None, 0)]
    failed = report.failed_on(log, checks.check_table(spark, specs[1:]), "2024-02-01")
    assert rows(failed, "dq_check_id", "status") == [("B", "FAILED"), ("C", "FAILED")]
    assert report.failed_on(log, checks.check_table(spark, specs), "2024-02-02").isEmpty()
    # A log row whose check is gone stays, without a check.
    assert rows(report.log_report(log, checks.check_table(spark, specs[1:])), "dq_check_id", "status")[0] == (None, "SUCCESSFUL")


def test_check_with_many_rows_fails(spark):
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        checks.run(spark, [CheckSpec("M", lambda s: s.range(3))], LOG).collect()


def test_day_variance(spark):
    data = [("a", "2024-01-01", i) for i in range(4)] + [("a", "2024-01-02", i) for i in range(3)] + [
        ("b", "2024-01-01", 1), ("b", "2024-01-02", 1), ("b", "2024-01-02", 2), ("gone", "2024-01-01", 1), ("new", "2024-01-02", 1)]
    df = spark.createDataFrame(data, "team string, day string, id int").withColumn("day", F.col("day").cast("timestamp_ntz"))
    assert checks.day_variance(df, "id", "day", ["team"], "2024-01-02").first()[0] == 25
    assert checks.day_variance(df, "id", "day", ["team"], "2024-01-02", absolute=True).first()[0] == 100
    # Without ids yesterday there is nothing to divide by.
    blank = df.withColumn("id", F.when(F.col("day") > F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"), F.col("id")))
    assert checks.day_variance(blank, "id", "day", ["team"], "2024-01-02").first()[0] is None


def test_volume_variance_without_history(spark):
    df = spark.createDataFrame([("2024-01-02",)], "day string").withColumn("day", F.col("day").cast("timestamp_ntz"))
    assert checks.volume_variance(df, "day", df.where("false"), "day", "2024-01-02").first()[0] is None


def test_day_filter_reaches_the_scan(spark, plan):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(checks.null_count(events, "props", "ts", "2024-01-30"))
    assert "GreaterThanOrEqual(ts,2024-01-30" in text and "ReadSchema: struct<ts:timestamp_ntz,props:string>" in text


def test_a_file_is_read_once_for_its_events_and_stops(spark, tmp_path, plan, rows):
    """STOP failures are counted in the pass that stores the events, which are those of ``validate``."""
    path = str(tmp_path / "file")
    spark.range(1000).select("id", (F.col("id") % 10).alias("v")).write.parquet(path)
    df, spec = spark.read.parquet(path), TableSpec("t", (ColumnSpec("id", "bigint", is_key=True), ColumnSpec("v", "bigint")), 1)
    mine = [ScreenSpec(1, 1, 1, "PASS", "v = 1"), ScreenSpec(2, 1, 2, "STOP", "v = 11"), ScreenSpec(3, 1, 3, "STOP", "v > 7"), ScreenSpec(4, 1, 4, "PASS", "v = 2")]
    batches = spark.createDataFrame([(1, 1)], "batch_id int, src_file_id int")
    events, _ = screens.all_events(df, mine, spec, batches, "2024-01-01")
    assert plan(events).count("FileScan") == 1
    with pytest.raises(screens.DQStop, match="screen 3 of file 1 stopped the load: 200 failing rows"):
        quality_jobs.validate_file(df, mine, spec, batches, "2024-01-01", str(tmp_path / "log"), 1)
    want = screens.validate(df, mine, spec, batches, "2024-01-01").events
    logged = spark.read.parquet(str(tmp_path / "log" / "run_id=1" / "file_id=1"))
    assert rows(logged, "screen_id", "row_id") == rows(want, "screen_id", "row_id") and logged.count() == 300


def test_query_screens_tell_rows_apart_whose_key_texts_collide(spark, tmp_path):
    """The keys (x|y, z) and (x, y|z) have one text; addresses come from the scan of the file itself."""
    path = str(tmp_path / "file")
    spark.createDataFrame([("x|y", "z", 1), ("x", "y|z", 2), ("p", "q", 3)], "a string, b string, v int").write.parquet(path)
    file = with_addresses(spark.read.parquet(path))
    spec = TableSpec("t", (ColumnSpec("a", is_key=True), ColumnSpec("b", is_key=True), ColumnSpec("v", "int")), 1)
    refused = lambda: file.where("v = 1").select(row_id(["a", "b"]).alias("row_id"), screens.ROW_ADDRESS)
    batches = spark.createDataFrame([(1, 1)], "batch_id int, src_file_id int")
    for frame in (file, spark.read.parquet(path)):
        kept = quality_jobs.validate_file(frame, [ScreenSpec(1, 1, 1, "REJECT", query=refused)], spec, batches, "2024-01-01", str(tmp_path / "log"), 1)
        assert sorted(r.v for r in kept.collect()) == [2, 3] and kept.columns == frame.columns
    assert with_addresses(spark.range(3).groupBy("id").count()).select(screens.ROW_ADDRESS).distinct().count() == 3
