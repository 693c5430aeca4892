import pytest
from pyspark.sql import functions as F

from vaultline.operators import cdc, conform
from vaultline.sources.metadata import spark_type
from vaultline.specs import ColumnSpec, TableSpec

SPEC = TableSpec("t", (
    ColumnSpec("id", "int", is_key=True, required=True), ColumnSpec("n", "decimal(5,2)"), ColumnSpec("at", "timestamp_ntz"),
    ColumnSpec("shape", "geometry"), ColumnSpec("note", keep_history=False),
))


def test_declared_order_and_types(spark):
    df = spark.createDataFrame(
        [("x", b"a", "2024-01-01", "1.234", "1"), (None, None, "never", "99999", None)],
        "note string, shape binary, at string, n string, id string")
    got = conform.to_staging(df, SPEC)
    assert got.dtypes == [("id", "int"), ("n", "decimal(5,2)"), ("at", "timestamp_ntz"), ("shape", "binary"), ("note", "string")]
    second = got.where("id is null").first()
    assert second.n is None and second.at is None
    bad = {r.column_nm: (r.bad_values, r.missing_values) for r in conform.bad_values(df, SPEC).collect()}
    assert bad == {"id": (0, 1), "n": (1, 0), "at": (1, 0), "shape": (0, 0), "note": (0, 0)}


def test_layers(spark):
    staged = spark.createDataFrame([(1, 1.5, b"a", "x")], "id int, n double, shape binary, note string").withColumn(
        "at", F.lit("2024-01-01").cast("timestamp_ntz"))
    stg = conform.to_staging(staged, SPEC)
    history = conform.to_history(
        stg.withColumns({"start_dt": F.lit("2024-01-01"), "end_dt": F.lit("9999-12-31"), "curr_ind": F.lit("Y")}), SPEC)
    assert history.dtypes[-3:] == [("start_dt", "timestamp_ntz"), ("end_dt", "timestamp_ntz"), ("curr_ind", "string")]
    delta = cdc.delta(stg, history, SPEC)
    assert delta.columns == [c.name for c in conform.delta_columns(SPEC)] == conform.to_delta(delta, SPEC).columns


def test_source_types():
    assert spark_type("NUMBER", 12, 2) == "decimal(12,2)" and spark_type("number", 10) == "decimal(10,0)"
    assert spark_type("VARCHAR2", 30) == "string"
    with pytest.raises(ValueError, match="unknown data type UNHEARD_OF"):
        spark_type("UNHEARD_OF")
    assert spark_type("DATE") == "timestamp_ntz" and spark_type("SDO_GEOMETRY") == "geometry"
