"""Scalar checks: one number against a target range, and the checks that come with the framework."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.functions.clock import as_datetime, timestamp
from vaultline.specs import CheckSpec

NUMBER = "decimal(38,2)"


def flag(value: Column, target_min: Column, target_max: Column) -> Column:
    """1 when the value lies in its range, both ends included; a missing end is open, a NULL fails."""
    inside = value.between(F.coalesce(target_min, value), F.coalesce(target_max, value))
    return F.when(inside, 1).otherwise(0)


def run(spark: SparkSession, checks: Sequence[CheckSpec], log_time: datetime | str) -> DataFrame:
    """The log rows of all checks, as one lazy frame.

    Each check is a scalar subquery: no row gives NULL, more than one row fails. Spark runs the
    subqueries at the same time and merges those that aggregate the same scan.
    """
    rows = []
    for c in checks:
        result = c.query(spark) if callable(c.query) else spark.sql(c.query)
        if len(result.columns) != 1:
            raise ValueError(f"{c.check_id}: a check returns one column")
        value = result.select(F.col(f"`{result.columns[0]}`").cast(NUMBER)).scalar()
        rows.append(spark.range(1).select(
            F.lit(c.check_id).alias("dq_check_id"),
            value.alias("actual_value"),
            F.lit(c.target_min).cast(NUMBER).alias("target_min_value"),
            F.lit(c.target_max).cast(NUMBER).alias("target_max_value"),
        ))
    return reduce(DataFrame.unionByName, rows).select(
        "dq_check_id",
        timestamp(log_time).alias("log_date"),
        "actual_value",
        flag(F.col("actual_value"), F.col("target_min_value"), F.col("target_max_value")).alias("dq_check_passed_flag"),
    )


def check_table(spark: SparkSession, checks: Sequence[CheckSpec]) -> DataFrame:
    """The check metadata as a frame, for the reports."""
    schema = (
        "dq_check_id string, dq_check_name string, dq_check_desc string, dq_check_group string, "
        "target_min_value string, target_max_value string, sql_query string"
    )
    rows = [
        (c.check_id, c.name, c.description, c.group, _text(c.target_min), _text(c.target_max), c.query_text)
        for c in checks
    ]
    return spark.createDataFrame(rows, schema).withColumns({
        "target_min_value": F.col("target_min_value").cast(NUMBER),
        "target_max_value": F.col("target_max_value").cast(NUMBER),
    })


def on_day(column: str, day: date | str) -> Column:
    """A range on the bare column, which reaches the scan as a pushed filter."""
    start = _midnight(day)
    return (F.col(column) >= timestamp(start)) & (F.col(column) < timestamp(start + timedelta(days=1)))


def day_variance(
    df: DataFrame, id_column: str, day_column: str, groups: Sequence[str], as_of: date | str, *, absolute: bool = False
) -> DataFrame:
    """The largest loss against the day before, over the groups present on both days, in whole percent.

    One scan of the two days counts both; the group keys stay separate columns. A group with a missing part belongs to
    no day: it equals none of the other.
    """
    today, yesterday = on_day(day_column, as_of), on_day(day_column, _midnight(as_of) - timedelta(days=1))
    counts = (
        df.where(today | yesterday).dropna(subset=list(groups))
        .groupBy(*groups)
        .agg(
            F.count_if(yesterday).alias("rows_before"), F.count_if(today).alias("rows_now"),
            F.count(F.when(yesterday, F.col(id_column))).alias("y"), F.count(F.when(today, F.col(id_column))).alias("t"),
        )
        .where((F.col("rows_before") > 0) & (F.col("rows_now") > 0))
    )
    variance = F.expr("((y - t) * 100) div nullif(y, 0)")
    return counts.agg(F.max(F.abs(variance) if absolute else variance).alias("variance"))


def null_count(df: DataFrame, column: str, day_column: str, as_of: date | str) -> DataFrame:
    """Rows of a day in which the column is missing."""
    return df.where(on_day(day_column, as_of)).agg(F.count_if(F.col(column).isNull()).alias("null_count"))


def null_count_of_column(df: DataFrame, column: str, day_column: str, as_of: date | str) -> DataFrame:
    """The count of the column among the rows where it is missing, as first written: always 0."""
    return df.where(on_day(day_column, as_of) & F.col(column).isNull()).agg(F.count(column).alias("null_count"))


def volume_variance(
    raw: DataFrame, raw_group: str | Column, work: DataFrame, work_day: str, as_of: datetime | str, days: int = 7
) -> DataFrame:
    """Percent by which the smallest raw group differs from the mean daily volume of the last days."""
    end = as_datetime(as_of)
    recent = work.where(F.col(work_day).between(timestamp(end - timedelta(days=days)), timestamp(end)))
    daily = recent.groupBy(F.to_date(work_day).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    previous = daily.agg(F.expr("sum(n) div count(n)")).scalar()
    smallest = min_group_count(raw, raw_group).scalar()
    both = raw.sparkSession.range(1).select(smallest.alias("cnt"), previous.alias("prev"))
    variance = F.abs(F.col("cnt") - F.col("prev")).cast("double") * 100 / F.expr("nullif(prev, 0)")
    return both.select(variance.cast(NUMBER).alias("variance"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key combinations occur more than once. Counts combine before the shuffle."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("duplicate_groups"))


def row_recon(
    raw: DataFrame, work: DataFrame, work_day: str, as_of: date | str, raw_filter: str | None = None
) -> DataFrame:
    """Difference in row count between a raw table and one day of its work table."""
    counted = raw.where(raw_filter) if raw_filter else raw
    left = counted.agg(F.count(F.lit(1))).scalar()
    right = work.where(on_day(work_day, as_of)).agg(F.count(F.lit(1))).scalar()
    return raw.sparkSession.range(1).select(F.abs(left - right).alias("row_difference"))


def min_group_count(df: DataFrame, group: str | Column) -> DataFrame:
    key = F.col(group) if isinstance(group, str) else group
    return df.groupBy(key.alias("g")).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("min_count"))


def avg_daily_count(df: DataFrame, day_column: str) -> DataFrame:
    """Mean of the daily counts, cut to a whole number."""
    daily = df.groupBy(F.to_date(day_column).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.agg(F.expr("sum(n) div count(n)").alias("avg_count"))


def _text(target: float | None) -> str | None:
    return None if target is None else str(target)


def _midnight(day: date | datetime | str) -> datetime:
    return as_datetime(day).replace(hour=0, minute=0, second=0, microsecond=0)
