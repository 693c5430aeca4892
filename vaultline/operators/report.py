"""Reports over the check log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.operators.checks import on_day


def log_report(log: DataFrame, checks: DataFrame) -> DataFrame:
    """Every log row with its check. The check table is broadcast by the optimizer on its size."""
    # The id shown is the check table's: blank for a log row whose check is gone.
    return log.join(checks.withColumn("_check", F.col("dq_check_id")), "dq_check_id", "left").select(
        F.col("_check").alias("dq_check_id"),
        "dq_check_name",
        "log_date",
        F.when(F.col("dq_check_passed_flag") == 1, "SUCCESSFUL").otherwise("FAILED").alias("status"),
        "actual_value",
        "target_min_value",
        "target_max_value",
        "dq_check_group",
        "sql_query",
    )


def failed_on(log: DataFrame, checks: DataFrame, day: date | str) -> DataFrame:
    """The failures of one day; the day is a filter on the log's scan."""
    return log_report(log.where(on_day("log_date", day)), checks).where(F.col("status") != "SUCCESSFUL")
