"""Reference and key checks between loaded tables, which the loads themselves do not enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys without a parent, and how many child rows hold them. The child is counted per key
    before it is shuffled, so a key that many rows share stays one row."""
    counts = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("missing_key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    return counts.join(parent.select(F.col(parent_key).alias("missing_key")), "missing_key", "left_anti")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )
