"""Stored tables whose layout saves shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, *, mode: str = "overwrite") -> DataFrame:
    """Saves a catalog table bucketed and sorted by its keys. Two tables with the same keys and number
    of buckets (a staging snapshot and its history, a source and its hub) join without a shuffle."""
    df.write.bucketBy(buckets, *keys).sortBy(*keys).mode(mode).saveAsTable(name)
    return df.sparkSession.table(name)
