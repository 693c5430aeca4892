"""Quality runs with storage: logs are appended first, then a stop is raised."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators import checks, screens
from vaultline.plans.materialize import with_addresses
from vaultline.specs import REJECT, CheckSpec, ScreenSpec, TableSpec


def validate_file(
    df: DataFrame, file_screens: Iterable[ScreenSpec], spec: TableSpec, batches: DataFrame, log_time: datetime | str,
    events_path: str, run_id: str | int,
) -> DataFrame:
    """Logs the events of a file and returns the rows to go on with, unless a STOP screen failed.

    ``run_id`` names the file's part of the log: running it again replaces that part. The file is read once for its
    events: they are stored by order of their screens, STOP failures counted on the way, and then logged up to the screen
    that stopped. Where a query screen rejects, rows are known by their address, and what is refused is read from the log.
    """
    file_screens = list(file_screens)
    rejects = [s for s in screens.in_order(file_screens, spec.file_id) if s.action == REJECT]
    by_events = any(s.predicate is None for s in rejects)
    columns, spark = df.columns, df.sparkSession
    if by_events and screens.ROW_ADDRESS not in columns:
        df = with_addresses(df)
    events, counts = screens.all_events(df, file_screens, spec, batches, log_time)
    draft, path = f"{events_path}/_drafts/{uuid.uuid4().hex}", f"{events_path}/run_id={run_id}/file_id={spec.file_id}"
    events.write.parquet(draft)
    stop = screens.stop_of(counts, file_screens, spec)
    kept = spark.read.schema(events.schema).parquet(draft)
    kept = kept.where(F.col("screen_order") <= stop[0].order) if stop else kept
    kept.drop("screen_order").write.mode("overwrite").parquet(path)
    if stop:
        raise screens.DQStop(spec.file_id, stop[0].screen_id, stop[1])
    if not by_events:
        return screens.accepted(df, rejects, spec)
    stored = spark.read.schema(events.drop("screen_order").schema).parquet(path)
    return screens.without_rejected(df, stored, spec).select(*columns)


def validate_group(
    files: Iterable[tuple[TableSpec, DataFrame]], group_screens: Iterable[ScreenSpec], group_id: int,
    batches: DataFrame, log_time: datetime | str, events_path: str, run_id: str | int,
) -> None:
    result = screens.validate_group(files, group_screens, group_id, batches, log_time)
    result.events.write.mode("overwrite").parquet(f"{events_path}/run_id={run_id}/group_id={group_id}")
    result.raise_on_stop()


def run_checks(spark: SparkSession, specs: Sequence[CheckSpec], log_time: datetime | str, log_path: str) -> DataFrame:
    """Runs all checks, appends to the log and returns it."""
    checks.run(spark, specs, log_time).write.mode("append").parquet(log_path)
    return spark.read.parquet(log_path)
