"""Row-level screens: failing rows become events; an action decides what happens to them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vaultline.functions.clock import timestamp
from vaultline.functions.keys import row_id
from vaultline.functions.skew import lookup
from vaultline.specs import REJECT, STOP, ScreenSpec, TableSpec

LAST_ORDER = 2**31 - 1
# Where a row is stored, in frames that ``materialize.store_addressed`` gives, and in their events.
ROW_ADDRESS = "row_address"


class DQStop(Exception):
    """A STOP screen found failing rows."""

    def __init__(self, file_id: int, screen_id: int, failures: int):
        super().__init__(f"screen {screen_id} of file {file_id} stopped the load: {failures} failing rows")
        self.file_id, self.screen_id, self.failures = file_id, screen_id, failures


@dataclass(frozen=True)
class Validation:
    """Events of the screens that ran, and one row (or none) for the screen that stopped the run."""

    events: DataFrame
    stop: DataFrame

    def raise_on_stop(self) -> None:
        """Call after the events are stored, so that they survive the stop."""
        row = self.stop.first()
        if row is not None:
            raise DQStop(row["src_file_id"], row["screen_id"], row["failures"])


def in_order(screens: Iterable[ScreenSpec], file_id: int) -> list[ScreenSpec]:
    mine = sorted((s for s in screens if s.file_id == file_id), key=lambda s: s.order)
    orders = [s.order for s in mine]
    if len(set(orders)) != len(orders):
        raise ValueError(f"file {file_id}: two screens share one order")
    return mine


def latest_batch(batches: DataFrame) -> DataFrame:
    """The latest batch of every file."""
    return batches.groupBy("src_file_id").agg(F.max("batch_id").alias("batch_id"))


def failing(df: DataFrame, screens: Sequence[ScreenSpec], spec: TableSpec) -> DataFrame:
    """One row per failing row and screen. All predicate screens share one scan, and rows that pass
    every screen are dropped in that scan; query screens bring their own rows, with their addresses if they have them."""
    parts = []
    address = F.col(ROW_ADDRESS) if ROW_ADDRESS in df.columns else F.lit(None).cast("string")
    predicates = [s for s in screens if s.predicate is not None]
    if predicates:
        hits = F.array(*[F.when(F.expr(s.predicate), _tag(s)) for s in predicates])
        parts.append(
            df.where(_any(predicates))
            .select(row_id(spec.keys).alias("row_id"), address.alias(ROW_ADDRESS), F.explode(hits).alias("hit"))
            .where(F.col("hit").isNotNull())
            .select("hit.*", "row_id", ROW_ADDRESS)
        )
    for s in screens:
        if s.query is not None:
            found = s.query()
            where = F.col(ROW_ADDRESS) if ROW_ADDRESS in found.columns else F.lit(None).cast("string").alias(ROW_ADDRESS)
            parts.append(found.select(_tag(s).alias("hit"), "row_id", where).select("hit.*", "row_id", ROW_ADDRESS))
    return reduce(DataFrame.unionByName, parts)


def stop_counts(df: DataFrame, screens: Sequence[ScreenSpec], spec: TableSpec) -> DataFrame | None:
    """Failures of each STOP screen, counted in one pass over the columns they read."""
    stops = [s for s in screens if s.action == STOP]
    if not stops:
        return None
    parts = []
    predicates = [s for s in stops if s.predicate is not None]
    if predicates:
        counts = df.agg(*[F.count_if(F.expr(s.predicate)).alias(f"c{s.screen_id}") for s in predicates])
        rows = F.array(*[F.struct(_tag(s).alias("hit"), F.col(f"c{s.screen_id}").alias("failures")) for s in predicates])
        parts.append(counts.select(F.inline(rows)).select("hit.*", "failures"))
    for s in stops:
        if s.query is not None:
            counted = s.query().agg(F.count(F.lit(1)).alias("failures"))
            parts.append(counted.select(_tag(s).alias("hit"), "failures").select("hit.*", "failures"))
    return (
        reduce(DataFrame.unionByName, parts)
        .where(F.col("failures") > 0)
        .select(F.lit(spec.file_id).alias("src_file_id"), "screen_order", "screen_id", "failures")
    )


def validate(
    df: DataFrame, screens: Iterable[ScreenSpec], spec: TableSpec, batches: DataFrame, log_time: datetime | str
) -> Validation:
    """Runs the screens of one file in order. The first STOP screen with failures is the last to run:
    its events are kept, those of later screens are not."""
    mine = in_order(screens, spec.file_id)
    if not mine:
        raise ValueError(f"{spec.table}: no screens")
    events = _events(failing(df, mine, spec), spec, batches, log_time)
    counts = stop_counts(df, mine, spec)
    if counts is None:
        return Validation(events.drop("screen_order"), _no_stop(df))
    first = counts.agg(F.min("screen_order")).scalar()
    kept = events.where(F.col("screen_order") <= F.coalesce(first, F.lit(LAST_ORDER)))
    return Validation(kept.drop("screen_order"), _first(counts))


def all_events(
    df: DataFrame, screens: Iterable[ScreenSpec], spec: TableSpec, batches: DataFrame, log_time: datetime | str
) -> tuple[DataFrame, Observation]:
    """The events of all screens of one file, with ``screen_order``, and the failures of its STOP screens, counted in
    the pass that stores the events; ``stop_of`` reads them, and events of a later order are not part of the log."""
    mine = in_order(screens, spec.file_id)
    if not mine:
        raise ValueError(f"{spec.table}: no screens")
    counts, events = Observation(), _events(failing(df, mine, spec), spec, batches, log_time)
    stops = [F.count_if(F.col("screen_id") == s.screen_id).alias(f"stop_{s.screen_id}") for s in mine if s.action == STOP]
    return events.observe(counts, F.count(F.lit(1)).alias("events"), *stops), counts


def stop_of(counts: Observation, screens: Iterable[ScreenSpec], spec: TableSpec) -> tuple[ScreenSpec, int] | None:
    """The first STOP screen with failures and their number, once the events are stored."""
    seen = counts.get
    return next(((s, seen[f"stop_{s.screen_id}"]) for s in in_order(screens, spec.file_id) if s.action == STOP and seen[f"stop_{s.screen_id}"]), None)


def validate_group(
    files: Iterable[tuple[TableSpec, DataFrame]], screens: Iterable[ScreenSpec], group_id: int,
    batches: DataFrame, log_time: datetime | str,
) -> Validation:
    """``validate`` for the files of a group that have columns and screens, in file order. A stop also
    keeps the later files from running."""
    screens = list(screens)
    chosen = sorted(
        ((s, df) for s, df in files if s.group_id == group_id and s.columns and in_order(screens, s.file_id)),
        key=lambda pair: pair[0].file_id,
    )
    if not chosen:
        raise ValueError(f"group {group_id}: no file has columns and screens")
    parts, counts = [], []
    for spec, df in chosen:
        mine = in_order(screens, spec.file_id)
        parts.append(_events(failing(df, mine, spec), spec, batches, log_time))
        counted = stop_counts(df, mine, spec)
        if counted is not None:
            counts.append(counted)
    events = reduce(DataFrame.unionByName, parts)
    if not counts:
        return Validation(events.drop("screen_order"), _no_stop(chosen[0][1]))
    stops = reduce(DataFrame.unionByName, counts)
    position = F.struct("src_file_id", "screen_order")
    last = F.struct(F.lit(LAST_ORDER).alias("src_file_id"), F.lit(LAST_ORDER).alias("screen_order"))
    first = stops.agg(F.min(position)).scalar()
    return Validation(events.where(position <= F.coalesce(first, last)).drop("screen_order"), _first(stops))


def accepted(df: DataFrame, screens: Iterable[ScreenSpec], spec: TableSpec) -> DataFrame:
    """Rows that no REJECT predicate screen refuses: a filter, without join or shuffle."""
    rejects = [s for s in in_order(screens, spec.file_id) if s.action == REJECT]
    if any(s.predicate is None for s in rejects):
        raise ValueError("query screens name rows by id: use without_rejected")
    return df.where(~F.coalesce(_any(rejects), F.lit(False))) if rejects else df


def without_rejected(df: DataFrame, events: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that have no REJECT event, from a stored event log.

    Where both have a row address, events of predicate screens refuse exactly their rows. Events of query screens,
    and those of frames without addresses, know rows by their key text alone.
    """
    rejects = events.where((F.col("exception_action") == REJECT) & (F.col("src_file_id") == spec.file_id))
    if ROW_ADDRESS in df.columns:
        df = df.join(rejects.where(F.col(ROW_ADDRESS).isNotNull()).select(ROW_ADDRESS).distinct(), ROW_ADDRESS, "left_anti").select(*df.columns)
        rejects = rejects.where(F.col(ROW_ADDRESS).isNull())
    refused = rejects.select(F.col("row_id").alias("_row_id")).distinct()
    tagged = df.withColumn("_row_id", row_id(spec.keys))
    marked = lookup(tagged, refused.withColumn("_refused", F.lit(True)), ["_row_id"])
    return marked.where(F.col("_refused").isNull()).select(*df.columns)


def event_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("screen_id", "exception_action").agg(F.count(F.lit(1)).alias("event_count"))


def _any(screens: Sequence[ScreenSpec]) -> Column:
    return reduce(or_, [F.expr(s.predicate) for s in screens])


def _tag(screen: ScreenSpec) -> Column:
    return F.struct(
        F.lit(screen.order).alias("screen_order"),
        F.lit(screen.screen_id).alias("screen_id"),
        F.lit(screen.action).alias("exception_action"),
    )


def _events(rows: DataFrame, spec: TableSpec, batches: DataFrame, log_time: datetime | str) -> DataFrame:
    batch = batches.where(F.col("src_file_id") == spec.file_id).agg(F.max("batch_id")).scalar()
    return rows.select(
        "screen_order", "screen_id", batch.alias("batch_id"), F.lit(spec.file_id).alias("src_file_id"),
        timestamp(log_time).alias("log_dt"), "exception_action", "row_id", F.lit(spec.table).alias("table_nm"), ROW_ADDRESS,
    )


def _first(stops: DataFrame) -> DataFrame:
    """The stop that comes first by file and order: one row, or none."""
    position = F.struct("src_file_id", "screen_order", "screen_id", "failures")
    return (
        stops.agg(F.min(position).alias("s")).where(F.col("s").isNotNull())
        .select("s.src_file_id", "s.screen_id", "s.failures")
    )


def _no_stop(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "src_file_id int, screen_id int, failures bigint")
