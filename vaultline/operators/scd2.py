"""Type-2 history: close the versions that a delta ends, open the ones it starts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.clock import as_datetime, timestamp
from vaultline.functions.keys import any_null
from vaultline.operators.cdc import compare, current, group_files
from vaultline.specs import (
    ADD, CURRENT, END, MODIFY, OPEN_END, OPERATION, REMOVE, START, UPDATE_FLAG_SUFFIX, TableSpec,
)


def close_current(sds: DataFrame, delta: DataFrame, spec: TableSpec, file_date: datetime | str) -> DataFrame:
    """The current rows, those of modified and removed keys ended one second before ``file_date``.

    A version that would end before it starts fails the job. The delta's keys are combined before
    their shuffle; a small delta is broadcast by the optimizer on its measured size.
    """
    moment = as_datetime(file_date)
    ended_keys = (
        delta.where(F.col(OPERATION).isin(MODIFY, REMOVE))
        .select(*spec.keys)
        .dropna()
        .distinct()
        .withColumn("_ended", F.lit(True))
    )
    ended = F.col("_ended").isNotNull()
    too_early = F.raise_error(F.lit(f"{spec.table}: file date {moment} is not after the start of a current row"))
    end = (
        F.when(ended & (F.col(START) >= timestamp(moment)), too_early)
        .when(ended, timestamp(moment - timedelta(seconds=1)))
        .otherwise(F.col(END))
    )
    return (
        current(sds)
        .join(ended_keys, spec.keys, "left")
        .select(*_version_columns(spec, F.col(START), end, F.when(ended, "N").otherwise("Y")))
    )


def close(sds: DataFrame, delta: DataFrame, spec: TableSpec, file_date: datetime | str) -> DataFrame:
    """The whole history after closing. Old versions pass by without a join."""
    older = sds.where(~F.col(CURRENT).eqNullSafe("Y"))
    return older.select(*_version_columns(spec, F.col(START), F.col(END), F.col(CURRENT))).unionByName(
        close_current(sds, delta, spec, file_date)
    )


def open_versions(delta: DataFrame, spec: TableSpec, file_date: datetime | str) -> DataFrame:
    """One current version for each added or modified row."""
    return delta.where(F.col(OPERATION).isin(MODIFY, ADD)).select(
        *_version_columns(spec, timestamp(file_date), timestamp(OPEN_END), F.lit("Y"))
    )


def apply(sds: DataFrame, delta: DataFrame, spec: TableSpec, file_date: datetime | str) -> DataFrame:
    """History after the delta. Two branches read the delta: pass one that is stored or checkpointed."""
    return close(sds, delta, spec, file_date).unionByName(open_versions(delta, spec, file_date))


def advance(
    stg: DataFrame, sds: DataFrame, spec: TableSpec, file_date: datetime | str, **options
) -> DataFrame:
    """Delta and apply in one join: what the current rows become, each with the operation and update
    flags of the row it comes from.

    Rows with an operation are the delta (a removed row is the version it closed), rows without one are
    unchanged or the closed side of a modified row. Closed versions of earlier batches are not part of
    it. The natural key must be unique on both sides, as a repeated staged key would repeat its stored
    row (``before_rows`` lets a caller count them); stored rows with a NULL key part stay as they are.
    """
    moment = as_datetime(file_date)
    compared = compare(stg, sds, spec, carry=(START, END, CURRENT), **options)
    operation, first = F.col(OPERATION), spec.keys[0]
    keyed = F.col(f"o_{first}").isNotNull() & ~any_null([f"o_{k}" for k in spec.keys])
    ended = keyed & operation.isin(MODIFY, REMOVE)
    too_early = F.raise_error(F.lit(f"{spec.table}: file date {moment} is not after the start of a current row"))
    end = (
        F.when(ended & (F.col(f"o_{START}") >= timestamp(moment)), too_early)
        .when(ended, timestamp(moment - timedelta(seconds=1)))
        .otherwise(F.col(f"o_{END}"))
    )
    flags = [c.name + UPDATE_FLAG_SUFFIX for c in spec.tracked]

    def version(values: list[Column], op: Column, start: Column, until: Column, flag: Column, marks: list[Column]) -> Column:
        return F.struct(
            op.alias(OPERATION), *values, *marks, start.alias(START), until.alias(END), flag.alias(CURRENT)
        )

    not_flagged = [F.lit("N").alias(f) for f in flags]
    old_values = [F.col(f"o_{c}").alias(c) for c in spec.names]
    old = version(
        old_values, F.when(keyed & (operation == REMOVE), REMOVE), F.col(f"o_{START}"), end,
        F.when(ended, "N").otherwise("Y"), not_flagged,
    )
    new = version(
        [F.when(F.col(f"s_{first}").isNotNull(), F.col(f"s_{c}")).alias(c) for c in spec.names], operation, timestamp(moment), timestamp(OPEN_END), F.lit("Y"),
        [F.col(f) for f in flags],
    )
    has_old = F.col(f"o_{CURRENT}").isNotNull()
    versions = (
        F.when(has_old & (operation == MODIFY), F.array(old, new))
        .when(has_old, F.array(old))
        .otherwise(F.array(new))
    )
    return compared.select(F.inline(versions))


def before_rows() -> Column:
    """Counts the rows of an advanced history that were current before it."""
    return F.count_if(F.col(OPERATION).isNull() | (F.col(OPERATION) == REMOVE))


def apply_group(
    specs: Iterable[TableSpec], group_id: int, history: dict[str, DataFrame], deltas: dict[str, DataFrame],
    file_date: datetime | str,
) -> dict[str, DataFrame]:
    """``apply`` for each file of the group, all at one file date."""
    return {
        s.table: apply(history[s.table], deltas[s.table], s, file_date) for s in group_files(specs, group_id)
    }


def as_of(sds: DataFrame, moment: datetime | str) -> DataFrame:
    """The versions valid at a moment."""
    at = timestamp(moment)
    return sds.where((F.col(START) <= at) & (at <= F.col(END)))


def key_violations(sds: DataFrame, spec: TableSpec) -> DataFrame:
    """Natural key and start date combinations that occur more than once."""
    return (
        sds.groupBy(*spec.keys, START).agg(F.count(F.lit(1)).alias("version_count"))
        .where(F.col("version_count") > 1)
    )


def _version_columns(spec: TableSpec, start: Column, end: Column, flag: Column) -> list[Column]:
    return [*[F.col(c) for c in spec.names], start.alias(START), end.alias(END), flag.alias(CURRENT)]
