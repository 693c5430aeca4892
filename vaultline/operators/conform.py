"""Frames brought to the columns, order and types that metadata declares for a layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.specs import (
    APPLIED_TIME, CURRENT, END, HASH_DIFF, LOAD_ID, LOAD_TIME, OPERATION, RECORD_SOURCE, START, UPDATE_FLAG_SUFFIX,
    ColumnSpec, HubSpec, LinkSpec, SatSpec, TableSpec,
)

REASONS = "load_reasons"
OPERATION_COLUMN = ColumnSpec(OPERATION, required=True)
VERSION_COLUMNS = (
    ColumnSpec(START, "timestamp_ntz", required=True),
    ColumnSpec(END, "timestamp_ntz", required=True),
    ColumnSpec(CURRENT, required=True),
)
AUDIT_COLUMNS = (
    ColumnSpec(LOAD_TIME, "timestamp_ntz", required=True),
    ColumnSpec(RECORD_SOURCE, required=True),
    ColumnSpec(LOAD_ID, "bigint", required=True),
)


def conform(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """The declared columns, in order and type. A value that does not fit its type becomes NULL;
    ``quality`` counts those."""
    types = dict(df.dtypes)
    return df.select(*[
        F.col(c.name) if types.get(c.name) == c.spark_type else F.col(c.name).try_cast(c.spark_type).alias(c.name)
        for c in columns
    ])


def cast(df: DataFrame, c: ColumnSpec) -> Column:
    return F.col(c.name) if dict(df.dtypes).get(c.name) == c.spark_type else F.col(c.name).try_cast(c.spark_type)


def with_reasons(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """``conform``, and in ``REASONS`` why a row must not be loaded: a value that its type cannot hold, or none where
    one is required. Rows without such a reason have an empty list."""
    return df.select(*[cast(df, c).alias(c.name) for c in columns], with_reasons_column(df, columns))


def with_reasons_column(df: DataFrame, columns: Sequence[ColumnSpec]) -> Column:
    reasons = []
    for c in columns:
        value = cast(df, c)
        reasons.append(F.when(F.col(c.name).isNotNull() & value.isNull(), F.lit(f"{c.name}: unreadable")))
        if c.required or c.is_key:
            reasons.append(F.when(F.col(c.name).isNull(), F.lit(f"{c.name}: missing")))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return found.alias(REASONS)


def quality(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Per column: values that do not fit the declared type, and missing values where one is required.

    One scan computes all counts; the single row is turned into one row per column afterwards.
    """
    counts = []
    for c in columns:
        value = F.col(c.name)
        counts.append(F.count_if(value.isNotNull() & value.try_cast(c.spark_type).isNull()).alias(f"{c.name}.bad"))
        missing = F.count_if(value.isNull()) if c.required else F.lit(0).cast("bigint")
        counts.append(missing.alias(f"{c.name}.missing"))
    rows = F.array(*[
        F.struct(
            F.lit(c.name).alias("column_nm"),
            F.col(f"`{c.name}.bad`").alias("bad_values"),
            F.col(f"`{c.name}.missing`").alias("missing_values"),
        )
        for c in columns
    ])
    return df.agg(*counts).select(F.inline(rows))


def staging_columns(spec: TableSpec) -> list[ColumnSpec]:
    return list(spec.columns)


def delta_columns(spec: TableSpec) -> list[ColumnSpec]:
    tracked = {c.name for c in spec.tracked}
    out = [OPERATION_COLUMN]
    for c in spec.columns:
        out.append(c)
        if c.name in tracked:
            out.append(ColumnSpec(c.name + UPDATE_FLAG_SUFFIX))
    return out


def history_columns(spec: TableSpec) -> list[ColumnSpec]:
    return [*spec.columns, *VERSION_COLUMNS]


def to_staging(df: DataFrame, spec: TableSpec) -> DataFrame:
    return conform(df, staging_columns(spec))


def to_delta(df: DataFrame, spec: TableSpec) -> DataFrame:
    return conform(df, delta_columns(spec))


def to_history(df: DataFrame, spec: TableSpec) -> DataFrame:
    return conform(df, history_columns(spec))


def bad_values(df: DataFrame, spec: TableSpec) -> DataFrame:
    return quality(df, staging_columns(spec))


def hub_columns(spec: HubSpec, source: DataFrame) -> list[ColumnSpec]:
    types, mapping = dict(source.dtypes), spec.sources[0].keys
    keys = [ColumnSpec(k, types.get(mapping[k]) or types[k], is_key=True, required=True) for k in spec.keys]
    return [ColumnSpec(spec.hash_key, required=True), *AUDIT_COLUMNS, *keys]


def link_columns(spec: LinkSpec) -> list[ColumnSpec]:
    return [
        ColumnSpec(spec.hash_key, required=True), *AUDIT_COLUMNS,
        *[ColumnSpec(k, required=True) for k in spec.hub_keys],
    ]


def sat_columns(spec: SatSpec, source: DataFrame) -> list[ColumnSpec]:
    """Attributes keep their source types and may be NULL where the source may."""
    fields = {f.name: f for f in source.schema.fields}
    return [
        ColumnSpec(spec.hash_key, required=True), *AUDIT_COLUMNS[:2],
        ColumnSpec(HASH_DIFF, required=True), ColumnSpec(APPLIED_TIME, "timestamp_ntz", required=True),
        AUDIT_COLUMNS[2],
        *[ColumnSpec(a, fields[a].dataType.simpleString(), required=not fields[a].nullable) for a in spec.attributes],
    ]
