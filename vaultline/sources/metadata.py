"""Specs from the metadata tables. Only the rows of the chosen objects come to the driver."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from vaultline.specs import (
    GEOMETRY, HASH_KEY_SUFFIX, CheckSpec, ColumnSpec, HubSource, HubSpec, LinkSource, LinkSpec, SatSpec, ScreenSpec,
    TableSpec,
)

# Source data types and the Spark types they become.
SPARK_TYPES = {
    "VARCHAR2": "string", "VARCHAR": "string", "NVARCHAR": "string", "CHAR": "string", "CLOB": "string",
    "DATE": "timestamp_ntz", "DATETIME": "timestamp_ntz", "INT": "int", "BIGINT": "bigint", "BIT": "boolean",
    "SDO_GEOMETRY": GEOMETRY,
}
DECIMAL_TYPES = ("NUMBER", "DECIMAL", "NUMERIC")


def spark_type(data_type: str, length: int | None = None, scale: int | None = None) -> str:
    name = data_type.upper()
    if name in DECIMAL_TYPES:
        return f"decimal({length or 38},{scale or 0})" if length else "decimal(38,10)"
    if name not in SPARK_TYPES:
        raise ValueError(f"unknown data type {data_type}")
    return SPARK_TYPES[name]


def table_specs(files: DataFrame, columns: DataFrame, group_id: int | None = None) -> list[TableSpec]:
    """Files, of one group or all, with their columns in order."""
    chosen = files if group_id is None else files.where(F.col("SRC_FILE_GROUP_ID") == group_id)
    by_file: dict[int, list[Row]] = {}
    for row in columns.join(chosen.select("SRC_FILE_ID"), "SRC_FILE_ID", "left_semi").collect():
        by_file.setdefault(row.SRC_FILE_ID, []).append(row)
    specs = []
    for file in chosen.orderBy("SRC_FILE_ID").collect():
        ordered = sorted(by_file.get(file.SRC_FILE_ID, []), key=lambda r: r.SRC_COLUMN_ID)
        specs.append(TableSpec(
            file.SRC_TABLE_NM,
            tuple(
                ColumnSpec(
                    r.SRC_COLUMN_NM, spark_type(r.DATA_TYPE, r.LENGTH_NUM, r.SCALE_NUM),
                    is_key=r.IS_NATURAL_KEY_IND == "Y", keep_history=r.PRESERVE_HISTORY_IND == "Y",
                    required=r.IS_NATURAL_KEY_IND == "Y",
                )
                for r in ordered
            ),
            file_id=file.SRC_FILE_ID, group_id=file.SRC_FILE_GROUP_ID, snapshot_type=file.SNAPSHOT_TYPE or "FULL",
        ))
    return specs


def screen_specs(screens: DataFrame, file_ids: Sequence[int]) -> list[ScreenSpec]:
    """Screens of the given files. ``SCREEN_SQL`` is a predicate over the file's columns, or a query
    with one column, the ids of failing rows."""
    spark, out = screens.sparkSession, []
    for r in screens.where(F.col("SRC_FILE_ID").isin(*file_ids)).orderBy("SRC_FILE_ID", "SCREEN_ORDER").collect():
        text = r.SCREEN_SQL.strip()
        is_query = _begins(text) in ("select", "with")
        out.append(ScreenSpec(
            r.SCREEN_ID, r.SRC_FILE_ID, r.SCREEN_ORDER, r.EXCEPTION_ACTION,
            predicate=None if is_query else text,
            query=(lambda q=text: spark.sql(q).toDF("row_id")) if is_query else None,
            name=r.SCREEN_NM,
        ))
    return out


def check_specs(checks: DataFrame) -> list[CheckSpec]:
    return [
        CheckSpec(
            r.dq_check_id, r.sql_query, _number(r.target_min_value), _number(r.target_max_value), r.dq_check_name,
            r.dq_check_desc, r.dq_check_group,
        )
        for r in checks.orderBy("dq_check_id").collect()
    ]


def hub_specs(mapping: DataFrame, schema: str | None = None, name: str | None = None) -> list[HubSpec]:
    specs = []
    for (hub_schema, hub_name), rows in _grouped(mapping, "HubSchema", "HubName", schema, name).items():
        sources = []
        for (database, source_schema, source), keys in _by(rows, "SrcDatabase", "SrcSchema", "SrcObject").items():
            # Keys meet their hub columns by name, whatever order their positions give.
            ordered = sorted(keys, key=lambda r: (r.ColumnPosition, r.HubBusinessKey))
            sources.append(HubSource(
                source, {r.HubBusinessKey: r.SrcBusinessKey for r in ordered}, ordered[0].RecordSource, source_schema, database
            ))
        specs.append(HubSpec(hub_name, tuple(sources), hub_schema))
    return specs


def link_specs(mapping: DataFrame, schema: str | None = None, name: str | None = None) -> list[LinkSpec]:
    specs = []
    for (link_schema, link_name), rows in _grouped(mapping, "LinkSchema", "LinkName", schema, name).items():
        sources = []
        for (database, source_schema, source), keys in _by(rows, "SrcDatabase", "SrcSchema", "SrcObject").items():
            hubs: dict[str, list[str]] = {}
            for r in sorted(keys, key=lambda r: r.LinkHubHashKeyColumnPosition):
                hubs.setdefault(r.LinkHubHashKeyName, []).append(r.SrcBusinessKey)
            sources.append(LinkSource(source, hubs, keys[0].RecordSource, source_schema, database))
        specs.append(LinkSpec(link_name, tuple(sources), link_schema))
    return specs


def sat_specs(
    mapping: DataFrame, schema: str | None = None, name: str | None = None, hubs: Iterable[HubSpec] = ()
) -> list[SatSpec]:
    """A satellite of which key columns are missing from the mapping (because they are foreign keys as
    well) takes its whole key from the hub of the same source object."""
    hub_keys = {(s.schema, s.object_name): tuple(s.keys.values()) for h in hubs for s in h.sources}
    specs = []
    for (sat_schema, sat_name), rows in _grouped(mapping, "SatSchema", "SatName", schema, name).items():
        ordered = sorted(rows, key=lambda r: r.ColumnPosition)
        keys = [r for r in ordered if r.IsColumnBusinessKey]
        rest = [r for r in ordered if not r.IsColumnBusinessKey]
        specs.append(SatSpec(
            sat_name,
            tuple(r.SatColumn for r in rest),
            keys=max(tuple(r.SrcColumn for r in keys), hub_keys.get((ordered[0].SrcSchema, ordered[0].SrcObject), ()), key=len),
            schema=sat_schema, object_name=ordered[0].SrcObject, record_source=ordered[0].RecordSource,
            key_name=keys[0].SatColumn if keys else sat_name[len("Sat"):] + HASH_KEY_SUFFIX,
            diff_columns=tuple(r.SatColumn for r in rest if r.IsColumnPartOfHashDiffKey),
            renamed={r.SatColumn: r.SrcColumn for r in rest if r.SatColumn != r.SrcColumn},
            source_schema=ordered[0].SrcSchema, database=ordered[0].SrcDatabase,
        ))
    return specs


def _begins(text: str) -> str:
    """The first word of a SQL text, after comments and opening brackets."""
    rest = re.sub(r"^(?:\s+|--[^\n]*(?:\n|$)|/\*.*?\*/|\()+", "", text, flags=re.DOTALL)
    word = re.match(r"\w+", rest)
    if not rest:
        raise ValueError("a screen has no text")
    return word[0].lower() if word else ""


def _grouped(mapping: DataFrame, schema_column: str, name_column: str, schema: str | None, name: str | None):
    """The mapping's rows by object. A mapping has a row for each column of the objects chosen, all of a model's if no
    schema and no name are given; it is metadata, and no data row passes through here."""
    every = (None, "NULL", "ALL")
    if schema not in every:
        mapping = mapping.where(F.col(schema_column) == schema)
    if name not in every:
        mapping = mapping.where(F.col(name_column) == name)
    return _by(mapping.orderBy(schema_column, name_column).collect(), schema_column, name_column)


def _by(rows: Iterable[Row], *columns: str) -> dict[tuple, list[Row]]:
    groups: dict[tuple, list[Row]] = {}
    for row in rows:
        groups.setdefault(tuple(row[c] for c in columns), []).append(row)
    return dict(sorted(groups.items(), key=lambda item: tuple(str(v) for v in item[0])))


def _number(value) -> Decimal | None:
    return None if value is None else Decimal(str(value))
