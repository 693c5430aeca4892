"""The vault model from the catalog of the staging tables and the key dictionaries of their sources.

Every input is a frame with the columns of its metadata table (catalog ``table_*`` columns,
``SrcPKConstraint``, ``SrcFKConstraint``, reference and hub mappings), and so is every result. The
windows run over the rows of one table or link, which the columns of a table bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.naming import entity
from vaultline.specs import HASH_KEY_SUFFIX

# Schema prefixes, and what stands for a key that the dictionary does not know.
STAGING_PREFIX, RAW_VAULT_PREFIX = "STG", "RV_"
SYSTEM_START = 5
NO_KEY, NO_POSITION = "UNDEFINED", -1
# Parent keys of a link are placed after the child's own keys.
PARENT_OFFSET = 100


def fk_dictionary(constraints: DataFrame, columns: DataFrame, scope: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """Foreign keys of the dictionary: child and parent columns paired by position. ``scope`` maps each
    owner of parent tables to table names, or to None for all of them.

    Two joins of rows, each on whole constraint names: nothing is gathered into lists before, and each side is shuffled
    and sorted once for its join."""
    part = [F.col("position").alias("ColumnPosition"), "column_name", "table_name"]
    foreign = constraints.where(F.col("constraint_type") == "R").select("owner", "constraint_name", "r_owner", "r_constraint_name")
    child = columns.select("owner", "constraint_name", *part).withColumnsRenamed({"column_name": "ChildColumn", "table_name": "ChildTable"})
    parent = columns.where(_in_scope(scope)).select(
        F.col("owner").alias("r_owner"), F.col("constraint_name").alias("r_constraint_name"), *part
    ).withColumnsRenamed({"column_name": "ParentColumn", "table_name": "ParentTable"})
    return foreign.join(child, ["owner", "constraint_name"]).join(parent, ["r_owner", "r_constraint_name", "ColumnPosition"]).select(
        "ParentTable", "ParentColumn", "ChildTable", "ChildColumn", "ColumnPosition", F.col("constraint_name").alias("FKConstraintName")
    )


def pk_dictionary(constraints: DataFrame, columns: DataFrame, scope: Mapping[str, Sequence[str] | None]) -> DataFrame:
    primary = constraints.where(F.col("constraint_type") == "P").select("owner", "constraint_name")
    return primary.join(columns.where(_in_scope(scope)), ["owner", "constraint_name"]).select(
        F.col("table_name").alias("SrcTable"), F.col("column_name").alias("SrcColumn"),
        F.col("position").alias("ColumnPosition"), F.col("constraint_name").alias("PKConstraintName"),
    )


def hubs(tables: DataFrame, pk: DataFrame, ref: DataFrame) -> DataFrame:
    """One hub per staging table that is no reference table, a row for each part of its primary key."""
    keys = pk.select(F.col("SrcTable").alias("table_name"), "SrcColumn", "ColumnPosition")
    key = F.coalesce("SrcColumn", F.lit(NO_KEY))
    return (
        _staged(tables, ref)
        .join(keys, "table_name", "left")
        .select(
            F.col("table_catalog").alias("SrcDatabase"), F.col("table_schema").alias("SrcSchema"),
            F.col("table_name").alias("SrcObject"), key.alias("SrcBusinessKey"),
            _vault_schema().alias("HubSchema"), _named("Hub", F.col("table_name")).alias("HubName"),
            key.alias("HubBusinessKey"), F.coalesce("ColumnPosition", F.lit(NO_POSITION)).alias("ColumnPosition"),
            _system().alias("RecordSource"),
        )
    )


def sats(columns: DataFrame, pk: DataFrame, fk: DataFrame, ref: DataFrame) -> DataFrame:
    """Columns of each satellite: the key becomes the hash key, foreign keys are left to the links
    unless they point to a reference table, and positions are numbered over what remains."""
    place = ["table_name", "column_name"]
    keys = pk.select(
        F.col("SrcTable").alias("table_name"), F.col("SrcColumn").alias("column_name"), F.lit(True).alias("_key")
    ).distinct()
    to_reference = ref.select(F.col("SrcObject").alias("ParentTable"), F.lit(True).alias("_ref")).distinct()
    # A column in several foreign keys counts once: kept if any of them points to a reference table.
    foreign = (
        fk.join(to_reference, "ParentTable", "left")
        .groupBy(F.col("ChildTable").alias("table_name"), F.col("ChildColumn").alias("column_name"))
        .agg(F.max(F.col("_ref").isNotNull()).alias("_kept"))
    )
    is_key = F.col("_key").isNotNull()
    by_table = Window.partitionBy("table_catalog", "table_schema", "table_name").orderBy("ordinal_position")
    return (
        _staged(columns, ref)
        .join(keys, place, "left")
        .join(foreign, place, "left")
        .where(F.coalesce("_kept", F.lit(True)))
        .select(
            F.col("table_catalog").alias("SrcDatabase"), F.col("table_schema").alias("SrcSchema"),
            F.col("table_name").alias("SrcObject"), F.col("column_name").alias("SrcColumn"),
            _vault_schema().alias("SatSchema"), _named("Sat", F.col("table_name")).alias("SatName"),
            F.when(is_key, _hash_key(F.col("table_name"))).otherwise(F.col("column_name")).alias("SatColumn"),
            F.row_number().over(by_table).alias("ColumnPosition"),
            is_key.cast("int").alias("IsColumnBusinessKey"), (~is_key).cast("int").alias("IsColumnPartOfHashDiffKey"),
            _system().alias("RecordSource"),
        )
    )


def links(fk: DataFrame, tables: DataFrame, ref: DataFrame, hub_mapping: DataFrame) -> DataFrame:
    """One link per child and parent table, with the hash keys of the child and of each parent role.

    The first foreign key to a parent takes the parent's name, further ones the name of their column;
    a parent key that would clash with the child's own key is prefixed. Child keys come first.

    The foreign keys are dealt by child table, where those of a pair of tables are neighbours and meet the child's keys, a
    list that the columns of a table bound; the first of a pair brings these along. Names are made once for each table,
    not for each foreign key, wherever the table is known.
    """
    pair = Window.partitionBy("ChildTable", "ParentTable")
    roles = (
        fk.join(ref.select(F.col("SrcObject").alias("ParentTable")).distinct(), "ParentTable", "left_anti")
        .select("ChildTable", "ParentTable", "FKConstraintName", "ChildColumn", "ColumnPosition").repartition("ChildTable")
        .withColumn("_n", F.row_number().over(pair.orderBy("FKConstraintName")))
        .withColumn("_main", F.min("FKConstraintName").over(pair))
    )
    parent_tables = tables.where(F.col("table_schema").startswith(STAGING_PREFIX)).select(
        "table_catalog", "table_schema", F.col("table_name").alias("ParentTable"), entity(F.col("table_name")).alias("_parent_entity")
    )
    hub_keys = hub_mapping.groupBy(F.col("SrcObject").alias("ChildTable")).agg(
        F.collect_list(F.struct("SrcBusinessKey", "ColumnPosition", "HubName")).alias("keys")
    ).withColumn("_child_entity", entity(F.col("ChildTable")))
    named = roles.join(hub_keys, "ChildTable", "left").join(parent_tables, "ParentTable", "left").select(
        "*", F.coalesce("_child_entity", entity(F.col("ChildTable"))).alias("_child"), F.coalesce("_parent_entity", entity(F.col("ParentTable"))).alias("_parent")
    )

    def entry(column: Column, key: Column, position: Column, hub: Column) -> Column:
        return F.struct(column.alias("SrcBusinessKey"), key.alias("LinkHubHashKeyName"), position.alias("_position"), hub.alias("HubName"))

    name = F.when(F.col("FKConstraintName") == F.col("_main"), F.col("_parent")).otherwise(entity(F.col("ChildColumn"), drop=["ID"]))
    # The child's own key is named after it, if it has a hub.
    name = F.when(F.col("keys").isNotNull() & (name == F.col("_child")), F.concat(F.lit("Parent"), name)).otherwise(name)
    of_parent = entry(F.col("ChildColumn"), F.concat(name, F.lit(HASH_KEY_SUFFIX)), F.col("ColumnPosition") + PARENT_OFFSET, F.concat(F.lit("Hub"), F.col("_parent")))
    own_key = F.concat("_child", F.lit(HASH_KEY_SUFFIX))
    own = F.transform("keys", lambda k: entry(k["SrcBusinessKey"], own_key, k["ColumnPosition"], k["HubName"]))
    text = F.lit(None).cast("string")
    no_hub = F.array(entry(text, text, F.lit(None).cast("int"), text))
    entries = F.when(F.col("_n") == 1, F.concat(F.coalesce(own, no_hub), F.array(of_parent))).otherwise(F.array(of_parent))
    rows = named.select(
        F.col("table_catalog").alias("SrcDatabase"), F.col("table_schema").alias("SrcSchema"), F.col("ChildTable").alias("SrcObject"),
        _vault_schema().alias("LinkSchema"), F.concat(F.lit("Link"), "_child", "_parent").alias("LinkName"), _system().alias("RecordSource"),
        F.inline(entries),
    )
    by_link = Window.partitionBy("LinkName").orderBy("_position", "LinkHubHashKeyName", "SrcBusinessKey")
    return rows.select(
        "SrcDatabase", "SrcSchema", "SrcObject", "SrcBusinessKey", "LinkSchema", "LinkName", "LinkHubHashKeyName",
        F.row_number().over(by_link).alias("LinkHubHashKeyColumnPosition"), "HubName", "RecordSource",
    )


def shared_link_names(link_mapping: DataFrame) -> DataFrame:
    """Link names used in more than one schema, whose columns would be numbered together."""
    return (
        link_mapping.groupBy("LinkName").agg(F.count_distinct("LinkSchema").alias("schemas")).where(F.col("schemas") > 1)
    )


def catalog(frames: Mapping[tuple[str, str, str], DataFrame]) -> DataFrame:
    """Catalog columns of frames named by (database, schema, table). Only schemas pass through the driver."""
    rows = [
        (database, schema, table, field.name, position)
        for (database, schema, table), frame in frames.items()
        for position, field in enumerate(frame.schema.fields, start=1)
    ]
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(
        rows, "table_catalog string, table_schema string, table_name string, column_name string, ordinal_position int"
    )


def _staged(catalog_rows: DataFrame, ref: DataFrame) -> DataFrame:
    references = ref.select(F.col("SrcSchema").alias("table_schema"), F.col("SrcObject").alias("table_name"))
    return catalog_rows.where(F.col("table_schema").startswith(STAGING_PREFIX)).join(
        references, ["table_schema", "table_name"], "left_anti"
    )


def _system() -> Column:
    return F.substr(F.col("table_schema"), F.lit(SYSTEM_START))


def _vault_schema() -> Column:
    return F.concat(F.lit(RAW_VAULT_PREFIX), _system())


def _named(kind: str, table: Column) -> Column:
    return F.concat(F.lit(kind), entity(table))


def _hash_key(table: Column) -> Column:
    return F.concat(entity(table), F.lit(HASH_KEY_SUFFIX))


def _in_scope(scope: Mapping[str, Sequence[str] | None]) -> Column:
    return reduce(or_, [
        (F.col("owner") == owner) & (F.lit(True) if names is None else F.col("table_name").isin(*names))
        for owner, names in scope.items()
    ])
