"""Runs driven by metadata tables: frames of metadata become specs, and these load, compare, screen and check the data."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.base import LOAD_TIME, Data, query
from registry.cdc_queries import CUSTOMER, ORDERS, PART, delta_sql
from vaultline.functions.hashing import HashRule
from vaultline.operators import cdc, checks, conform, model, screens, vault
from vaultline.sources import metadata
from vaultline.specs import TableSpec

# --- Files and their columns -------------------------------------------------------------------------------------

SOURCE_TYPES = {"bigint": ("NUMBER", 19, 0), "decimal(18,2)": ("NUMBER", 18, 2), "string": ("VARCHAR2", 100, None)}


def file_tables(data: Data) -> tuple[DataFrame, DataFrame]:
    files = [(s.file_id, s.table, "FULL", 1) for s in (ORDERS, CUSTOMER, PART)] + [(9, "elsewhere", "DELTA", 2)]
    columns = [
        (s.file_id, place, c.name, *SOURCE_TYPES[c.data_type], "Y" if c.is_key else "N", "Y" if c.keep_history else "N")
        for s in (ORDERS, CUSTOMER, PART) for place, c in enumerate(s.columns, 1)
    ]
    return (
        data.spark.createDataFrame(files, "SRC_FILE_ID int, SRC_TABLE_NM string, SNAPSHOT_TYPE string, SRC_FILE_GROUP_ID int"),
        data.spark.createDataFrame(columns, "SRC_FILE_ID int, SRC_COLUMN_ID int, SRC_COLUMN_NM string, DATA_TYPE string, LENGTH_NUM int,"
                                            " SCALE_NUM int, IS_NATURAL_KEY_IND string, PRESERVE_HISTORY_IND string"),
    )


def group_specs(data: Data) -> list[TableSpec]:
    return metadata.table_specs(*file_tables(data), 1)


def staged(data: Data, specs: list[TableSpec]) -> dict[str, DataFrame]:
    return {s.table: conform.to_staging(data[f"fx_{s.table}_stg"], s) for s in specs}


@query("meta_group_delta", " union all ".join(
    f"select '{s.table}' as table_nm, dlt_operation_nm, count(*) as row_count from ({delta_sql(s, f'fx_{s.table}_stg', f'fx_{s.table}_sds')}) d group by all"
    for s in (ORDERS, CUSTOMER, PART)
))
def meta_group_delta(data):
    specs = group_specs(data)
    stored = {s.table: conform.to_history(data[f"fx_{s.table}_sds"], s) for s in specs}
    deltas = cdc.group_delta(specs, 1, staged(data, specs), stored)
    counted = [cdc.operation_counts(d).select(F.lit(t).alias("table_nm"), "*") for t, d in deltas.items()]
    return reduce(DataFrame.unionByName, counted)


# --- Screens -----------------------------------------------------------------------------------------------------

SCREENS = [
    (1, "cheap orders", 1, 10, "PASS", "o_totalprice < 20000"), (2, "no priority", 1, 20, "REJECT", "o_orderpriority is null"),
    (3, "unknown state", 1, 30, "STOP", "o_orderstatus = 'Z'"), (4, "in debt", 2, 1, "REJECT", "c_acctbal < 0"),
    (5, "retail", 2, 2, "STOP", "c_mktsegment = 'RETAIL'"), (6, "never run", 2, 3, "PASS", "c_acctbal > 0"), (7, "never run", 3, 1, "PASS", "p_retailprice > 0"),
]


@query("meta_group_screens", """
select 1 as src_file_id, 1 as screen_id, 'PASS' as exception_action, count(*) as events from {fx_orders_stg} where o_totalprice < 20000
union all
select 1, 2, 'REJECT', count(*) from {fx_orders_stg} where o_orderpriority is null
union all
select 2, 4, 'REJECT', count(*) from {fx_customer_stg} where c_acctbal < 0
union all
select 2, 5, 'STOP', count(*) from {fx_customer_stg} where c_mktsegment = 'RETAIL'
""")
def meta_group_screens(data):
    table = data.spark.createDataFrame(
        SCREENS, "SCREEN_ID int, SCREEN_NM string, SRC_FILE_ID int, SCREEN_ORDER int, EXCEPTION_ACTION string, SCREEN_SQL string")
    specs = group_specs(data)
    frames = staged(data, specs)
    found = metadata.screen_specs(table, [s.file_id for s in specs])
    events = screens.validate_group([(s, frames[s.table]) for s in specs], found, 1, data["fx_batches"], LOAD_TIME).events
    return events.groupBy("src_file_id", "screen_id", "exception_action").agg(F.count(F.lit(1)).alias("events"))


# --- Checks ------------------------------------------------------------------------------------------------------

CHECKS = [
    ("E1", "rows", None, "EVENTS", 1.0, None, "select count(*) from meta_events"),
    ("E2", "mean value", None, "EVENTS", 0.0, 10.0, "select avg(cast(value as decimal(18,2))) from meta_events"),
    ("O1", "orders without customer", None, "ORDERS", 0.0, 0.0,
     "select count(*) from meta_orders left anti join meta_customer on o_custkey = c_custkey"),
    ("O2", "nothing found", None, "ORDERS", None, 5.0, "select o_orderkey from meta_orders where o_totalprice < 0"),
]


@query("meta_checks_run", """
select dq_check_id, cast(actual_value as double) as actual_value,
       case when actual_value between coalesce(low, actual_value) and coalesce(high, actual_value) then 1 else 0 end as dq_check_passed_flag
  from (
    select 'E1' as dq_check_id, cast(count(*) as decimal(38,2)) as actual_value, 1 as low, null as high from {events}
    union all select 'E2', cast(avg(cast(value as decimal(18,2))) as decimal(38,2)), 0, 10 from {events}
    union all select 'O1', cast(count(*) as decimal(38,2)), 0, 0 from {orders} where o_custkey not in (select c_custkey from {customer})
    union all select 'O2', cast(null as decimal(38,2)), null, 5) c
""")
def meta_checks_run(data):
    for name in ("events", "orders", "customer"):
        data[name].createOrReplaceTempView(f"meta_{name}")
    table = data.spark.createDataFrame(
        CHECKS, "dq_check_id string, dq_check_name string, dq_check_desc string, dq_check_group string, target_min_value double,"
                " target_max_value double, sql_query string")
    return checks.run(data.spark, metadata.check_specs(table), LOAD_TIME).select("dq_check_id", F.col("actual_value").cast("double").alias("actual_value"), "dq_check_passed_flag")


# --- Vault: from the catalog of the sources to loads -------------------------------------------------------------
# Two systems have a table of the same name; each hub, link and satellite has to read its own.

RULE = HashRule(order="position")
KEYS = [("CMS_ORDERS", "o_orderkey", 1), ("CMS_CUSTOMER", "c_custkey", 1), ("CMS_LINES", "l_orderkey", 1), ("CMS_LINES", "l_linenumber", 2)]
FOREIGN = [
    ("CMS_CUSTOMER", "c_custkey", "CMS_ORDERS", "o_custkey", 1, "FK_1"), ("CMS_ORDERS", "o_orderkey", "CMS_LINES", "l_orderkey", 1, "FK_2"),
]


class Model:
    """The mappings of the model, derived from the frames' own columns, and the frames by (database, schema, object)."""

    def __init__(self, data: Data):
        orders, customer, supplier, lines = (data[n] for n in ("orders", "customer", "supplier", "fx_lines"))
        self.sources = {
            ("DB", "STG_TPC", "CMS_ORDERS"): orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")),
            ("DB", "STG_TPC", "CMS_CUSTOMER"): customer.select("c_custkey", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal")),
            ("DB", "STG_SRM", "CMS_CUSTOMER"): supplier.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name")),
            ("DB", "STG_TPC", "CMS_LINES"): lines.select("l_orderkey", "l_linenumber", "price"),
        }
        spark = data.spark
        columns = model.catalog(self.sources)
        tables = columns.select("table_catalog", "table_schema", "table_name").distinct()
        pk = spark.createDataFrame([(*k, f"PK_{k[0]}") for k in KEYS], "SrcTable string, SrcColumn string, ColumnPosition int, PKConstraintName string")
        fk = spark.createDataFrame(
            FOREIGN, "ParentTable string, ParentColumn string, ChildTable string, ChildColumn string, ColumnPosition int, FKConstraintName string")
        ref = spark.createDataFrame([], "SrcSchema string, SrcObject string")
        mapping = model.hubs(tables, pk, ref)
        self.hubs = metadata.hub_specs(mapping, "RV_TPC") + metadata.hub_specs(mapping, "RV_SRM")
        own = tables.where("table_schema = 'STG_TPC'")
        self.links = metadata.link_specs(model.links(fk, own, ref, mapping.where("SrcSchema = 'STG_TPC'")), "RV_TPC")
        self.sats = metadata.sat_specs(model.sats(columns, pk, fk, ref), "RV_TPC", hubs=self.hubs)


def hashed(*columns: str) -> str:
    return "md5(" + " || ".join(f"coalesce(rtrim(cast({c} as varchar)), 'NA') || '|'" for c in columns) + ")"


AUDIT = f"timestamp_ntz '{LOAD_TIME}' as LoadDateTime, '%s' as RecordSource, cast(-1 as bigint) as LoadID"


@query("meta_hub_load", f"""
select 'RV_TPC' as SchemaName, 'HubOrders' as HubName, {hashed('o_orderkey')} as HashKey, {AUDIT % 'TPC'}, cast(o_orderkey as varchar) as BusinessKey from {{orders}}
union all
select 'RV_TPC', 'HubCustomer', {hashed('c_custkey')}, {AUDIT % 'TPC'}, cast(c_custkey as varchar) from {{customer}}
union all
select 'RV_SRM', 'HubCustomer', {hashed('s_suppkey')}, {AUDIT % 'SRM'}, cast(s_suppkey as varchar) from {{supplier}}
union all
select 'RV_TPC', 'HubLines', {hashed('l_orderkey', 'l_linenumber')}, {AUDIT % 'TPC'}, concat(cast(l_orderkey as varchar), ',', cast(l_linenumber as varchar))
  from {{fx_lines}}
""")
def meta_hub_load(data):
    found, parts = Model(data), []
    for schema in ("RV_TPC", "RV_SRM"):
        keys = {s.name: (s.hash_key, s.keys) for s in found.hubs if s.schema == schema}
        for name, rows in vault.load_hubs(found.hubs, found.sources, {}, LOAD_TIME, schema, rule=RULE).items():
            hash_key, parts_of_key = keys[name]
            parts.append(rows.select(
                F.lit(schema).alias("SchemaName"), F.lit(name).alias("HubName"), F.col(hash_key).alias("HashKey"), "LoadDateTime", "RecordSource", "LoadID",
                F.concat_ws(",", *[F.col(k).cast("string") for k in parts_of_key]).alias("BusinessKey"),
            ))
    return reduce(DataFrame.unionByName, parts)


# A link's own key comes first and its parent's after, whatever their names: the hash goes by position.
@query("meta_link_load", f"""
select 'LinkOrdersCustomer' as LinkName, {hashed('o_orderkey', 'o_custkey')} as HashKey, {AUDIT % 'TPC'},
       {hashed('o_orderkey')} as ChildHashKey, {hashed('o_custkey')} as ParentHashKey from {{orders}}
union all
select 'LinkLinesOrders', {hashed('l_orderkey', 'l_linenumber')}, {AUDIT % 'TPC'}, {hashed('l_orderkey', 'l_linenumber')}, {hashed('l_orderkey')}
  from {{fx_lines}}
""")
def meta_link_load(data):
    found, parts = Model(data), []
    for spec in found.links:
        child, parent = spec.hub_keys
        rows = vault.load_links(found.links, found.sources, {}, LOAD_TIME, spec.schema, spec.name, rule=RULE)[spec.name]
        parts.append(rows.select(F.lit(spec.name).alias("LinkName"), F.col(spec.hash_key).alias("HashKey"), "LoadDateTime", "RecordSource", "LoadID",
                                 F.col(child).alias("ChildHashKey"), F.col(parent).alias("ParentHashKey")))
    return reduce(DataFrame.unionByName, parts)


@query("meta_sat_load", f"""
select 'SatOrders' as SatName, {hashed('o_orderkey')} as HashKey, {hashed('o_orderstatus', 'cast(o_totalprice as decimal(18,2))')} as HashDiff, 'TPC' as RecordSource from {{orders}}
union all
select 'SatCustomer', {hashed('c_custkey')}, {hashed('c_mktsegment', 'cast(c_acctbal as decimal(18,2))')}, 'TPC' from {{customer}}
union all
select 'SatLines', {hashed('l_orderkey', 'l_linenumber')}, {hashed('price')}, 'TPC' from {{fx_lines}}
""")
def meta_sat_load(data):
    found = Model(data)
    keys = {s.name: s.hash_key for s in found.sats}
    loaded = vault.load_sats(found.sats, found.sources, {}, LOAD_TIME, "RV_TPC", rule=RULE, dedupe=True)
    return reduce(DataFrame.unionByName, [
        rows.select(F.lit(name).alias("SatName"), F.col(keys[name]).alias("HashKey"), "HashDiff", "RecordSource") for name, rows in loaded.items()
    ])


# --- Conforming what was loaded to its target ----------------------------------------------------------------------


@query("meta_conform_hub", f"""
select {hashed('l_orderkey', 'l_linenumber')} as LinesHashKey, {AUDIT % 'TPC'}, l_orderkey, l_linenumber from {{fx_lines}}
""")
def meta_conform_hub(data):
    found = Model(data)
    spec = next(s for s in found.hubs if s.name == "HubLines")
    rows = vault.load_hub(found.sources, None, spec, LOAD_TIME, rule=RULE)
    as_text = rows.select([F.col(c).cast("string").alias(c) for c in reversed(rows.columns)])
    return conform.conform(as_text, conform.hub_columns(spec, vault.source_frame(found.sources, "CMS_LINES")))


@query("meta_conform_link", f"""
select {hashed('o_orderkey', 'o_custkey')} as OrdersCustomerHashKey, {AUDIT % 'TPC'}, {hashed('o_orderkey')} as OrdersHashKey,
       {hashed('o_custkey')} as CustomerHashKey from {{orders}}
""")
def meta_conform_link(data):
    found = Model(data)
    spec = next(s for s in found.links if s.name == "LinkOrdersCustomer")
    rows = vault.load_link(found.sources, None, spec, LOAD_TIME, rule=RULE)
    as_text = rows.select([F.col(c).cast("string").alias(c) for c in reversed(rows.columns)])
    return conform.conform(as_text, conform.link_columns(spec))
