"""Change capture and history."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.base import FILE_DATE, Data, query
from vaultline.functions.geometry import same_shape
from vaultline.operators import cdc, conform, scd2
from vaultline.plans.materialize import cut_lineage
from vaultline.specs import GEOMETRY, ColumnSpec, TableSpec

GROUP = 1
ORDERS = TableSpec("orders", (
    ColumnSpec("o_orderkey", "bigint", is_key=True),
    ColumnSpec("o_custkey", "bigint", keep_history=False),
    ColumnSpec("o_orderstatus", "string", keep_history=False),
    ColumnSpec("o_totalprice", "decimal(18,2)"),
    ColumnSpec("o_orderpriority", "string"),
), file_id=1, group_id=GROUP)
CUSTOMER = TableSpec("customer", (
    ColumnSpec("c_custkey", "bigint", is_key=True),
    ColumnSpec("c_name", "string", keep_history=False),
    ColumnSpec("c_acctbal", "decimal(18,2)"),
    ColumnSpec("c_mktsegment", "string"),
), file_id=2, group_id=GROUP)
PART = TableSpec("part", (
    ColumnSpec("p_partkey", "bigint", is_key=True),
    ColumnSpec("p_name", "string"),
    ColumnSpec("p_brand", "string"),
    ColumnSpec("p_retailprice", "decimal(18,2)"),
), file_id=3, group_id=GROUP)
LINES = TableSpec("lines", (
    ColumnSpec("l_orderkey", "bigint", is_key=True),
    ColumnSpec("l_linenumber", "int", is_key=True),
    ColumnSpec("price", "decimal(18,2)"),
    ColumnSpec("flag", "string"),
), file_id=4)
PLACES = TableSpec("places", (
    ColumnSpec("c_custkey", "bigint", is_key=True),
    ColumnSpec("c_name", "string"),
    ColumnSpec("place", GEOMETRY),
), file_id=5)
ORDERS_TEXT = TableSpec("orders_text", (
    ColumnSpec("o_orderkey", "bigint", is_key=True, required=True),
    ColumnSpec("o_custkey", "bigint", required=True),
    ColumnSpec("o_orderstatus", "string", required=True),
    ColumnSpec("o_totalprice", "decimal(18,2)"),
    ColumnSpec("o_orderdate", "timestamp_ntz"),
), file_id=6)


def delta_sql(spec: TableSpec, stg: str, sds: str, null_safe: bool = False) -> str:
    """The comparison as one full outer join, the way a database would run it."""
    first = spec.keys[0]
    join = " and ".join(f"o.{k} = s.{k}" for k in spec.keys)
    differs = {
        c.name: (
            f"(s.{c.name} is not null and o.{c.name} is not null and s.{c.name} <> o.{c.name})"
            if c.data_type == GEOMETRY
            else f"(s.{c.name} {'is distinct from' if null_safe else '<>'} o.{c.name})"
        )
        for c in spec.tracked
    }
    cols = []
    for name in spec.names:
        cols.append(f"case when s.{first} is not null then s.{name} else o.{name} end as {name}")
        if name in differs:
            both = f"s.{first} is not null and o.{first} is not null"
            cols.append(f"case when {both} and {differs[name]} then 'Y' else 'N' end as {name}_upd_ind")
    no_null = " and ".join(f"{k} is not null" for k in spec.keys)
    return f"""
select case when o.{first} is null then 'ADD' when s.{first} is null then 'REMOVE' else 'MODIFY' end
         as dlt_operation_nm,
       {', '.join(cols)}
  from (select * from {{{stg}}} where {no_null}) s
  full outer join (select * from {{{sds}}} where curr_ind = 'Y') o on {join}
 where o.{first} is null or s.{first} is null or {' or '.join(differs.values())}
"""


def close_sql(spec: TableSpec, sds: str, changes: str) -> str:
    keys = ", ".join(spec.keys)
    hit = f"curr_ind = 'Y' and ({keys}) in (select ({keys}) from ({changes}) d where dlt_operation_nm in ('MODIFY', 'REMOVE'))"
    if len(spec.keys) == 1:
        hit = hit.replace(f"({keys}) in (select ({keys})", f"{keys} in (select {keys}")
    return f"""
select {', '.join(spec.names)}, start_dt,
       case when {hit} then timestamp_ntz '2001-09-30 23:59:59' else end_dt end as end_dt,
       case when {hit} then 'N' else curr_ind end as curr_ind
  from {{{sds}}}
"""


def open_sql(spec: TableSpec, changes: str) -> str:
    return f"""
select {', '.join(spec.names)}, timestamp_ntz '{FILE_DATE}' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from ({changes}) n where dlt_operation_nm in ('MODIFY', 'ADD')
"""


def shown(frame: DataFrame) -> DataFrame:
    """End dates as text (the far one overflows nanoseconds) and money as double, for comparison."""
    for name, kind in frame.dtypes:
        if kind.startswith("decimal"):
            frame = frame.withColumn(name, F.col(name).cast("double"))
        if name == "end_dt":
            frame = frame.withColumn(name, F.date_format(name, "yyyy-MM-dd"))
        if kind == "binary":
            frame = frame.withColumn(name, F.decode(name, "UTF-8"))
    return frame


def with_doubles(frame: DataFrame, *names: str) -> DataFrame:
    """Whole numbers that may be NULL, which the two engines hand out differently, as double."""
    return frame.withColumns({n: F.col(n).cast("double") for n in names})


def with_doubles_sql(inner: str, *names: str) -> str:
    return f"select * replace ({', '.join(f'cast({n} as double) as {n}' for n in names)}) from ({inner}) d"


def shown_sql(spec: TableSpec, inner: str, versions: bool = False, flags: bool = True) -> str:
    cols = [] if versions else ["dlt_operation_nm"]
    tracked = {c.name for c in spec.tracked}
    for c in spec.columns:
        value = c.name
        if c.data_type.startswith("decimal"):
            value = f"cast({c.name} as double) as {c.name}"
        if c.data_type == GEOMETRY:
            value = f"decode({c.name}) as {c.name}"
        cols.append(value)
        if flags and not versions and c.name in tracked:
            cols.append(f"{c.name}_upd_ind")
    if versions:
        cols += ["start_dt", "cast(cast(end_dt as date) as varchar) as end_dt", "curr_ind"]
    return f"select {', '.join(cols)} from ({inner}) shown"


ORDERS_DELTA = delta_sql(ORDERS, "fx_orders_stg", "fx_orders_sds")


def orders_delta(data: Data, **options) -> DataFrame:
    return cdc.delta(data["fx_orders_stg"], data["fx_orders_sds"], ORDERS, **options)


@query("cdc_delta", shown_sql(ORDERS, ORDERS_DELTA))
def cdc_delta(data):
    return shown(orders_delta(data))


@query("cdc_delta_nullsafe", shown_sql(ORDERS, delta_sql(ORDERS, "fx_orders_stg", "fx_orders_sds", True)))
def cdc_delta_nullsafe(data):
    return shown(orders_delta(data, null_safe=True))


@query("cdc_delta_changes_only", shown_sql(ORDERS, f"select * from ({ORDERS_DELTA}) d where dlt_operation_nm <> 'REMOVE'"))
def cdc_delta_changes_only(data):
    return shown(orders_delta(data, snapshot_type="DELTA"))


# Staged rows with a NULL first key come out blank, as additions.
@query("cdc_delta_blank_keys", with_doubles_sql(shown_sql(ORDERS, f"""
select * from ({ORDERS_DELTA}) d
union all
select 'ADD', null, null, null, null, 'N', null, 'N' from {{fx_orders_stg}} where o_orderkey is null
"""), "o_orderkey", "o_custkey"))
def cdc_delta_blank_keys(data):
    return with_doubles(shown(orders_delta(data, on_null_key="ref")), "o_orderkey", "o_custkey")


@query("cdc_null_keyed", "select o_custkey, o_orderstatus, cast(o_totalprice as double) as o_totalprice from {fx_orders_stg} where o_orderkey is null")
def cdc_null_keyed(data):
    return shown(cdc.null_keyed(data["fx_orders_stg"], ORDERS)).select("o_custkey", "o_orderstatus", "o_totalprice")


@query("cdc_delta_composite", shown_sql(LINES, delta_sql(LINES, "fx_lines_stg", "fx_lines_sds")))
def cdc_delta_composite(data):
    # The lines are grouped by their key, so each key is staged once.
    return shown(cdc.delta(data["fx_lines_stg"], data["fx_lines_sds"], LINES, hot_share=None))


# A snapshot that repeats a key for a third of its rows: each row is compared with the stored one.
@query("cdc_delta_hot_key", shown_sql(ORDERS, delta_sql(ORDERS, "fx_orders_stg_hot", "fx_orders_sds")))
def cdc_delta_hot_key(data):
    return shown(cdc.delta(data["fx_orders_stg_hot"], data["fx_orders_sds"], ORDERS))


@query("cdc_delta_geometry", shown_sql(PLACES, delta_sql(PLACES, "fx_places_stg", "fx_places_sds")))
def cdc_delta_geometry(data):
    return shown(cdc.delta(data["fx_places_stg"], data["fx_places_sds"], PLACES))


# Only a moved vertex is a change; where a ring begins and how it turns is none.
@query("cdc_delta_shapes", """
select c_custkey, c_name, 'MODIFY' as dlt_operation_nm, 'Y' as place_upd_ind, 'N' as c_name_upd_ind
  from {fx_shapes_stg} where c_custkey in (select c_custkey from {customer} where c_mktsegment = 'HOUSEHOLD')
""")
def cdc_delta_shapes(data):
    changes = cdc.delta(data["fx_shapes_stg"], data["fx_shapes_sds"], PLACES, geom_equal=same_shape)
    return changes.select("c_custkey", "c_name", "dlt_operation_nm", "place_upd_ind", "c_name_upd_ind")


@query("cdc_op_counts", f"select dlt_operation_nm, count(*) as row_count from ({ORDERS_DELTA}) d group by dlt_operation_nm")
def cdc_op_counts(data):
    return cdc.operation_counts(orders_delta(data))


@query("cdc_update_flags", f"""
select 'o_totalprice' as column_nm, count(*) as updated_rows from ({ORDERS_DELTA}) d
 where dlt_operation_nm = 'MODIFY' and o_totalprice_upd_ind = 'Y'
union all
select 'o_orderpriority', count(*) from ({ORDERS_DELTA}) d
 where dlt_operation_nm = 'MODIFY' and o_orderpriority_upd_ind = 'Y'
""")
def cdc_update_flags(data):
    return cdc.update_flag_counts(orders_delta(data), ORDERS)


FILES = {"orders": ORDERS, "customer": CUSTOMER, "part": PART}


def tagged(frames: dict[str, DataFrame], key: str) -> DataFrame:
    counts = [
        f.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_nm"), key, "row_count")
        for t, f in frames.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def group_delta(data: Data) -> dict[str, DataFrame]:
    staging = {t: data[f"fx_{t}_stg"] for t in FILES}
    history = {t: data[f"fx_{t}_sds"] for t in FILES}
    return cdc.group_delta(FILES.values(), GROUP, staging, history)


@query("cdc_group_counts", " union all ".join(
    f"select '{t}' as table_nm, dlt_operation_nm, count(*) as row_count"
    f" from ({delta_sql(s, f'fx_{t}_stg', f'fx_{t}_sds')}) d group by dlt_operation_nm"
    for t, s in FILES.items()
))
def cdc_group_counts(data):
    return tagged(group_delta(data), "dlt_operation_nm")


@query("scd2_close", shown_sql(ORDERS, close_sql(ORDERS, "fx_orders_sds", ORDERS_DELTA), versions=True))
def scd2_close(data):
    return shown(scd2.close(data["fx_orders_sds"], orders_delta(data), ORDERS, FILE_DATE))


@query("scd2_open", shown_sql(ORDERS, open_sql(ORDERS, ORDERS_DELTA), versions=True))
def scd2_open(data):
    return shown(scd2.open_versions(orders_delta(data), ORDERS, FILE_DATE))


APPLIED = close_sql(ORDERS, "fx_orders_sds", ORDERS_DELTA) + " union all " + open_sql(ORDERS, ORDERS_DELTA)


def applied(data: Data) -> DataFrame:
    return scd2.apply(data["fx_orders_sds"], cut_lineage(orders_delta(data)), ORDERS, FILE_DATE)


@query("scd2_apply", shown_sql(ORDERS, APPLIED, versions=True))
def scd2_apply(data):
    return shown(applied(data))


@query("scd2_advance", shown_sql(ORDERS, APPLIED, versions=True))
def scd2_advance(data):
    history = data["fx_orders_sds"]
    now = scd2.advance(data["fx_orders_stg"], history, ORDERS, FILE_DATE, hot_share=None)
    return shown(history.where("curr_ind <> 'Y'").unionByName(now.select(*history.columns)))


@query("scd2_advance_delta", shown_sql(ORDERS, ORDERS_DELTA))
def scd2_advance_delta(data):
    now = scd2.advance(data["fx_orders_stg"], data["fx_orders_sds"], ORDERS, FILE_DATE, hot_share=None)
    return shown(now.where("dlt_operation_nm is not null").drop("start_dt", "end_dt", "curr_ind"))


@query("scd2_group_counts", " union all ".join(
    f"select '{t}' as table_nm, curr_ind, count(*) as row_count from ("
    + close_sql(s, f"fx_{t}_sds", delta_sql(s, f"fx_{t}_stg", f"fx_{t}_sds")) + " union all "
    + open_sql(s, delta_sql(s, f"fx_{t}_stg", f"fx_{t}_sds")) + ") v group by curr_ind"
    for t, s in FILES.items()
))
def scd2_group_counts(data):
    history = {t: data[f"fx_{t}_sds"] for t in FILES}
    deltas = {t: cut_lineage(d) for t, d in group_delta(data).items()}
    return tagged(scd2.apply_group(FILES.values(), GROUP, history, deltas, FILE_DATE), "curr_ind")


@query("scd2_as_of", shown_sql(ORDERS, f"""
select * from ({APPLIED}) v
 where start_dt <= timestamp_ntz '2001-09-15 12:00:00' and timestamp_ntz '2001-09-15 12:00:00' <= end_dt
""", versions=True))
def scd2_as_of(data):
    return shown(scd2.as_of(applied(data), "2001-09-15 12:00:00"))


@query("scd2_pk_violations", """
select o_orderkey, start_dt, count(*) as version_count from {fx_orders_sds_repeated}
 group by o_orderkey, start_dt having count(*) > 1
""")
def scd2_pk_violations(data):
    return scd2.key_violations(data["fx_orders_sds_repeated"], ORDERS)


@query("conform_stg", """
select try_cast(o_orderkey as bigint) as o_orderkey, cast(try_cast(o_custkey as bigint) as double) as o_custkey, o_orderstatus,
       cast(try_cast(o_totalprice as decimal(18,2)) as double) as o_totalprice,
       try_cast(o_orderdate as timestamp) as o_orderdate
  from {fx_orders_text}
""")
def conform_stg(data):
    return with_doubles(shown(conform.to_staging(data["fx_orders_text"], ORDERS_TEXT)), "o_custkey")


@query("conform_sds", """
select try_cast(o_orderkey as bigint) as o_orderkey, cast(try_cast(o_custkey as bigint) as double) as o_custkey, o_orderstatus,
       cast(try_cast(o_totalprice as decimal(18,2)) as double) as o_totalprice,
       try_cast(o_orderdate as timestamp) as o_orderdate,
       timestamp_ntz '2001-09-01 00:00:00' as start_dt, '9999-12-31' as end_dt, 'Y' as curr_ind
  from {fx_orders_text}
""")
def conform_sds(data):
    text = data["fx_orders_text"].select(
        "*", F.lit("2001-09-01 00:00:00").alias("start_dt"), F.lit("9999-12-31 00:00:00").alias("end_dt"),
        F.lit("Y").alias("curr_ind"),
    )
    return with_doubles(shown(conform.to_history(text, ORDERS_TEXT)), "o_custkey")


@query("conform_bad_values", """
select column_nm, bad_values, missing_values from (
  select 'o_orderkey' as column_nm,
         count(*) filter (o_orderkey is not null and try_cast(o_orderkey as bigint) is null) as bad_values,
         count(*) filter (o_orderkey is null) as missing_values from {fx_orders_text}
  union all
  select 'o_custkey', count(*) filter (o_custkey is not null and try_cast(o_custkey as bigint) is null),
         count(*) filter (o_custkey is null) from {fx_orders_text}
  union all
  select 'o_orderstatus', 0, count(*) filter (o_orderstatus is null) from {fx_orders_text}
  union all
  select 'o_totalprice', count(*) filter (o_totalprice is not null and try_cast(o_totalprice as decimal(18,2)) is null), 0
    from {fx_orders_text}
  union all
  select 'o_orderdate', count(*) filter (o_orderdate is not null and try_cast(o_orderdate as timestamp) is null), 0
    from {fx_orders_text}
) c
""")
def conform_bad_values(data):
    return conform.bad_values(data["fx_orders_text"], ORDERS_TEXT)
