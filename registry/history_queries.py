"""Stored histories: several batches loaded one after the other into a new folder, then read back."""

import uuid

from pyspark.sql import DataFrame

from registry.base import INPUTS, Data, query
from registry.cdc_queries import ORDERS, close_sql, delta_sql, open_sql, shown, shown_sql
from vaultline.plans import history_jobs
from vaultline.plans.materialize import ensure_checkpoint_dir
from vaultline.specs import ColumnSpec, TableSpec

DAYS = ("2001-08-01 00:00:00", "2001-09-01 00:00:00", "2001-10-01 00:00:00")
MOMENT = "2001-09-15 12:00:00"
PRICES = TableSpec("prices", (ColumnSpec("o_orderkey", "bigint", is_key=True), ColumnSpec("o_totalprice", "decimal(18,2)")), 7)

# Three snapshots of one table. The last differs from the second in few rows.
INPUTS["fx_batch_1"] = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from {fx_orders_sds} where curr_ind = 'Y'"
INPUTS["fx_batch_2"] = "select * from {fx_orders_stg} where o_orderkey is not null"
INPUTS["fx_batch_3"] = """
select o_orderkey, o_custkey, o_orderstatus,
       cast(case when o_orderpriority = '2-HIGH' and o_orderstatus = 'P' then o_totalprice + 5 else o_totalprice end as decimal(18,2)) as o_totalprice,
       o_orderpriority
  from {fx_batch_2} where not (o_orderpriority = '1-URGENT' and o_orderstatus = 'P')
"""

INPUTS["fx_stored_1"] = f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, timestamp_ntz '{DAYS[0]}' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {{fx_batch_1}}
"""


def applied_sql(stg: str, sds: str, day: str, before: str) -> str:
    changes = delta_sql(ORDERS, stg, sds)
    text = f"{close_sql(ORDERS, sds, changes)} union all {open_sql(ORDERS, changes)}"
    return text.replace("2001-09-30 23:59:59", "{before}").replace("2001-10-01 00:00:00", day).replace("{before}", before)


INPUTS["fx_stored_2"] = applied_sql("fx_batch_2", "fx_stored_1", DAYS[1], "2001-08-31 23:59:59")
INPUTS["fx_stored_3"] = applied_sql("fx_batch_3", "fx_stored_2", DAYS[2], "2001-09-30 23:59:59")

# Prices as text, one row an order. Some cannot be read, and some of these orders come a second time with a price that can.
INPUTS["fx_prices_text"] = """
select cast(o_orderkey as varchar(40)) as o_orderkey,
       case when o_orderpriority = '5-LOW' then 'free' else cast(cast(o_totalprice as decimal(18,2)) as varchar(40)) end as o_totalprice
  from {orders}
union all
select cast(o_orderkey as varchar(40)), cast(cast(o_totalprice as decimal(18,2)) as varchar(40))
  from {orders} where o_orderpriority = '5-LOW' and o_orderstatus = 'F'
union all
select 'order ' || cast(o_orderkey as varchar(40)), '1.00' from {orders} where o_orderstatus = 'P' and o_orderpriority = '1-URGENT'
"""
INPUTS["fx_prices_before"] = "select o_orderkey, cast(o_totalprice + 1 as decimal(18,2)) as o_totalprice from {orders} where o_orderstatus <> 'O'"


def new_folder(data: Data) -> str:
    ensure_checkpoint_dir(data.spark)
    return f"{data.spark.sparkContext.getCheckpointDir()}/history-{uuid.uuid4().hex}"


def loaded(data: Data) -> str:
    """The folder of a history of three batches: a whole one, one with many changes, one with few."""
    root, spark = new_folder(data), data.spark
    for i, day in enumerate(DAYS, 1):
        history_jobs.advance_file(data[f"fx_batch_{i}"], ORDERS, root, i, i - 1 or None, day)
    return root


@query("history_load", shown_sql(ORDERS, "select * from {fx_stored_3}", versions=True))
def history_load(data) -> DataFrame:
    return shown(history_jobs.read_history(data.spark, ORDERS, loaded(data), 3))


@query("history_as_of", shown_sql(ORDERS, f"""
select * from {{fx_stored_3}} where start_dt <= timestamp_ntz '{MOMENT}' and timestamp_ntz '{MOMENT}' <= end_dt
""", versions=True))
def history_as_of(data) -> DataFrame:
    return shown(history_jobs.read_as_of(data.spark, ORDERS, loaded(data), 3, MOMENT))


def priced(data: Data) -> str:
    root = new_folder(data)
    history_jobs.advance_file(data["fx_prices_before"], PRICES, root, 1, None, DAYS[0])
    history_jobs.advance_file(data["fx_prices_text"], PRICES, root, 2, 1, DAYS[1], on_bad="quarantine")
    return root


@query("history_quarantine", f"""
select o_orderkey, o_totalprice,
       case when try_cast(o_orderkey as bigint) is null then 'o_orderkey: unreadable'
            when try_cast(o_totalprice as decimal(18,2)) is null then 'o_totalprice: unreadable' else '{history_jobs.HELD_BACK}' end as reason
  from {{fx_prices_text}}
 where try_cast(o_orderkey as bigint) is null
    or o_orderkey in (select o_orderkey from {{fx_prices_text}} where try_cast(o_totalprice as decimal(18,2)) is null)
""")
def history_quarantine(data) -> DataFrame:
    apart = history_jobs.read_quarantine(data.spark, PRICES, priced(data), 2)
    return apart.selectExpr("o_orderkey", "o_totalprice", "load_reasons[0] as reason")


# Keys that could not be read may be any, so absence removes nothing; held keys keep their stored rows.
@query("history_after_quarantine", f"""
with good as (
  select cast(o_orderkey as bigint) as o_orderkey, cast(o_totalprice as decimal(18,2)) as o_totalprice from {{fx_prices_text}}
   where try_cast(o_orderkey as bigint) is not null
     and o_orderkey not in (select o_orderkey from {{fx_prices_text}} where try_cast(o_totalprice as decimal(18,2)) is null))
select b.o_orderkey, cast(b.o_totalprice as double) as o_totalprice, case when g.o_orderkey is null then 'Y' else 'N' end as curr_ind
  from {{fx_prices_before}} b left join good g on g.o_orderkey = b.o_orderkey and g.o_totalprice <> b.o_totalprice
union all
select g.o_orderkey, cast(g.o_totalprice as double), 'Y' from good g left join {{fx_prices_before}} b on b.o_orderkey = g.o_orderkey
 where b.o_orderkey is null or g.o_totalprice <> b.o_totalprice
""")
def history_after_quarantine(data) -> DataFrame:
    return shown(history_jobs.read_history(data.spark, PRICES, priced(data), 2)).select("o_orderkey", "o_totalprice", "curr_ind")
