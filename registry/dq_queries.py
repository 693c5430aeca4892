"""Row-level screens and scalar checks."""

from pyspark.sql import functions as F

from registry.base import AS_OF, LOAD_TIME, Data, query
from registry.cdc_queries import CUSTOMER, ORDERS, PART, shown, with_doubles
from vaultline.operators import checks, report, screens
from vaultline.plans.materialize import store_addressed
from vaultline.specs import CheckSpec, ScreenSpec

ORDER_SCREENS = (
    ScreenSpec(1, 1, 10, "PASS", "o_totalprice < 20000"),
    ScreenSpec(2, 1, 20, "REJECT", "o_orderpriority is null"),
    ScreenSpec(3, 1, 30, "STOP", "o_orderstatus = 'X'"),
    ScreenSpec(4, 1, 40, "PASS", "o_custkey between 10 and 40"),
)
# The same without the failing STOP, so that the last screen runs.
CALM_SCREENS = tuple(
    s if s.screen_id != 3 else ScreenSpec(3, 1, 30, "STOP", "o_orderstatus = 'Z'") for s in ORDER_SCREENS
)
GROUP_SCREENS = CALM_SCREENS + (
    ScreenSpec(5, 2, 1, "REJECT", "c_acctbal < 0"),
    ScreenSpec(6, 2, 2, "STOP", "c_mktsegment = 'RETAIL'"),
    ScreenSpec(7, 2, 3, "PASS", "c_acctbal > 0"),
    ScreenSpec(8, 3, 1, "PASS", "p_retailprice > 0"),
)

EVENT_COLUMNS = ["screen_id", "batch_id", "src_file_id", "log_dt", "exception_action", "row_id", "table_nm"]


def screen_sql(s: ScreenSpec, table: str, source: str, key: str) -> str:
    return f"""
select {s.screen_id} as screen_id, (select max(batch_id) from {{fx_batches}} where src_file_id = {s.file_id}) as batch_id,
       {s.file_id} as src_file_id, timestamp_ntz '{LOAD_TIME}' as log_dt, '{s.action}' as exception_action,
       coalesce(cast({key} as varchar), 'NA') as row_id, '{table}' as table_nm
  from {{{source}}} where {s.predicate}
"""


def events_sql(numbers) -> str:
    return " union all ".join(
        screen_sql(s, "orders", "fx_orders_stg", "o_orderkey") for s in ORDER_SCREENS if s.screen_id in numbers
    )


def validated(data: Data, chosen=ORDER_SCREENS):
    return screens.validate(data["fx_orders_stg"], chosen, ORDERS, data["fx_batches"], LOAD_TIME)


@query("dq_screen_events", events_sql([2]))
def dq_screen_events(data):
    return validated(data, [ORDER_SCREENS[1]]).events.select(*EVENT_COLUMNS)


@query("dq_latest_batch", "select src_file_id, max(batch_id) as batch_id from {fx_batches} group by src_file_id")
def dq_latest_batch(data):
    return screens.latest_batch(data["fx_batches"])


@query("dq_screen_stop", "select 1 as src_file_id, 3 as screen_id, count(*) as failures from {fx_orders_stg} where o_orderstatus = 'X'")
def dq_screen_stop(data):
    return validated(data).stop


@query("dq_validate_file", events_sql([1, 2, 3]))
def dq_validate_file(data):
    return validated(data).events.select(*EVENT_COLUMNS)


@query("dq_validate_file_calm", events_sql([1, 2, 4]))
def dq_validate_file_calm(data):
    return validated(data, CALM_SCREENS).events.select(*EVENT_COLUMNS)


# A query screen names failing rows itself: orders of customers whose balance is negative.
@query("dq_screen_query", """
select 9 as screen_id, (select max(batch_id) from {fx_batches} where src_file_id = 1) as batch_id, 1 as src_file_id,
       timestamp_ntz '2024-02-01 00:00:00' as log_dt, 'REJECT' as exception_action,
       coalesce(cast(o_orderkey as varchar), 'NA') as row_id, 'orders' as table_nm
  from {fx_orders_stg} where o_custkey in (select c_custkey from {customer} where c_acctbal < 0)
""")
def dq_screen_query(data):
    def poor_customers():
        poor = data["customer"].where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
        rows = data["fx_orders_stg"].join(poor, "o_custkey", "left_semi")
        return rows.select(screens.row_id(ORDERS.keys).alias("row_id"))

    return validated(data, [ScreenSpec(9, 1, 50, "REJECT", query=poor_customers)]).events.select(*EVENT_COLUMNS)


@query("dq_validate_group", events_sql([1, 2, 4]) + "".join(
    " union all " + screen_sql(s, "customer", "fx_customer_stg", "c_custkey") for s in GROUP_SCREENS[4:6]
))
def dq_validate_group(data):
    files = [(s, data[f"fx_{s.table}_stg"]) for s in (ORDERS, CUSTOMER, PART)]
    return screens.validate_group(files, GROUP_SCREENS, 1, data["fx_batches"], LOAD_TIME).events.select(*EVENT_COLUMNS)


REJECTED = """
select cast(o_orderkey as double) as o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as double) as o_totalprice, o_orderpriority
  from {fx_orders_stg} where o_orderpriority is not null
"""


@query("dq_reject_filter", REJECTED)
def dq_reject_filter(data):
    return with_doubles(shown(screens.accepted(data["fx_orders_stg"], ORDER_SCREENS, ORDERS)), "o_orderkey")


# By the event log: rows are known by their address, so rows without a key, or with a repeated one, stay apart.
@query("dq_reject_by_events", REJECTED)
def dq_reject_by_events(data):
    stored = store_addressed(data["fx_orders_stg"])
    events = screens.validate(stored, ORDER_SCREENS, ORDERS, data["fx_batches"], LOAD_TIME).events
    return with_doubles(shown(screens.without_rejected(stored, events, ORDERS).drop(screens.ROW_ADDRESS)), "o_orderkey")


@query("dq_event_summary", f"select screen_id, exception_action, count(*) as event_count from ({events_sql([1, 2, 3])}) e group by screen_id, exception_action")
def dq_event_summary(data):
    return screens.event_summary(validated(data).events)


# --- Checks ------------------------------------------------------------------------------------------

DAY_VARIANCE = """
select max(cast((y.n - t.n) * 100 as bigint) // nullif(y.n, 0)) as variance
  from (select event_type, count(event_id) as n from {events}
         where cast(ts as date) = date '2024-01-29' group by event_type) y
  join (select event_type, count(event_id) as n from {events}
         where cast(ts as date) = date '2024-01-30' group by event_type) t on y.event_type = t.event_type
"""
VOLUME = """
select cast(cast(100.0 * abs(min(a.n) - max(b.prev)) as double) / max(b.prev) as decimal(38,2)) as variance
  from (select count(*) as n from {fx_raw} group by cast(ts as date)) a,
       (select cast(sum(n) as bigint) // count(n) as prev
          from (select count(*) as n from {fx_wrk}
                 where ts between timestamp_ntz '2024-01-23 00:00:00' and timestamp_ntz '2024-01-30 00:00:00'
                 group by cast(ts as date)) d) b
"""
RECON = """
select abs((select count(*) from {fx_raw}%s) - (select count(*) from {fx_wrk} where cast(ts as date) = date '2024-01-30'))
         as row_difference
"""
DUPLICATES = """
select count(*) as duplicate_groups
  from (select l_orderkey, l_linenumber from {lineitem} group by l_orderkey, l_linenumber having count(*) > 1) g
"""


def day_variance(data):
    return checks.day_variance(data["events"], "event_id", "ts", ["event_type"], AS_OF)


def volume_variance(data):
    return checks.volume_variance(data["fx_raw"], F.to_date("ts"), data["fx_wrk"], "ts", AS_OF)


query("dq_day_variance", DAY_VARIANCE)(day_variance)


# Groups of two columns, either of which may be missing; such groups take no part.
@query("dq_day_variance_null_groups", """
select max(cast((y.n - t.n) * 100 as bigint) // nullif(y.n, 0)) as variance
  from (select team, size, count(event_id) as n from {fx_teams} where cast(ts as date) = date '2024-01-29' group by team, size) y
  join (select team, size, count(event_id) as n from {fx_teams} where cast(ts as date) = date '2024-01-30' group by team, size) t
    on y.team = t.team and y.size = t.size
""")
def dq_day_variance_null_groups(data):
    return checks.day_variance(data["fx_teams"], "event_id", "ts", ["team", "size"], AS_OF)


@query("dq_day_variance_absolute", DAY_VARIANCE.replace("max(cast(", "max(abs(cast(").replace("nullif(y.n, 0))", "nullif(y.n, 0)))"))
def dq_day_variance_absolute(data):
    return checks.day_variance(data["events"], "event_id", "ts", ["event_type"], AS_OF, absolute=True)


@query("dq_null_count", "select count(*) as null_count from {fx_nulls} where cast(ts as date) = date '2024-01-30' and props is null")
def dq_null_count(data):
    return checks.null_count(data["fx_nulls"], "props", "ts", AS_OF)


@query("dq_null_count_ref", "select count(props) as null_count from {fx_nulls} where cast(ts as date) = date '2024-01-30' and props is null")
def dq_null_count_ref(data):
    return checks.null_count_of_column(data["fx_nulls"], "props", "ts", AS_OF)


@query("dq_volume_variance", f"select cast(variance as double) as variance from ({VOLUME}) v")
def dq_volume_variance(data):
    return shown(volume_variance(data))


@query("dq_duplicate_groups", DUPLICATES)
def dq_duplicate_groups(data):
    return checks.duplicate_groups(data["lineitem"], ["l_orderkey", "l_linenumber"])


@query("dq_row_recon", RECON % "")
def dq_row_recon(data):
    return checks.row_recon(data["fx_raw"], data["fx_wrk"], "ts", AS_OF)


@query("dq_row_recon_filtered", RECON % " where event_type = 'purchase'")
def dq_row_recon_filtered(data):
    return checks.row_recon(data["fx_raw"], data["fx_wrk"], "ts", AS_OF, "event_type = 'purchase'")


@query("probe_min_group_count", "select min(n) as min_count from (select count(*) as n from {events} group by user_id, event_type) g")
def probe_min_group_count(data):
    return checks.min_group_count(data["events"], F.struct("user_id", "event_type"))


@query("probe_avg_daily_count", "select cast(sum(n) as bigint) // count(n) as avg_count from (select count(*) as n from {fx_wrk} group by cast(ts as date)) d")
def probe_avg_daily_count(data):
    return checks.avg_daily_count(data["fx_wrk"], "ts")


@query("scan_orders", "select * from {orders}")
def scan_orders(data):
    return data["orders"]


CHECKS = (
    ("DQ01", day_variance, DAY_VARIANCE, 0, 10),
    ("DQ02", dq_null_count, "select count(*) from {fx_nulls} where cast(ts as date) = date '2024-01-30' and props is null", 0, 0),
    ("DQ07", volume_variance, VOLUME, 0, 5),
    ("DQ09", dq_duplicate_groups, DUPLICATES, 0, 0),
    ("DQ11", dq_row_recon, RECON % "", 0, 1000),
    ("DQ12", dq_row_recon_filtered, RECON % " where event_type = 'purchase'", None, 10000),
    ("NONE", lambda data: data["events"].where("event_type = 'unknown'").select("value"), "select null", None, None),
)


def run_checks(data: Data):
    specs = [CheckSpec(i, lambda spark, f=f: f(data), lo, hi) for i, f, _, lo, hi in CHECKS]
    return checks.run(data.spark, specs, LOAD_TIME)


def _value(text: str) -> str:
    return f"cast(({text}) as decimal(38,2))"


@query("dq_checks_run", "select dq_check_id, log_date, cast(v as double) as actual_value, case when v between coalesce(lo, v) and coalesce(hi, v) then 1 else 0 end as dq_check_passed_flag from (" + " union all ".join(
    f"select '{i}' as dq_check_id, timestamp_ntz '{LOAD_TIME}' as log_date, {_value(sql)} as v,"
    f" cast({'null' if lo is None else lo} as decimal(38,2)) as lo, cast({'null' if hi is None else hi} as decimal(38,2)) as hi"
    for i, _, sql, lo, hi in CHECKS
) + ") c")
def dq_checks_run(data):
    return shown(run_checks(data))


# Order prices against targets that are open below for urgent and open above for low priority.
@query("dq_check_flag", """
select o_orderkey, case when v between coalesce(lo, v) and coalesce(hi, v) then 1 else 0 end as passed
  from (select o_orderkey, case when o_totalprice < 5000 then null else cast(o_totalprice as decimal(38,2)) end as v,
               case when o_orderpriority = '1-URGENT' then null else cast(100000 as decimal(38,2)) end as lo,
               case when o_orderpriority = '5-LOW' then null else cast(400000 as decimal(38,2)) end as hi
          from {orders}) o
""")
def dq_check_flag(data):
    number = "decimal(38,2)"
    value = F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice").cast(number))
    low = F.when(F.col("o_orderpriority") != "1-URGENT", F.lit(100000).cast(number))
    high = F.when(F.col("o_orderpriority") != "5-LOW", F.lit(400000).cast(number))
    return data["orders"].select("o_orderkey", checks.flag(value, low, high).alias("passed"))


LOG_SQL = """
select c.dq_check_id, c.dq_check_name, l.log_date,
       case when l.actual_value between coalesce(c.target_min_value, l.actual_value)
                                    and coalesce(c.target_max_value, l.actual_value) then 'SUCCESSFUL' else 'FAILED' end as status,
       cast(l.actual_value as double) as actual_value, cast(c.target_min_value as double) as target_min_value,
       cast(c.target_max_value as double) as target_max_value, c.dq_check_group, c.sql_query
  from {fx_log_values} l left join {fx_checks} c on l.dq_check_id = c.dq_check_id
"""


# Values whose check is gone are logged with open targets.
def check_log(data: Data):
    targets = data["fx_checks"].select("dq_check_id", "target_min_value", "target_max_value")
    passed = checks.flag(F.col("actual_value"), F.col("target_min_value"), F.col("target_max_value"))
    return data["fx_log_values"].join(targets, "dq_check_id", "left").select(
        "dq_check_id", "log_date", "actual_value", passed.alias("dq_check_passed_flag")
    )


@query("dq_log_report", LOG_SQL)
def dq_log_report(data):
    return shown(report.log_report(check_log(data), data["fx_checks"]))


@query("dq_log_failed_on", f"select * from ({LOG_SQL}) r where status <> 'SUCCESSFUL' and cast(log_date as date) = date '2024-01-30'")
def dq_log_failed_on(data):
    return shown(report.failed_on(check_log(data), data["fx_checks"], AS_OF))
