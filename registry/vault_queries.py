"""Hub, link, satellite and reference loads, and their integrity."""


from pyspark.sql import functions as F

from registry.base import LOAD_TIME, query
from registry.cdc_queries import shown
from vaultline.functions.hashing import md5_key
from vaultline.operators import conform, integrity, vault
from vaultline.specs import ColumnSpec, HubSource, HubSpec, LinkSource, LinkSpec, SatSpec

RV, BV = "RV_TPC", "BV"


def hub(name: str, table: str, keys: dict[str, str], source: str = "TPC") -> HubSpec:
    return HubSpec(name, (HubSource(table, keys, source),), RV)


CUSTOMER_HUB = hub("HubCustomer", "customer", {"c_custkey": "c_custkey"})
PART_HUB = hub("HubPart", "part", {"p_partkey": "p_partkey"})
SUPPLIER_HUB = hub("HubSupplier", "supplier", {"s_suppkey": "s_suppkey"}, "SRM")
HUBS = (CUSTOMER_HUB, PART_HUB, SUPPLIER_HUB)
SUPPLY_HUB = hub("HubSupply", "lineitem", {"SupplierId": "l_suppkey", "PartId": "l_partkey"})
NAME_HUB = HubSpec("HubName", (
    HubSource("customer", {"Name": "c_name"}, "TPC"), HubSource("crm", {"Name": "code"}, "CRM"),
), RV)
ORDER_LINK = LinkSpec("LinkOrderCustomer", (
    LinkSource("orders", {"OrderHashKey": ["o_orderkey"], "CustomerHashKey": ["o_custkey"]}, "TPC"),
), RV)
LINE_LINK = LinkSpec("LinkOrderPartSupplier", (
    LinkSource("lineitem", {"OrderHashKey": ["l_orderkey"], "PartHashKey": ["l_partkey"], "SupplierHashKey": ["l_suppkey"]}, "TPC"),
), RV)
TWO_SOURCE_LINK = LinkSpec("LinkPartSupplier", (
    LinkSource("supply", {"PartHashKey": ["l_partkey"], "SupplierHashKey": ["l_suppkey"]}, "TPC"),
    LinkSource("offers", {"PartHashKey": ["part"], "SupplierHashKey": ["supplier"]}, "SRM"),
), RV)
RAW_SAT = SatSpec("SatCustomer", ("c_acctbal", "c_mktsegment"), keys=("c_custkey",), schema=RV, record_source="TPC")
BUSINESS_SAT = SatSpec("SatCustomer", ("c_acctbal", "c_mktsegment"), schema=BV)

AUDIT = f"timestamp_ntz '{LOAD_TIME}' as LoadDateTime, '%s' as RecordSource, cast(-1 as bigint) as LoadID"


def text(column: str) -> str:
    return f"coalesce(rtrim(cast({column} as varchar)), 'NA')"


def md5(*columns: str) -> str:
    return f"md5(concat({', '.join(part for c in columns for part in (text(c), chr(39) + '|' + chr(39)))}))"


@query("vault_hash_key", f"""
select 'customer' as src, c_custkey as id, {md5('c_acctbal', 'c_custkey', 'c_mktsegment')} as key_hash
  from (select c_custkey, cast(c_acctbal as decimal(18,2)) as c_acctbal, c_mktsegment from {{customer}}) c
union all
select 'documents', doc_id, md5(concat({text('lang')}, '|', {text('text')}, '|'))
  from {{documents}}
""")
def vault_hash_key(data):
    customer = data["customer"].withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return customer.select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("id"),
        md5_key(["c_custkey", "c_acctbal", "c_mktsegment"]).alias("key_hash"),
    ).unionByName(data["documents"].select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
        md5_key(["text", "lang"]).alias("key_hash"),
    ))


HUB_INITIAL = f"select distinct {md5('c_custkey')} as CustomerHashKey, {AUDIT % 'TPC'}, c_custkey from {{customer}} where c_custkey is not null"


@query("hub_load_initial", HUB_INITIAL)
def hub_load_initial(data):
    return vault.load_hub({"customer": data["customer"]}, None, CUSTOMER_HUB, LOAD_TIME)


@query("hub_load_incremental", HUB_INITIAL + " and not exists (select 1 from {fx_hub_customer} h where h.c_custkey = customer.c_custkey)")
def hub_load_incremental(data):
    return vault.load_hub({"customer": data["customer"]}, data["fx_hub_customer"], CUSTOMER_HUB, LOAD_TIME)


# The hash follows the source column names: part before supplier.
@query("hub_load_composite", f"""
select distinct {md5('l_partkey', 'l_suppkey')} as SupplyHashKey, {AUDIT % 'TPC'}, l_suppkey as SupplierId, l_partkey as PartId
  from {{lineitem}}
""")
def hub_load_composite(data):
    return vault.load_hub({"lineitem": data["lineitem"]}, None, SUPPLY_HUB, LOAD_TIME)


@query("hub_load_two_sources", f"""
select {md5('n')} as NameHashKey, timestamp_ntz '{LOAD_TIME}' as LoadDateTime,
       case when min(pos) = 0 then 'TPC' else 'CRM' end as RecordSource, cast(-1 as bigint) as LoadID, n as Name
  from (select rtrim(c_name) as n, 0 as pos from {{customer}} union all select rtrim(code), 1 from {{fx_crm}}) u
 where n is not null group by n
""")
def hub_load_two_sources(data):
    return vault.load_hub({"customer": data["customer"], "crm": data["fx_crm"]}, None, NAME_HUB, LOAD_TIME)


LINK_INITIAL = f"""
select distinct {md5('o_custkey', 'o_orderkey')} as OrderCustomerHashKey, {AUDIT % 'TPC'},
       {md5('o_orderkey')} as OrderHashKey, {md5('o_custkey')} as CustomerHashKey
  from {{fx_link_src}} where o_custkey is not null and o_orderkey is not null
"""


@query("link_load_initial", LINK_INITIAL)
def link_load_initial(data):
    return vault.load_link({"orders": data["fx_link_src"]}, None, ORDER_LINK, LOAD_TIME)


@query("link_load_incremental", f"""
select * from ({LINK_INITIAL}) n where OrderCustomerHashKey not in (select OrderCustomerHashKey from {{fx_link_existing}})
""")
def link_load_incremental(data):
    return vault.load_link({"orders": data["fx_link_src"]}, data["fx_link_existing"], ORDER_LINK, LOAD_TIME)


@query("link_min_keys", f"""
select distinct {md5('l_orderkey', 'l_partkey', 'l_suppkey')} as OrderPartSupplierHashKey, {AUDIT % 'TPC'},
       {md5('l_orderkey')} as OrderHashKey, {md5('l_partkey')} as PartHashKey, {md5('l_suppkey')} as SupplierHashKey
  from {{fx_link3_src}}
 where case when l_orderkey is null then 0 else 1 end + case when l_partkey is null then 0 else 1 end
       + case when l_suppkey is null then 0 else 1 end >= 2
""")
def link_min_keys(data):
    return vault.load_link({"lineitem": data["fx_link3_src"]}, None, LINE_LINK, LOAD_TIME)


@query("link_load_two_sources", f"""
select h as PartSupplierHashKey, timestamp_ntz '{LOAD_TIME}' as LoadDateTime,
       case when min(pos) = 0 then 'TPC' else 'SRM' end as RecordSource, cast(-1 as bigint) as LoadID,
       p as PartHashKey, s as SupplierHashKey
  from (select {md5('l_partkey', 'l_suppkey')} as h, {md5('l_partkey')} as p, {md5('l_suppkey')} as s, 0 as pos from {{fx_supply}}
        union all
        select {md5('p_partkey', 's_suppkey')}, {md5('p_partkey')}, {md5('s_suppkey')}, 1
          from {{fx_offers}}) u
 group by h, p, s
""")
def link_load_two_sources(data):
    offers = data["fx_offers"].select(F.col("p_partkey").alias("part"), F.col("s_suppkey").alias("supplier"))
    return vault.load_link({"supply": data["lineitem"], "offers": offers}, None, TWO_SOURCE_LINK, LOAD_TIME)


def sat_sql(source: str, key: str, record_source: str, known: bool) -> str:
    latest = """
 where not exists (select 1 from (select CustomerHashKey, HashDiff,
                          row_number() over (partition by CustomerHashKey order by LoadDateTime desc) as n
                     from {fx_sat_customer}) l
                    where l.n = 1 and l.CustomerHashKey = s.CustomerHashKey and l.HashDiff = s.HashDiff)""" if known else ""
    return f"""
select CustomerHashKey, timestamp_ntz '{LOAD_TIME}' as LoadDateTime, RecordSource, HashDiff,
       timestamp_ntz '{LOAD_TIME}' as AppliedDateTime, cast(-1 as bigint) as LoadID,
       cast(c_acctbal as double) as c_acctbal, c_mktsegment
  from (select {key} as CustomerHashKey, {record_source} as RecordSource,
               {md5('c_acctbal', 'c_mktsegment')} as HashDiff, c_acctbal, c_mktsegment from {{{source}}}) s{latest}
"""


@query("sat_load_initial", sat_sql("fx_bv_sat_stg", "CustomerHashKey", "RecordSource", False))
def sat_load_initial(data):
    return shown(vault.load_sat(data["fx_bv_sat_stg"], None, BUSINESS_SAT, LOAD_TIME))


@query("sat_load_changed", sat_sql("fx_bv_sat_stg", "CustomerHashKey", "RecordSource", True))
def sat_load_changed(data):
    return shown(vault.load_sat(data["fx_bv_sat_stg"], data["fx_sat_customer"], BUSINESS_SAT, LOAD_TIME, hot_share=None))


@query("sat_load_hot_key", sat_sql("fx_bv_hot_stg", "CustomerHashKey", "RecordSource", True))
def sat_load_hot_key(data):
    return shown(vault.load_sat(data["fx_bv_hot_stg"], data["fx_sat_customer"], BUSINESS_SAT, LOAD_TIME))


@query("sat_load_raw", sat_sql("fx_sat_stg", md5("c_custkey"), "'TPC'", True))
def sat_load_raw(data):
    return shown(vault.load_sat(data["fx_sat_stg"], data["fx_sat_customer"], RAW_SAT, LOAD_TIME, hot_share=None))


@query("sat_latest", """
select CustomerHashKey, HashDiff from (
  select CustomerHashKey, HashDiff, row_number() over (partition by CustomerHashKey order by LoadDateTime desc) as n
    from {fx_sat_customer}) l where n = 1
""")
def sat_latest(data):
    return vault.latest(data["fx_sat_customer"], "CustomerHashKey")


@query("bv_hub_load", f"""
select s.CustomerHashKey, {AUDIT.replace("'%s' as RecordSource", 's.RecordSource')}, s.c_custkey, s.c_mktsegment
  from {{fx_bv_hub_stg}} s left join {{fx_hub_customer}} h on s.CustomerHashKey = h.CustomerHashKey
 where s.CustomerHashKey is not null and h.CustomerHashKey is null
""")
def bv_hub_load(data):
    return vault.load_staged(
        data["fx_bv_hub_stg"], data["fx_hub_customer"], "CustomerHashKey", ["c_custkey", "c_mktsegment"], LOAD_TIME
    )


@query("bv_link_load", f"""
select s.OrderCustomerHashKey, {AUDIT.replace("'%s' as RecordSource", 's.RecordSource')}, s.OrderHashKey, s.CustomerHashKey
  from {{fx_bv_link_stg}} s left join {{fx_link_existing}} h on s.OrderCustomerHashKey = h.OrderCustomerHashKey
 where s.OrderCustomerHashKey is not null and h.OrderCustomerHashKey is null
""")
def bv_link_load(data):
    return vault.load_staged(
        data["fx_bv_link_stg"], data["fx_link_existing"], "OrderCustomerHashKey", ["OrderHashKey", "CustomerHashKey"], LOAD_TIME
    )


@query("vault_load_selection", """
select 'one' as selection, 'HubPart' as hub, count(distinct p_partkey) as new_rows from {part}
union all select 'all', 'HubCustomer', count(distinct c_custkey) from {customer}
union all select 'all', 'HubPart', count(distinct p_partkey) from {part}
union all select 'all', 'HubSupplier', count(distinct s_suppkey) from {supplier}
""")
def vault_load_selection(data):
    sources = {t: data[t] for t in ("customer", "part", "supplier")}
    parts = []
    for selection, name in (("one", "HubPart"), ("all", "NULL")):
        for loaded, frame in vault.load_hubs(HUBS, sources, {}, LOAD_TIME, RV, name).items():
            counted = frame.agg(F.count(F.lit(1)).alias("new_rows"))
            parts.append(counted.select(F.lit(selection).alias("selection"), F.lit(loaded).alias("hub"), "new_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sat_layout(data):
    layout = conform.sat_columns(BUSINESS_SAT, data["fx_sat_stg"])
    return [c if c.name != "c_mktsegment" else ColumnSpec(c.name, c.data_type, required=True) for c in layout]


@query("vault_conform_sat", """
select CustomerHashKey, LoadDateTime, RecordSource, HashDiff, AppliedDateTime, LoadID,
       cast(try_cast(c_acctbal as decimal(18,2)) as double) as c_acctbal, c_mktsegment
  from {fx_sat_text}
""")
def vault_conform_sat(data):
    return shown(conform.conform(data["fx_sat_text"], sat_layout(data)))


@query("vault_required_nulls", " union all ".join(
    f"select '{c}' as column_nm, cast(count(*) filter ({bad}) as bigint) as bad_values,"
    f" cast(count(*) filter ({missing}) as bigint) as missing_values from {{fx_sat_text}}"
    for c, bad, missing in (
        *((n, "false", f"{n} is null") for n in ("CustomerHashKey", "LoadDateTime", "RecordSource", "HashDiff", "AppliedDateTime", "LoadID")),
        ("c_acctbal", "c_acctbal is not null and try_cast(c_acctbal as decimal(18,2)) is null", "false"),
        ("c_mktsegment", "false", "c_mktsegment is null"),
    )
))
def vault_required_nulls(data):
    return conform.quality(data["fx_sat_text"], sat_layout(data))


@query("vault_link_orphans", """
select CustomerHashKey as missing_key, count(*) as child_rows from {fx_orphans}
 where CustomerHashKey not in (select CustomerHashKey from {fx_hub_customer_all}) group by CustomerHashKey
""")
def vault_link_orphans(data):
    return integrity.orphans(data["fx_orphans"], data["fx_hub_customer_all"], "CustomerHashKey", "CustomerHashKey")


@query("vault_sat_orphans", """
select CustomerHashKey as missing_key, count(*) as child_rows from {fx_bv_sat_stg}
 where CustomerHashKey not in (select CustomerHashKey from {fx_hub_customer}) group by CustomerHashKey
""")
def vault_sat_orphans(data):
    return integrity.orphans(data["fx_bv_sat_stg"], data["fx_hub_customer"], "CustomerHashKey", "CustomerHashKey")


@query("vault_pk_violations", """
select CustomerHashKey, LoadDateTime, count(*) as row_count from {fx_sat_repeated}
 group by CustomerHashKey, LoadDateTime having count(*) > 1
""")
def vault_pk_violations(data):
    return integrity.key_violations(data["fx_sat_repeated"], ["CustomerHashKey", "LoadDateTime"])


# Part types as a reference table: of the many parts of a type, the first by its other columns.
@query("ref_load", f"""
select p_type, {AUDIT % 'TPC'}, p_brand, p_size from (
  select p_type, p_brand, p_size, row_number() over (partition by p_type order by p_brand, p_size) as n from {{part}}) r
 where n = 1
""")
def ref_load(data):
    return vault.load_reference(data["part"].select("p_type", "p_brand", "p_size"), "p_type", "TPC", LOAD_TIME)


