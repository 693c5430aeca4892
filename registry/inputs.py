"""Derived inputs. Every one covers the whole of its tables; edits follow the rows' own attributes."""

from registry.base import INPUTS

# --- Change capture: the new snapshot and the stored history of orders, customers, parts, lines. -------
# A re-keyed row leaves under its old key (removed) and arrives under a new one (added).

INPUTS["fx_orders_stg"] = """
select case when o_totalprice > 498000 then null
            when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then -1 - o_orderkey
            else o_orderkey end as o_orderkey,
       o_custkey,
       case when o_totalprice < 10000 then 'X' else o_orderstatus end as o_orderstatus,
       cast(case when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then o_totalprice + 100
                 else o_totalprice end as decimal(18,2)) as o_totalprice,
       case when o_orderpriority = '3-MEDIUM' and o_orderstatus = 'F' then null
            else o_orderpriority end as o_orderpriority
  from {orders}
"""

INPUTS["fx_orders_stg_hot"] = """
select case when o_orderstatus = 'F' then 7 else o_orderkey end as o_orderkey, o_custkey, o_orderstatus,
       cast(o_totalprice as decimal(18,2)) as o_totalprice, o_orderpriority
  from {orders}
"""

INPUTS["fx_orders_sds"] = """
select o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice as decimal(18,2)) as o_totalprice,
       case when o_orderpriority = '2-HIGH' and o_orderstatus = 'P' then null
            else o_orderpriority end as o_orderpriority,
       timestamp_ntz '2001-09-01 00:00:00' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {orders}
union all
select o_orderkey, o_custkey, 'P', cast(o_totalprice - 10 as decimal(18,2)), o_orderpriority,
       timestamp_ntz '2001-01-01 00:00:00', timestamp_ntz '2001-08-31 23:59:59', 'N'
  from {orders} where o_orderstatus = 'F'
"""

INPUTS["fx_customer_stg"] = """
select case when c_mktsegment = 'MACHINERY' and c_acctbal > 5000 then -1 - c_custkey
            else c_custkey end as c_custkey,
       c_name,
       cast(case when c_mktsegment = 'BUILDING' then c_acctbal + 1 else c_acctbal end as decimal(18,2)) as c_acctbal,
       case when c_nationkey = 3 then 'RETAIL' else c_mktsegment end as c_mktsegment
  from {customer}
"""

INPUTS["fx_customer_sds"] = """
select c_custkey, c_name, cast(c_acctbal as decimal(18,2)) as c_acctbal, c_mktsegment,
       timestamp_ntz '2001-09-01 00:00:00' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {customer}
"""

INPUTS["fx_part_stg"] = """
select case when p_size = 50 then -1 - p_partkey else p_partkey end as p_partkey, p_name, p_brand,
       cast(case when p_type = 'PROMO' then p_retailprice * 2 else p_retailprice end as decimal(18,2)) as p_retailprice
  from {part}
"""

INPUTS["fx_part_sds"] = """
select p_partkey, p_name, p_brand, cast(p_retailprice as decimal(18,2)) as p_retailprice,
       timestamp_ntz '2001-09-01 00:00:00' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {part}
"""

INPUTS["fx_lines"] = """
select l_orderkey, l_linenumber, max(cast(l_extendedprice as decimal(18,2))) as price, max(l_returnflag) as flag
  from {lineitem} group by l_orderkey, l_linenumber
"""

INPUTS["fx_lines_stg"] = """
select l_orderkey, case when price > 90000 then l_linenumber + 100 else l_linenumber end as l_linenumber,
       cast(case when flag = 'A' then price + 1 else price end as decimal(18,2)) as price,
       case when price < 2000 then null else flag end as flag
  from {fx_lines}
"""

INPUTS["fx_lines_sds"] = """
select l_orderkey, l_linenumber, price, flag, timestamp_ntz '2001-09-01 00:00:00' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {fx_lines}
"""

# Places as well-known text in bytes; some unknown on either side.
INPUTS["fx_places_stg"] = """
select c_custkey, c_name,
       case when c_mktsegment = 'FURNITURE' then null
            else cast(concat('POINT (', cast(case when c_acctbal < 0 then c_nationkey + 1 else c_nationkey end
                                             as varchar(10)), ' 0)') as binary) end as place
  from {customer}
"""

INPUTS["fx_places_sds"] = """
select c_custkey, c_name,
       case when c_mktsegment = 'HOUSEHOLD' then null
            else cast(concat('POINT (', cast(c_nationkey as varchar(10)), ' 0)') as binary) end as place,
       timestamp_ntz '2001-09-01 00:00:00' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {customer}
"""

# Places as triangles in well-known binary: from another vertex on, the other way round, or with a vertex moved. The numbers
# 0, 1 and 2 as eight bytes, the lowest first.
ZERO, ONE, TWO = "0000000000000000", "000000000000F03F", "0000000000000040"
VERTICES = {"a": ZERO + ZERO, "b": ONE + ZERO, "c": ONE + ONE, "d": TWO + ONE}


def triangle(vertices: str) -> str:
    return "0103000000" + "01000000" + "04000000" + "".join(VERTICES[v] for v in vertices)


INPUTS["fx_shapes_stg"] = f"""
select c_custkey, c_name,
       unhex(case when c_mktsegment = 'BUILDING' then '{triangle("bcab")}' when c_mktsegment = 'MACHINERY' then '{triangle("acba")}'
                  when c_mktsegment = 'HOUSEHOLD' then '{triangle("abda")}' else '{triangle("abca")}' end) as place
  from {{customer}}
"""

INPUTS["fx_shapes_sds"] = f"""
select c_custkey, c_name, unhex('{triangle("abca")}') as place, timestamp_ntz '2001-09-01 00:00:00' as start_dt,
       timestamp_ntz '9999-12-31 00:00:00' as end_dt, 'Y' as curr_ind
  from {{customer}}
"""

# A history that was applied twice for some keys, so that versions repeat.
INPUTS["fx_orders_sds_repeated"] = """
select * from {fx_orders_sds}
union all
select * from {fx_orders_sds} where o_orderpriority = '4-NOT SPECIFIED' and curr_ind = 'Y'
"""

# Orders as text, the way a file delivers them, with unreadable numbers and dates.
INPUTS["fx_orders_text"] = """
select cast(o_orderkey as varchar(40)) as o_orderkey,
       case when o_orderpriority = '1-URGENT' then 'n/a' else cast(o_custkey as varchar(40)) end as o_custkey,
       case when o_orderstatus = 'P' then null else o_orderstatus end as o_orderstatus,
       case when o_orderpriority = '5-LOW' and o_orderstatus = 'O' then 'free'
            when o_orderstatus = 'F' then null
            else cast(cast(o_totalprice as decimal(18,2)) as varchar(40)) end as o_totalprice,
       case when o_orderpriority = '2-HIGH' then 'soon'
            else cast(o_orderdate as varchar(40)) end as o_orderdate
  from {orders}
"""

# --- Quality: batches, check log and checks, read from the data. ---------------------------------------
# Customers play the part of source files, their orders the part of load batches.

INPUTS["fx_batches"] = """
select o_orderkey as batch_id, o_custkey as src_file_id, o_orderdate as load_date, o_orderstatus as status_nm
  from {orders}
"""

INPUTS["fx_checks"] = """
select event_type as dq_check_id, concat('Check of ', event_type) as dq_check_name,
       case when event_type = 'click' then null else cast(avg(cast(value as decimal(18,2))) - 40 as decimal(38,2)) end as target_min_value,
       case when event_type = 'view' then null else cast(max(cast(value as decimal(18,2))) - 250 as decimal(38,2)) end as target_max_value,
       'EVENTS' as dq_check_group, 'select value' as sql_query
  from {events} where event_type <> 'signup' group by event_type
"""

INPUTS["fx_log_values"] = """
select event_type as dq_check_id, ts as log_date,
       case when value < 1 then null else cast(value as decimal(38,2)) end as actual_value
  from {events}
"""

INPUTS["fx_nulls"] = """
select event_id, ts, user_id, event_type, value, case when value < 5 then null else props end as props
  from {events}
"""

INPUTS["fx_raw"] = "select * from {events} where ts >= timestamp_ntz '2024-01-30 00:00:00' and ts < timestamp_ntz '2024-01-31 00:00:00'"
INPUTS["fx_wrk"] = "select * from {events} where value >= 0.5"

# --- Vault: hashed tables as they stand before a load, and what is staged for it. -----------------------

INPUTS["fx_hub_customer"] = """
select md5(concat(cast(c_custkey as varchar(40)), '|')) as CustomerHashKey,
       timestamp_ntz '2024-01-01 00:00:00' as LoadDateTime, 'TPC' as RecordSource, cast(-1 as bigint) as LoadID, c_custkey
  from {customer} where c_mktsegment <> 'MACHINERY'
"""

INPUTS["fx_supply"] = "select distinct l_partkey, l_suppkey from {lineitem}"

# What a second system offers: a part by the supplier of its own number, and what was sent back, once more.
INPUTS["fx_offers"] = """
select p_partkey, s_suppkey from {part} join {supplier} on p_partkey = s_suppkey
union all
select l_partkey, l_suppkey from {lineitem} where l_returnflag = 'R'
"""

INPUTS["fx_hub_customer_all"] = """
select md5(concat(cast(c_custkey as varchar(40)), '|')) as CustomerHashKey, c_custkey from {customer}
"""

# Customers as a second system knows them: some are its own, codes are text with blanks at the end.
INPUTS["fx_crm"] = """
select case when c_nationkey < 5 then concat('CRM', cast(c_custkey as varchar(40)), '  ')
            else concat(c_name, ' ') end as code, c_mktsegment
  from {customer}
"""

INPUTS["fx_link_src"] = """
select o_orderkey, case when o_totalprice < 15000 then null else o_custkey end as o_custkey, o_orderstatus
  from {orders}
"""

INPUTS["fx_link_existing"] = """
select md5(concat(cast(o_custkey as varchar(40)), '|', cast(o_orderkey as varchar(40)), '|')) as OrderCustomerHashKey,
       md5(concat(cast(o_orderkey as varchar(40)), '|')) as OrderHashKey,
       md5(concat(cast(o_custkey as varchar(40)), '|')) as CustomerHashKey
  from {fx_link_src} where o_custkey is not null and o_orderstatus = 'F'
"""

INPUTS["fx_link3_src"] = """
select l_orderkey, case when l_returnflag = 'R' then null else l_partkey end as l_partkey,
       case when l_linestatus = 'F' then null else l_suppkey end as l_suppkey
  from {lineitem}
"""

INPUTS["fx_orphans"] = """
select md5(concat(cast(o_custkey as varchar(40)), '|', cast(o_orderkey as varchar(40)), '|')) as OrderCustomerHashKey,
       md5(concat(cast(case when o_totalprice > 490000 then o_custkey + 1000000 else o_custkey end as varchar(40)), '|'))
         as CustomerHashKey
  from {orders}
"""

INPUTS["fx_sat_customer"] = """
select md5(concat(cast(c_custkey as varchar(40)), '|')) as CustomerHashKey, timestamp_ntz '2024-01-01 00:00:00' as LoadDateTime,
       'TPC' as RecordSource,
       md5(concat(cast(cast(c_acctbal as decimal(18,2)) as varchar(40)), '|', c_mktsegment, '|')) as HashDiff,
       timestamp_ntz '2024-01-01 00:00:00' as AppliedDateTime, cast(-1 as bigint) as LoadID,
       cast(c_acctbal as decimal(18,2)) as c_acctbal, c_mktsegment
  from {customer}
union all
select md5(concat(cast(c_custkey as varchar(40)), '|')), timestamp_ntz '2023-12-01 00:00:00', 'TPC',
       md5(concat('0.00|', c_mktsegment, '|')), timestamp_ntz '2023-12-01 00:00:00', cast(-1 as bigint),
       cast(0 as decimal(18,2)), c_mktsegment
  from {customer} where c_mktsegment = 'AUTOMOBILE'
"""

INPUTS["fx_sat_stg"] = """
select case when c_nationkey = 7 then -1 - c_custkey else c_custkey end as c_custkey,
       cast(case when c_nationkey < 3 then c_acctbal + 1 else c_acctbal end as decimal(18,2)) as c_acctbal,
       case when c_nationkey = 11 then concat(c_mktsegment, '  ')
            when c_nationkey = 12 then null else c_mktsegment end as c_mktsegment
  from {customer}
"""

INPUTS["fx_bv_sat_stg"] = """
select md5(concat(cast(c_custkey as varchar(40)), '|')) as CustomerHashKey, 'BV' as RecordSource, c_acctbal, c_mktsegment
  from {fx_sat_stg}
"""

# Purchases per customer: a third of the events belong to one hot key.
INPUTS["fx_bv_hot_stg"] = """
select md5(concat(cast(case when event_type in ('view', 'click') then 0 else user_id end as varchar(40)), '|')) as CustomerHashKey,
       'BV' as RecordSource, cast(value as decimal(18,2)) as c_acctbal, event_type as c_mktsegment
  from {events}
"""

INPUTS["fx_bv_hub_stg"] = """
select case when c_nationkey = 24 then null else md5(concat(cast(c_custkey as varchar(40)), '|')) end as CustomerHashKey,
       'BV' as RecordSource, c_custkey, c_mktsegment
  from {customer}
"""

INPUTS["fx_bv_link_stg"] = """
select md5(concat(cast(o_custkey as varchar(40)), '|', cast(o_orderkey as varchar(40)), '|')) as OrderCustomerHashKey,
       'BV' as RecordSource, md5(concat(cast(o_orderkey as varchar(40)), '|')) as OrderHashKey,
       md5(concat(cast(o_custkey as varchar(40)), '|')) as CustomerHashKey
  from {orders}
"""

INPUTS["fx_sat_repeated"] = """
select * from {fx_sat_customer}
union all
select * from {fx_sat_customer} where c_mktsegment = 'BUILDING'
"""

INPUTS["fx_sat_text"] = """
select CustomerHashKey, LoadDateTime, RecordSource, HashDiff, AppliedDateTime, LoadID,
       case when c_mktsegment = 'HOUSEHOLD' then 'none' else cast(c_acctbal as varchar(40)) end as c_acctbal,
       case when c_acctbal < 0 then null else c_mktsegment end as c_mktsegment
  from {fx_sat_customer}
"""

# --- Model: a large catalog. Every part and supplier is a staging table of its own, every nation a reference
# table; each line item is a foreign key of its part's table to its supplier's, one per return flag.

INPUTS["fx_tables"] = """
select 'TPC' as table_catalog, 'STG_SRM' as table_schema, concat('CMS_SUPPLIER_', cast(s_suppkey as varchar(20))) as table_name from {supplier}
union all select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(p_partkey as varchar(20))) from {part}
union all select 'TPC', 'STG_TPC', concat('CMS_NATION_', cast(n_nationkey as varchar(20))) from {nation}
union all select 'TPC', 'RV_TPC', concat('CMS_REGION_', cast(r_regionkey as varchar(20))) from {region}
"""

INPUTS["fx_ref"] = """
select 'TPC' as SrcDatabase, 'STG_TPC' as SrcSchema, concat('CMS_NATION_', cast(n_nationkey as varchar(20))) as SrcObject from {nation}
"""

INPUTS["fx_pk"] = """
select concat('CMS_SUPPLIER_', cast(s_suppkey as varchar(20))) as SrcTable, 'SUPPLIER_ID' as SrcColumn, 1 as ColumnPosition,
       concat('PK_CMS_SUPPLIER_', cast(s_suppkey as varchar(20))) as PKConstraintName
  from {supplier} where s_acctbal >= 0
union all
select concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_ID', 1, concat('PK_CMMS_PART_', cast(p_partkey as varchar(20))) from {part}
union all
select concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_VERSION', 2, concat('PK_CMMS_PART_', cast(p_partkey as varchar(20)))
  from {part} where p_type = 'PROMO'
union all
select concat('CMS_NATION_', cast(n_nationkey as varchar(20))), 'NATION_ID', 1, concat('PK_CMS_NATION_', cast(n_nationkey as varchar(20))) from {nation}
"""

INPUTS["fx_supplies"] = "select distinct l_partkey, l_suppkey, l_returnflag from {lineitem}"

INPUTS["fx_fk"] = """
select concat('CMS_SUPPLIER_', cast(l_suppkey as varchar(20))) as ParentTable, 'SUPPLIER_ID' as ParentColumn,
       concat('CMMS_PART_', cast(l_partkey as varchar(20))) as ChildTable,
       concat('SUPPLIER_', cast(l_suppkey as varchar(20)), '_', l_returnflag, '_ID') as ChildColumn, 1 as ColumnPosition,
       concat('FK_', cast(l_partkey as varchar(20)), '_', cast(l_suppkey as varchar(20)), '_', l_returnflag) as FKConstraintName
  from {fx_supplies}
union all
select concat('CMS_NATION_', cast(s_nationkey as varchar(20))), 'NATION_ID', concat('CMS_SUPPLIER_', cast(s_suppkey as varchar(20))),
       'NATION_ID', 1, concat('FK_N_', cast(s_suppkey as varchar(20)))
  from {supplier}
union all
select concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_ID', concat('CMMS_PART_', cast(p_partkey as varchar(20))),
       'PARENT_ID', 1, concat('FK_SELF_', cast(p_partkey as varchar(20)))
  from {part} where p_size > 40
union all
select concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_VERSION', concat('CMMS_PART_', cast(p_partkey as varchar(20))),
       'PARENT_VERSION', 2, concat('FK_SELF_', cast(p_partkey as varchar(20)))
  from {part} where p_size > 40 and p_type = 'PROMO'
"""

INPUTS["fx_columns"] = """
select 'TPC' as table_catalog, 'STG_SRM' as table_schema, concat('CMS_SUPPLIER_', cast(s_suppkey as varchar(20))) as table_name, 'SUPPLIER_ID' as column_name, 1 as ordinal_position from {supplier}
union all select 'TPC', 'STG_SRM', concat('CMS_SUPPLIER_', cast(s_suppkey as varchar(20))), 'SUPPLIER_NAME', 2 from {supplier}
union all select 'TPC', 'STG_SRM', concat('CMS_SUPPLIER_', cast(s_suppkey as varchar(20))), 'NATION_ID', 3 from {supplier}
union all select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_ID', 1 from {part}
union all select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_VERSION', 2 from {part}
union all select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PARENT_ID', 3 from {part}
union all select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PARENT_VERSION', 4 from {part}
union all select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(p_partkey as varchar(20))), 'PART_NAME', 5 from {part}
union all
select 'TPC', 'STG_TPC', concat('CMMS_PART_', cast(l_partkey as varchar(20))),
       concat('SUPPLIER_', cast(l_suppkey as varchar(20)), '_', l_returnflag, '_ID'),
       cast(10 + 3 * l_suppkey + case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as int)
  from {fx_supplies}
union all
select 'TPC', 'STG_TPC', concat('CMS_NATION_', cast(n_nationkey as varchar(20))), 'NATION_ID', 1 from {nation}
"""

# The same keys as a database dictionary shows them: parts belong to PRD, suppliers to SRM, nations to LKP.
INPUTS["fx_constraints"] = """
select case when SrcTable like 'CMMS_PART%' then 'PRD' when SrcTable like 'CMS_NATION%' then 'LKP' else 'SRM' end as owner,
       PKConstraintName as constraint_name, 'P' as constraint_type,
       cast(null as varchar(20)) as r_owner, cast(null as varchar(60)) as r_constraint_name
  from {fx_pk} where ColumnPosition = 1
union all
select case when ChildTable like 'CMMS_PART%' then 'PRD' else 'SRM' end, FKConstraintName, 'R',
       case when ParentTable like 'CMMS_PART%' then 'PRD' when ParentTable like 'CMS_NATION%' then 'LKP' else 'SRM' end,
       concat('PK_', ParentTable)
  from {fx_fk} where ColumnPosition = 1
"""

INPUTS["fx_cons_columns"] = """
select case when SrcTable like 'CMMS_PART%' then 'PRD' when SrcTable like 'CMS_NATION%' then 'LKP' else 'SRM' end as owner,
       PKConstraintName as constraint_name, SrcTable as table_name, SrcColumn as column_name, ColumnPosition as position
  from {fx_pk}
union all
select case when ChildTable like 'CMMS_PART%' then 'PRD' else 'SRM' end, FKConstraintName, ChildTable, ChildColumn, ColumnPosition
  from {fx_fk}
"""

# --- Day-over-day groups of two columns. On the later day most of a group without a team is gone. ---------------
INPUTS["fx_teams"] = """
select event_id, ts, case when event_type = 'click' then null else event_type end as team,
       case when value < 50 then 'small' when value < 95 then 'large' else null end as size
  from {events} where not (event_type = 'click' and value < 90 and cast(ts as date) = date '2024-01-30')
"""
