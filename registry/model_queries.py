"""Model derivation from catalog and key dictionaries."""

from pyspark.sql import functions as F

from registry.base import INPUTS, query
from vaultline.functions.naming import entity
from vaultline.operators import model

SCOPE = {"PRD": None, "SRM": None}


def entity_sql(column: str, *drop: str) -> str:
    for text in ("CMS_", "CMMS_", *drop):
        column = f"replace({column}, '{text}', '')"
    return (
        f"array_to_string(list_transform(string_split(lower(replace({column}, '_', ' ')), ' '),"
        " lambda w: concat(upper(left(w, 1)), substr(w, 2))), '')"
    )


HUBS = f"""
select t.table_catalog as SrcDatabase, t.table_schema as SrcSchema, t.table_name as SrcObject,
       coalesce(p.SrcColumn, 'UNDEFINED') as SrcBusinessKey, concat('RV_', substring(t.table_schema, 5)) as HubSchema,
       concat('Hub', {entity_sql('t.table_name')}) as HubName, coalesce(p.SrcColumn, 'UNDEFINED') as HubBusinessKey,
       coalesce(p.ColumnPosition, -1) as ColumnPosition, substring(t.table_schema, 5) as RecordSource
  from {{fx_tables}} t left join {{fx_pk}} p on p.SrcTable = t.table_name
 where t.table_schema like 'STG%'
   and not exists (select 1 from {{fx_ref}} r where r.SrcSchema = t.table_schema and r.SrcObject = t.table_name)
"""


@query("model_hubs", HUBS)
def model_hubs(data):
    return model.hubs(data["fx_tables"], data["fx_pk"], data["fx_ref"])


# Each table as a list of its columns, without those that a link takes over, then numbered by their place in the list.
@query("model_sats", f"""
with taken as (
  select ChildTable, list(ChildColumn) as cols from (
    select ChildTable, ChildColumn, bool_and(ParentTable not in (select SrcObject from {{fx_ref}})) as linked from {{fx_fk}} group by all)
  where linked group by ChildTable),
keyed as (select SrcTable, list(SrcColumn) as cols from {{fx_pk}} group by SrcTable),
staged as (
  select table_catalog as db, table_schema as sch, table_name as obj, {entity_sql('table_name')} as entity,
         list(column_name order by ordinal_position) as cols
    from {{fx_columns}} where starts_with(table_schema, 'STG') and (table_schema, table_name) not in (select (SrcSchema, SrcObject) from {{fx_ref}})
   group by all),
kept as (
  select s.*, coalesce(k.cols, []) as keys, list_filter(s.cols, lambda c: not list_contains(coalesce(t.cols, []), c)) as own
    from staged s left join taken t on t.ChildTable = s.obj left join keyed k on k.SrcTable = s.obj),
numbered as (select *, unnest(own) as col, generate_subscripts(own, 1) as place from kept)
select db as SrcDatabase, sch as SrcSchema, obj as SrcObject, col as SrcColumn, 'RV_' || sch[5:] as SatSchema, 'Sat' || entity as SatName,
       if(list_contains(keys, col), entity || 'HashKey', col) as SatColumn, place::integer as ColumnPosition,
       list_contains(keys, col)::integer as IsColumnBusinessKey, (not list_contains(keys, col))::integer as IsColumnPartOfHashDiffKey,
       sch[5:] as RecordSource
  from numbered
""")
def model_sats(data):
    return model.sats(data["fx_columns"], data["fx_pk"], data["fx_fk"], data["fx_ref"])


# The hub mapping as stored before links are derived.
INPUTS["fx_hub_keys"] = """
select t.table_name as SrcObject, coalesce(p.SrcColumn, 'UNDEFINED') as SrcBusinessKey,
       coalesce(p.ColumnPosition, -1) as ColumnPosition
  from {fx_tables} t left join {fx_pk} p on p.SrcTable = t.table_name
 where t.table_schema like 'STG%' and t.table_name not in (select SrcObject from {fx_ref})
"""


def links_sql(where: str) -> str:
    """A link as two lists, the child's keys and the roles of its parent, put together, sorted and numbered."""
    return f"""
with hub_lists as (
  select SrcObject, list(struct_pack(pos := ColumnPosition, col := SrcBusinessKey)) as keys from {{fx_hub_keys}} group by SrcObject),
role_lists as (
  select ChildTable, ParentTable, min(FKConstraintName) as main,
         list(struct_pack(fk := FKConstraintName, pos := ColumnPosition, col := ChildColumn, own := {entity_sql('ChildColumn', 'ID')})) as roles
    from {{fx_fk}} f where ParentTable not in (select SrcObject from {{fx_ref}}) and {where} group by ChildTable, ParentTable),
named as (
  select r.*, h.keys, {entity_sql('r.ChildTable')} as child, {entity_sql('r.ParentTable')} as parent
    from role_lists r join hub_lists h on h.SrcObject = r.ChildTable),
parts as (
  select n.ChildTable, 'Link' || child || parent as link, list_concat(
    list_transform(keys, lambda k: struct_pack(pos := k.pos, hk := child || 'HashKey', col := k.col, hub := 'Hub' || child)),
    list_transform(list_transform(roles, lambda x: struct_pack(x := x, name := if(x.fk = main, parent, x.own))),
      lambda y: struct_pack(pos := 100 + y.x.pos, hk := if(y.name = child, 'Parent', '') || y.name || 'HashKey', col := y.x.col, hub := 'Hub' || parent))
  ) as entries, t.table_catalog as db, t.table_schema as sch
    from named n left join {{fx_tables}} t on t.table_name = n.ParentTable and starts_with(t.table_schema, 'STG')),
whole as (
  select link, list_sort(flatten(list(list_transform(entries, lambda e: struct_pack(pos := e.pos, hk := e.hk, col := e.col, hub := e.hub, obj := ChildTable, db := db, sch := sch))))) as entries
    from parts group by link),
placed as (select link, unnest(entries) as e, generate_subscripts(entries, 1) as place from whole)
select e.db as SrcDatabase, e.sch as SrcSchema, e.obj as SrcObject, e.col as SrcBusinessKey, 'RV_' || e.sch[5:] as LinkSchema, link as LinkName,
       e.hk as LinkHubHashKeyName, place::integer as LinkHubHashKeyColumnPosition, e.hub as HubName, e.sch[5:] as RecordSource
  from placed
"""


def links(data, fk):
    return model.links(fk, data["fx_tables"], data["fx_ref"], model_hubs(data))


@query("model_links", links_sql("true"))
def model_links(data):
    return links(data, data["fx_fk"])


@query("model_self_link", links_sql("f.ParentTable = f.ChildTable"))
def model_self_link(data):
    return links(data, data["fx_fk"].where("ParentTable = ChildTable"))


@query("model_names", f"select table_name, {entity_sql('table_name')} as entity_name from {{fx_tables}}")
def model_names(data):
    return data["fx_tables"].select("table_name", entity(F.col("table_name")).alias("entity_name"))


@query("dict_fk", """
with lists as (
  select owner, constraint_name as name, any_value(table_name) as tbl, map_from_entries(list((position, column_name))) as cols
    from {fx_cons_columns} group by owner, constraint_name),
foreign_keys as (
  select r.constraint_name as name, child.tbl as child, child.cols as child_cols, parent.tbl as parent, parent.cols as parent_cols
    from (select * from {fx_constraints} where constraint_type = 'R') r
    join lists child on (child.owner, child.name) = (r.owner, r.constraint_name)
    join (select * from lists where owner in ('PRD', 'SRM')) parent on (parent.owner, parent.name) = (r.r_owner, r.r_constraint_name)),
places as (select *, unnest(map_keys(child_cols)) as place from foreign_keys)
select parent as ParentTable, parent_cols[place] as ParentColumn, child as ChildTable, child_cols[place] as ChildColumn,
       place as ColumnPosition, name as FKConstraintName
  from places where map_contains(parent_cols, place)
""")
def dict_fk(data):
    return model.fk_dictionary(data["fx_constraints"], data["fx_cons_columns"], SCOPE)


@query("dict_pk", """
select b.table_name as SrcTable, b.column_name as SrcColumn, b.position as ColumnPosition, a.constraint_name as PKConstraintName
  from {fx_constraints} a join {fx_cons_columns} b on b.owner = a.owner and b.constraint_name = a.constraint_name
 where a.constraint_type = 'P' and b.owner in ('PRD', 'SRM')
""")
def dict_pk(data):
    return model.pk_dictionary(data["fx_constraints"], data["fx_cons_columns"], SCOPE)
