import re

import pytest
from pyspark.sql import functions as F

from vaultline.functions.naming import entity
from vaultline.operators import model, vault
from vaultline.sources import metadata
from vaultline.specs import HubSource, HubSpec

TABLES = [("DB", "STG_CMS", t) for t in ("CMS_CONTRACT", "CMS_BROKER", "CMS_STATUS", "CMS_TRADE_LEG")] + [("DB", "RV_CMS", "CMS_OLD")]
COLUMNS = [
    ("CMS_BROKER", "CB_ID", 1), ("CMS_BROKER", "CB_NAME", 2), ("CMS_CONTRACT", "CC_ID", 1), ("CMS_CONTRACT", "CC_BROKER", 2),
    ("CMS_CONTRACT", "CC_NAME", 3), ("CMS_CONTRACT", "CC_STATUS", 4), ("CMS_CONTRACT", "CC_PARENT_ID", 5),
    ("CMS_CONTRACT", "SALES_BROKER_ID", 6), ("CMS_STATUS", "CS_ID", 1),
]
FKS = [
    ("CMS_BROKER", "CB_ID", "CMS_CONTRACT", "CC_BROKER", 1, "FK1"), ("CMS_STATUS", "CS_ID", "CMS_CONTRACT", "CC_STATUS", 1, "FK2"),
    ("CMS_CONTRACT", "CC_ID", "CMS_CONTRACT", "CC_PARENT_ID", 1, "FK3"), ("CMS_BROKER", "CB_ID", "CMS_CONTRACT", "SALES_BROKER_ID", 1, "FK4"),
]


def frames(spark):
    tables = spark.createDataFrame(TABLES, "table_catalog string, table_schema string, table_name string")
    columns = spark.createDataFrame(COLUMNS, "table_name string, column_name string, ordinal_position int").select(
        F.lit("DB").alias("table_catalog"), F.lit("STG_CMS").alias("table_schema"), "*")
    pk = spark.createDataFrame(
        [("CMS_CONTRACT", "CC_ID", 1, "P1"), ("CMS_BROKER", "CB_ID", 1, "P2")],
        "SrcTable string, SrcColumn string, ColumnPosition int, PKConstraintName string")
    fk = spark.createDataFrame(
        FKS, "ParentTable string, ParentColumn string, ChildTable string, ChildColumn string, ColumnPosition int, FKConstraintName string")
    ref = spark.createDataFrame([("STG_CMS", "CMS_STATUS")], "SrcSchema string, SrcObject string")
    return tables, columns, pk, fk, ref


def test_hubs(spark, rows):
    tables, _, pk, _, ref = frames(spark)
    assert rows(model.hubs(tables, pk, ref), "HubName", "HubBusinessKey", "ColumnPosition", "HubSchema", "RecordSource") == [
        ("HubBroker", "CB_ID", 1, "RV_CMS", "CMS"), ("HubContract", "CC_ID", 1, "RV_CMS", "CMS"),
        ("HubTradeLeg", "UNDEFINED", -1, "RV_CMS", "CMS")]


def test_sats(spark, rows):
    _, columns, pk, fk, ref = frames(spark)
    shown = ("SatName", "ColumnPosition", "SrcColumn", "SatColumn", "IsColumnBusinessKey", "IsColumnPartOfHashDiffKey")
    expected = [
        ("SatBroker", 1, "CB_ID", "BrokerHashKey", 1, 0), ("SatBroker", 2, "CB_NAME", "CB_NAME", 0, 1),
        ("SatContract", 1, "CC_ID", "ContractHashKey", 1, 0), ("SatContract", 2, "CC_NAME", "CC_NAME", 0, 1),
        ("SatContract", 3, "CC_STATUS", "CC_STATUS", 0, 1),
    ]
    assert rows(model.sats(columns, pk, fk, ref), *shown) == expected
    # A column in two foreign keys to reference tables is listed once.
    twice = fk.unionByName(fk.where("FKConstraintName = 'FK2'").withColumn("FKConstraintName", F.lit("FK9")))
    assert rows(model.sats(columns, pk, twice, ref), *shown) == expected


def test_links(spark, rows):
    tables, _, pk, fk, ref = frames(spark)
    mapping = model.links(fk, tables, ref, model.hubs(tables, pk, ref))
    shown = ("LinkName", "LinkHubHashKeyColumnPosition", "SrcBusinessKey", "LinkHubHashKeyName", "HubName")
    assert rows(mapping, *shown) == [
        ("LinkContractBroker", 1, "CC_ID", "ContractHashKey", "HubContract"),
        ("LinkContractBroker", 2, "CC_BROKER", "BrokerHashKey", "HubBroker"),
        ("LinkContractBroker", 3, "SALES_BROKER_ID", "SalesBrokerHashKey", "HubBroker"),
        ("LinkContractContract", 1, "CC_ID", "ContractHashKey", "HubContract"),
        ("LinkContractContract", 2, "CC_PARENT_ID", "ParentContractHashKey", "HubContract"),
    ]
    assert model.shared_link_names(mapping).isEmpty()


def test_composite_child_key_does_not_repeat_parents(spark, rows):
    tables, _, pk, fk, ref = frames(spark)
    second = spark.createDataFrame([("CMS_CONTRACT", "CC_VERSION", 2, "P1")], pk.schema)
    mapping = model.links(fk, tables, ref, model.hubs(tables, pk.unionByName(second), ref))
    got = rows(mapping.where("LinkName = 'LinkContractContract'"), "LinkHubHashKeyColumnPosition", "SrcBusinessKey", "LinkHubHashKeyName")
    assert got == [(1, "CC_ID", "ContractHashKey"), (2, "CC_VERSION", "ContractHashKey"), (3, "CC_PARENT_ID", "ParentContractHashKey")]


def test_mappings_become_specs(spark):
    tables, columns, pk, fk, ref = frames(spark)
    hub_mapping = model.hubs(tables, pk, ref)
    hubs = metadata.hub_specs(hub_mapping, "RV_CMS")
    assert [(h.name, h.hash_key, h.keys) for h in hubs][:2] == [
        ("HubBroker", "BrokerHashKey", ["CB_ID"]), ("HubContract", "ContractHashKey", ["CC_ID"])]
    links = metadata.link_specs(model.links(fk, tables, ref, hub_mapping), name="LinkContractBroker")
    assert links[0].sources[0].hubs == {
        "ContractHashKey": ["CC_ID"], "BrokerHashKey": ["CC_BROKER"], "SalesBrokerHashKey": ["SALES_BROKER_ID"]}
    sats = metadata.sat_specs(model.sats(columns, pk, fk, ref), "NULL", "ALL", hubs)
    assert [(s.name, s.hash_key, s.keys, s.attributes) for s in sats] == [
        ("SatBroker", "BrokerHashKey", ("CB_ID",), ("CB_NAME",)), ("SatContract", "ContractHashKey", ("CC_ID",), ("CC_NAME", "CC_STATUS"))]


def test_catalog_of_frames(spark, rows):
    frame = spark.createDataFrame([], "a int, b string")
    assert rows(model.catalog({("D", "STG_X", "T"): frame})) == [("D", "STG_X", "T", "a", 1), ("D", "STG_X", "T", "b", 2)]


def test_names(spark):
    df = spark.createDataFrame([("CMS_CONTRACT_BOOK",), ("CMMS_TRADE",), ("REALLOCATION",)], "t string")
    assert [r[0] for r in df.select(entity(F.col("t"))).collect()] == ["ContractBook", "Trade", "Reallocation"]
    ids = spark.createDataFrame([("SALES_BROKER_ID",), ("IDENTITY_ID",)], "t string")
    assert [r[0] for r in ids.select(entity(F.col("t"), drop=["ID"])).collect()] == ["SalesBroker", "Entity"]


def test_dictionary_scope(spark, rows):
    constraints = spark.createDataFrame(
        [("A", "PK1", "P", None, None), ("A", "PK2", "P", None, None), ("A", "FK1", "R", "A", "PK1"), ("B", "FK2", "R", "A", "PK2")],
        "owner string, constraint_name string, constraint_type string, r_owner string, r_constraint_name string")
    columns = spark.createDataFrame(
        [("A", "PK1", "T1", "ID", 1), ("A", "PK1", "T1", "V", 2), ("A", "PK2", "T2", "ID", 1), ("A", "FK1", "T2", "T1_ID", 1),
         ("A", "FK1", "T2", "T1_V", 2), ("B", "FK2", "T3", "T2_ID", 1)],
        "owner string, constraint_name string, table_name string, column_name string, position int")
    shown = ("ParentTable", "ParentColumn", "ChildTable", "ChildColumn", "ColumnPosition", "FKConstraintName")
    one = [("T1", "ID", "T2", "T1_ID", 1, "FK1"), ("T1", "V", "T2", "T1_V", 2, "FK1")]
    assert rows(model.fk_dictionary(constraints, columns, {"A": ["T1"]}), *shown) == one
    assert len(rows(model.fk_dictionary(constraints, columns, {"A": None}))) == 3
    assert rows(model.pk_dictionary(constraints, columns, {"A": ["T2"], "B": None})) == [("T2", "ID", 1, "PK2")]


def test_a_satellite_whose_key_is_partly_a_foreign_key_takes_its_hubs_key(spark):
    tables, columns, pk, fk, ref = frames(spark)
    pk = pk.where("SrcTable <> 'CMS_CONTRACT'").unionByName(
        spark.createDataFrame([("CMS_CONTRACT", "CC_BROKER", 1, "P1"), ("CMS_CONTRACT", "CC_ID", 2, "P1")], pk.schema))
    hubs = metadata.hub_specs(model.hubs(tables, pk, ref), "RV_CMS")
    mapping = model.sats(columns, pk, fk, ref)
    spec = metadata.sat_specs(mapping, "RV_CMS", "SatContract", hubs)[0]
    assert spec.keys == ("CC_BROKER", "CC_ID") and (spec.source_schema, spec.database) == ("STG_CMS", "DB")
    assert metadata.sat_specs(mapping, "RV_CMS", "SatContract")[0].keys == ("CC_ID",)


def test_sources_are_found_by_what_the_spec_says(spark):
    a, b = spark.range(1), spark.range(2)
    two = {("DB", "STG_A", "T"): a, ("DB", "STG_B", "T"): b}
    assert vault.source_frame(two, "T", "STG_B") is b and vault.source_frame(two, "T", "STG_A", "DB") is a
    assert vault.source_frame({"T": a}, "T", "STG_A", "DB") is a and vault.source_frame({("STG_B", "T"): b}, "T", database="DB") is b
    for wrong in (("T", None), ("T", "STG_C"), ("U", None)):
        with pytest.raises(KeyError):
            vault.source_frame(two, *wrong)
    with pytest.raises(ValueError, match="choose a schema"):
        vault.load_hubs([HubSpec("HubT", (HubSource("T", {"id": "id"}, "A", s),), f"RV_{s}") for s in ("A", "B")], two, {}, "2024-01-01")


def test_foreign_keys_are_dealt_once_by_child_table(spark, plan):
    tables, _, pk, fk, ref = frames(spark)
    text = plan(model.links(fk, tables, ref, model.hubs(tables, pk, ref)))
    assert "collect_list(struct(FKConstraintName" not in text
    assert "hashpartitioning(ChildTable" in text and "hashpartitioning(ChildTable#0, ParentTable" not in re.sub(r"#\d+", "#0", text)


def test_names_where_a_constraint_has_no_name(spark, rows):
    """The least name is the main one, and a pair's own key comes once however many roles it has."""
    tables, _, pk, fk, ref = frames(spark)
    fk = fk.withColumn("FKConstraintName", F.when(F.col("FKConstraintName") != "FK1", F.col("FKConstraintName")))
    twice = tables.unionByName(tables.where("table_name = 'CMS_BROKER'").withColumn("table_schema", F.lit("STG_B")))
    found = model.links(fk, twice, ref, model.hubs(tables, pk, ref)).where("LinkName = 'LinkContractBroker'")
    assert rows(found.groupBy("LinkSchema", "SrcBusinessKey", "LinkHubHashKeyName").count()) == sorted(
        (schema, *key, 1) for schema in ("RV_B", "RV_CMS")
        for key in (("CC_ID", "ContractHashKey"), ("CC_BROKER", "CcBrokerHashKey"), ("SALES_BROKER_ID", "BrokerHashKey")))


def test_dictionary_pairs_come_from_joins_of_rows(spark, plan):
    constraints = spark.createDataFrame([], "owner string, constraint_name string, constraint_type string, r_owner string, r_constraint_name string")
    columns = spark.createDataFrame([], "owner string, constraint_name string, table_name string, column_name string, position int")
    assert "collect_list" not in plan(model.fk_dictionary(constraints, columns, {"A": None}))
