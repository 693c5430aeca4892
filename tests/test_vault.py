import hashlib
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from vaultline.functions.hashing import CONVERTED_LENGTH, HashRule, md5_key
from vaultline.functions.skew import hot_keys, lookup, salted_join
from vaultline.operators import conform, integrity, vault
from vaultline.plans import vault_jobs
from vaultline.specs import HubSource, HubSpec, LinkSource, LinkSpec, SatSpec

T1, T2, T3 = "2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"
HUB = HubSpec("HubBroker", (HubSource("broker", {"CB_ID": "CB_ID"}, "CMS"),), "RV_CMS")
LINK = LinkSpec("LinkContractBroker", (
    LinkSource("contract", {"ContractHashKey": ["CC_ID"], "BrokerHashKey": ["CC_BROKER"]}, "CMS"),
), "RV_CMS")
SAT = SatSpec("SatBroker", ("name", "city"), keys=("CB_ID",), schema="RV_CMS", object_name="broker", record_source="CMS")


def md5(text, charset="utf-8"):
    return hashlib.md5(text.encode(charset)).hexdigest()


def one(spark, value, **options):
    return spark.range(1).select(F.lit(value).alias("v")).select(md5_key(["v"], **options)).first()[0]


def test_hash_text(spark):
    assert one(spark, 1) == "77529b68d130d125ff07a534a7b69adb"
    assert one(spark, 1, charset="UTF-16LE") == "b7cb839d6b1dab6cc6c33058aa10d09f" == md5("1|", "utf-16-le")
    assert one(spark, "NA") == one(spark, None) == md5("NA|")
    assert one(spark, "a") == one(spark, "a  ")
    assert bytes(one(spark, 1, binary=True)).hex() == md5("1|")


def test_hash_covers_the_whole_text_unless_asked(spark):
    long, longer = "x" * 100, "x" * 100 + "y"
    assert one(spark, long) != one(spark, longer)
    cut = partial(one, spark, max_len=CONVERTED_LENGTH)
    assert cut(long) == cut(longer)


def test_hash_order(spark):
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    assert df.select(md5_key(["b", "a"])).first()[0] == md5("2|1|")
    assert df.select(md5_key(["b", "a"], order="position")).first()[0] == md5("1|2|")
    with pytest.raises(ValueError):
        md5_key(["a"], order="other")


def test_second_loads_add_nothing(spark):
    brokers = spark.createDataFrame([(1, "ann", "rome"), (1, "ann", "rome"), (2, "bob", None), (None, "x", "y")], "CB_ID int, name string, city string")
    first = vault.load_hub({"broker": brokers}, None, HUB, T1)
    assert sorted(r.CB_ID for r in first.collect()) == [1, 2]
    assert vault.load_hub({"broker": brokers}, first, HUB, T2).isEmpty()
    contracts = spark.createDataFrame([(10, 1), (10, 1), (11, None), (12, 2)], "CC_ID int, CC_BROKER int")
    link = vault.load_link({"contract": contracts}, None, LINK, T1)
    assert link.count() == 2 and vault.load_link({"contract": contracts}, link, LINK, T2).isEmpty()
    row = link.where(F.col("ContractHashKey") == md5("10|")).first()
    assert row.ContractBrokerHashKey == md5("1|10|") and row.BrokerHashKey == md5("1|")
    assert vault.load_link({"contract": contracts}, None, LINK, T1, min_keys=1).count() == 3
    sat = vault.load_sat(brokers.distinct(), None, SAT, T1)
    assert sat.count() == 2 and vault.load_sat(brokers, sat, SAT, T2).isEmpty()


def test_composite_hub_and_link_hash_alike(spark):
    hub = HubSpec("HubLeg", (HubSource("leg", {"Z_ID": "LEG_A", "Y_ID": "LEG_B"}, "CMS"),))
    link = LinkSpec("LinkLegBook", (LinkSource("leg", {"LegHashKey": ["LEG_A", "LEG_B"], "BookHashKey": ["BOOK"]}, "CMS"),))
    legs = spark.createDataFrame([("a", "b", "c")], "LEG_A string, LEG_B string, BOOK string")
    for rule in (HashRule(), HashRule(order="position"), HashRule(charset="UTF-16LE", max_len=100)):
        hubs = vault.load_hub({"leg": legs}, None, hub, T1, rule=rule)
        links = vault.load_link({"leg": legs}, None, link, T1, rule=rule)
        assert hubs.first().LegHashKey == links.first().LegHashKey


def test_keys_that_hash_alike_are_one(spark):
    text_link = LinkSpec("LinkAB", (LinkSource("t", {"AHashKey": ["a"], "BHashKey": ["b"]}, "S"),))
    df = spark.createDataFrame([("x", "1"), ("x  ", "1"), ("y", "1")], "a string, b string")
    assert vault.load_link({"t": df}, None, text_link, T1).count() == 2
    hub = HubSpec("HubA", (HubSource("t", {"a": "a"}, "S"),))
    assert vault.load_hub({"t": df}, None, hub, T1).count() == 2
    # The separator is not escaped: one link hash, but different hub hashes, hence two rows.
    df = spark.createDataFrame([("a|", "b"), ("a", "|b")], "a string, b string")
    assert vault.load_link({"t": df}, None, text_link, T1).count() == 2


def test_sources_in_order(spark, rows):
    hub = HubSpec("HubName", (HubSource("one", {"n": "n"}, "ONE"), HubSource("two", {"n": "m"}, "TWO")))
    sources = {"one": spark.createDataFrame([("a",), ("b",)], "n string"), "two": spark.createDataFrame([("b ",), ("c",)], "m string")}
    assert rows(vault.load_hub(sources, None, hub, T1), "n", "RecordSource") == [("a", "ONE"), ("b", "ONE"), ("c", "TWO")]


def test_satellite_versions(spark, rows):
    staged = partial(spark.createDataFrame, schema="CB_ID int, name string, city string")
    sat = vault.load_sat(staged([(1, "ann", "rome"), (2, "bob", "oslo")]), None, SAT, T1)
    second = vault.load_sat(staged([(1, "ann", "bern"), (2, "bob", "oslo"), (3, "cat", None)]), sat, SAT, T2)
    assert rows(second, "name", "city") == [("ann", "bern"), ("cat", None)]
    # Back to the first state: the latest version decides, not any version.
    third = vault.load_sat(staged([(1, "ann", "rome")]), sat.unionByName(second), SAT, T3)
    assert rows(third, "name", "city") == [("ann", "rome")]
    all_versions = sat.unionByName(second).unionByName(third)
    assert integrity.key_violations(all_versions, [SAT.hash_key, "LoadDateTime"]).isEmpty()


def test_repeated_staged_rows(spark):
    staged = spark.createDataFrame([(1, "ann", "rome")] * 3, "CB_ID int, name string, city string")
    assert vault.load_sat(staged, None, SAT, T1).count() == 3
    assert vault.load_sat(staged, None, SAT, T1, dedupe=True).count() == 1
    assert vault.load_sat(staged, vault.load_sat(staged, None, SAT, T1), SAT, T2).isEmpty()


def test_latest_ties(spark):
    rows_ = [("k", T1, T1, "b"), ("k", T1, T2, "a"), ("k", T1, T2, "c"), ("j", T2, T1, "d"), ("j", T1, T3, "e")]
    sat = spark.createDataFrame(rows_, "k string, LoadDateTime string, AppliedDateTime string, HashDiff string")
    assert dict(map(tuple, vault.latest(sat, "k").collect())) == {"k": "c", "j": "d"}


def test_staged_business_objects(spark):
    staged = spark.createDataFrame([("h1", "S", 1), ("h1", "S", 1), ("h2", "S", 2), (None, "S", 3)], "K string, RecordSource string, id int")
    target = spark.createDataFrame([("h2",)], "K string")
    assert vault.load_staged(staged, target, "K", ["id"], T1).count() == 2
    assert vault.load_staged(staged, target, "K", ["id"], T1, dedupe=True).count() == 1


@pytest.mark.parametrize("value", [None, "NULL", "ALL"])
def test_selection(value):
    specs = [HUB, HubSpec("HubX", HUB.sources, "BV")]
    assert vault.select_specs(specs, value, value) == specs
    assert vault.select_specs(specs, "BV", value) == specs[1:]
    assert vault.select_specs(specs, value, "HubBroker") == specs[:1]


def test_stored_loads_run_again(spark, tmp_path):
    brokers = spark.createDataFrame([(1, "ann", "rome"), (2, "bob", None)], "CB_ID int, name string, city string")
    contracts = spark.createDataFrame([(10, 1), (11, 2)], "CC_ID int, CC_BROKER int")
    root, sources = str(tmp_path), {"broker": brokers, "contract": contracts}
    for time in (T1, T2):
        paths = vault_jobs.load_vault(spark, [HUB, LINK, SAT], sources, root, time)
    assert [spark.read.parquet(p).count() for p in paths] == [2, 2, 2]
    link, hub = spark.read.parquet(paths[1]), spark.read.parquet(paths[0])
    assert integrity.orphans(link, hub, "BrokerHashKey", "BrokerHashKey").isEmpty()


def test_target_layouts(spark):
    brokers = spark.createDataFrame([(1, "ann", "rome")], "CB_ID int, name string, city string")
    assert [c.name for c in conform.hub_columns(HUB, brokers)] == vault.load_hub({"broker": brokers}, None, HUB, T1).columns
    assert [c.name for c in conform.sat_columns(SAT, brokers)] == vault.load_sat(brokers, None, SAT, T1).columns
    contracts = spark.createDataFrame([(10, 1)], "CC_ID int, CC_BROKER int")
    assert [c.name for c in conform.link_columns(LINK)] == vault.load_link({"contract": contracts}, None, LINK, T1).columns


def test_hot_keys_are_few_and_lookup_is_a_left_join(spark, rows):
    left = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(0)).when(F.col("id") < 1020, F.lit(None)).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    assert [r.k for r in hot_keys(left.dropna(), ["k"], 10).collect()] == [0]
    # Composite and other keys come back exactly, whatever their text holds.
    odd = spark.range(100).select(
        F.when(F.col("id") < 60, F.lit('a",|\\b')).otherwise(F.col("id").cast("string")).alias("a"),
        F.lit("2024-01-01 10:11:12.123456").cast("timestamp_ntz").alias("b"), F.lit(1.5).cast("decimal(10,3)").alias("c"))
    assert hot_keys(odd, ["a", "b", "c"], 2).exceptAll(odd.limit(1)).isEmpty() and hot_keys(odd, ["a", "b", "c"], 2).count() == 1
    assert hot_keys(odd, ["b"], 2).first() == odd.select("b").first()
    # Found once: whatever order the sketch's parts are merged in, all uses see the same keys.
    spread = left.repartition(7, "id")
    for frame in (left, spread):
        assert rows(lookup(frame, right, ["k"], 10)) == rows(left.join(right, ["k"], "left"))
    got, want = lookup(left, right, ["k"], 10), left.join(right, ["k"], "left")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_hot_rows_are_salted_in_one_join(spark, plan):
    left = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.when(F.col("event_type") == "click", 1).otherwise(F.col("user_id")).cast("bigint").alias("k"), "event_id")
    right = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(F.col("c_custkey").alias("k"), "c_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(lookup(left, right, ["k"], 10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Each side is read and shuffled once, its hot rows known in the scan from the few keys.
    assert text.count("FileScan") == 2 and text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1
    assert text.count("Exchange hashpartitioning") == 2 and "_left_salt" in text


@pytest.mark.parametrize("how", ["left", "full"])
def test_salted_joins_are_ordinary_joins(spark, rows, how):
    """Hot keys on either side, on both, with and without partners, and null keys."""
    def side(name, *counts):
        pairs = [(k, i) for k, n in counts for i in range(n)]
        return spark.createDataFrame(pairs, f"{name} int, {name}_v int").repartition(3)

    left = side("a", (1, 200), (2, 1), (3, 150), (None, 40), (4, 3), (6, 1), (7, 90))
    right = side("b", (1, 1), (2, 180), (3, 2), (None, 30), (5, 170), (6, 1))
    want = rows(left.join(right, F.col("a") == F.col("b"), how))
    one, two = spark.createDataFrame([(1,), (3,), (7,)], "k int"), spark.createDataFrame([(2,), (5,), (3,)], "k int")
    for hot_left, hot_right in ((one, None), (None, two), (one, two), (None, None)):
        assert rows(salted_join(left, right, ["a"], ["b"], how, hot_left=hot_left, hot_right=hot_right)) == want


def test_load_plans(spark, plan):
    """Keys are combined before their shuffle, and the anti-join of a hub needs no further one."""
    sf = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    hub = HubSpec("HubSupply", (HubSource("lines", {"part": "l_partkey", "supplier": "l_suppkey"}, "S"),))
    link = LinkSpec("LinkPartSupplier", (LinkSource("lines", {"PartHashKey": ["l_partkey"], "SupplierHashKey": ["l_suppkey"]}, "S"),))
    stored_hub = lines.select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))
    stored_link = lines.select(F.col("l_returnflag").alias(link.hash_key))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hub_plan = plan(vault.load_hub({"lines": lines}, stored_hub, hub, T1))
        link_plan = plan(vault.load_link({"lines": lines}, stored_link, link, T1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in hub_plan and hub_plan.count("Exchange hashpartitioning") == 2
    assert "LeftAnti" in link_plan and link_plan.count("Exchange hashpartitioning") == 3
    for text in (hub_plan, link_plan):
        assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in text
    window = plan(vault.latest(spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_type").alias("k"), F.col("ts").alias("LoadDateTime"), F.col("ts").alias("AppliedDateTime"),
        F.col("props").alias("HashDiff")), "k"))
    assert "row_number(), 1, Partial" in window


def test_rows_of_two_sources_are_dealt_once_by_hash(spark, plan):
    rows = spark.range(10).selectExpr("id as a", "id as b")
    spec = LinkSpec("LinkAB", tuple(LinkSource(n, {"AHashKey": ["a"], "BHashKey": ["b"]}, n) for n in ("one", "two")))
    text = plan(vault.load_link({"one": rows, "two": rows.where("a > 4")}, None, spec, T1))
    assert len(re.findall(r"Exchange hashpartitioning\(ABHashKey", text)) == 1


def test_a_hub_of_one_source_holds_keys_alone(spark, plan):
    rows = spark.range(10).selectExpr("id as a")
    assert "min(" not in plan(vault.load_hub({"one": rows}, None, HubSpec("HubA", (HubSource("one", {"a": "a"}, "ONE"),), "RV"), T1))
