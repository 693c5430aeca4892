"""Profiling."""

from pyspark.sql import functions as F

from registry.base import query
from vaultline.operators import profile


@query("profile_histogram", """
with s as (select min(o_totalprice) as low, max(o_totalprice) as high, (max(o_totalprice) - min(o_totalprice)) / 20 as w from {orders}),
     bins as (select cast(i as integer) as bin, low + i * w as bin_low, case when i = 19 then high else low + (i + 1) * w end as bin_high
                from s, range(20) r(i))
select bin, bin_low, bin_high, count(o_totalprice) as row_count
  from bins left join {orders} on o_totalprice >= bin_low and (o_totalprice < bin_high or (bin = 19 and o_totalprice = bin_high))
 group by bin, bin_low, bin_high
""")
def profile_histogram(data):
    return profile.histogram(data["orders"], "o_totalprice", 20)


@query("profile_value_counts", "select c_mktsegment, count(*) as row_count from {customer} where c_mktsegment is not null group by c_mktsegment")
def profile_value_counts(data):
    return profile.value_counts(data["customer"], "c_mktsegment")


@query("profile_value_counts_keys", "select o_custkey, count(*) as row_count from {orders} where o_custkey is not null group by o_custkey")
def profile_value_counts_keys(data):
    return profile.value_counts(data["orders"], "o_custkey")


def describe_sql(table: str, column: str) -> str:
    v = f"cast({column} as double)"
    return (
        f"select '{column}' as column_nm, count({v}) as value_count, round(avg({v}), 4) as mean_value,"
        f" round(stddev_samp({v}), 4) as std_value, min({v}) as min_value, round(quantile_cont({v}, 0.25), 6) as p25,"
        f" round(quantile_cont({v}, 0.5), 6) as p50, round(quantile_cont({v}, 0.75), 6) as p75, max({v}) as max_value"
        f" from {{{table}}}"
    )


def rounded(frame):
    return frame.withColumns({
        **{c: F.round(c, 4) for c in ("mean_value", "std_value")}, **{c: F.round(c, 6) for c in ("p25", "p50", "p75")},
    })


@query("profile_describe", " union all ".join(describe_sql("orders", c) for c in ("o_orderkey", "o_custkey", "o_totalprice")))
def profile_describe(data):
    return rounded(profile.describe(data["orders"]))


@query("profile_describe_lines", " union all ".join(
    describe_sql("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
))
def profile_describe_lines(data):
    return rounded(profile.describe(data["lineitem"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("profile_pairs", "select c_nationkey as x, c_acctbal as y from {customer}")
def profile_pairs(data):
    return profile.pairs(data["customer"], "c_nationkey", "c_acctbal")


# As many rows as are asked for, the same in every run.
@query("profile_pairs_sample", """
select c_nationkey as x, c_acctbal as y from {customer}
 order by md5(concat(cast(c_nationkey as varchar), '|', cast(cast(c_acctbal as decimal(18,2)) as varchar))), 1, 2 limit 100
""")
def profile_pairs_sample(data):
    exact = data["customer"].withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    return profile.pairs(exact, "c_nationkey", "c_acctbal", rows=100).withColumn("y", F.col("y").cast("double"))
