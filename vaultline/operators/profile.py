"""Profiling: histogram, value counts, summary statistics, value pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.plans.materialize import cut_lineage

# The quartiles of the summary, and the usual bin count.
QUARTILES = (0.25, 0.5, 0.75)
DEFAULT_BINS = 20
# A sketch's size, its rank error as a share of the rows (three times it on either side makes a bracket), and the groups
# of tasks that keep one each.
SKETCH_SIZE, BRACKET_SHARE, SKETCH_GROUPS = 16_384, 0.0003, 64


def histogram(df: DataFrame, column: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """Counts in equal-width bins from the least to the greatest value; the last bin is closed.

    Edges are ``low + i * width``, and a value always lies between the edges of its bin. A column of
    one single value gets bins around it. Empty bins are listed.
    """
    if bins < 1:
        raise ValueError("a histogram has at least one bin")
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    limits = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).where(F.col("low").isNotNull())
    half = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    limits = limits.select((F.col("low") - half).alias("low"), (F.col("high") + half).alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    edges = F.concat(
        F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.col("low") + i * width), F.array("high")
    )
    scale = limits.select(F.struct("low", width.alias("width"), edges.alias("edges")).alias("s"))
    guess = F.least(F.floor((F.col("v") - F.col("s.low")) / F.col("s.width")).cast("int"), F.lit(bins - 1))
    counts = (
        values.withColumn("s", scale.scalar())
        .select("v", "s.edges", guess.alias("g"))
        .select(
            F.when(F.col("v") < F.get("edges", "g"), F.col("g") - 1)
            .when((F.col("g") < bins - 1) & (F.col("v") >= F.get("edges", F.col("g") + 1)), F.col("g") + 1)
            .otherwise(F.col("g")).alias("bin")
        )
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    )
    every = scale.select("s.edges", F.posexplode(F.slice("s.edges", 1, bins)).alias("bin", "bin_low"))
    return every.join(counts, "bin", "left").select(
        "bin", "bin_low", F.get("edges", F.col("bin") + 1).alias("bin_high"), F.coalesce("n", F.lit(0)).alias("row_count"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Values by falling count, NULL left out; equal counts in order of value."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), column)
    )


def numeric_columns(df: DataFrame) -> list[str]:
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [name for name, kind in df.dtypes if kind.startswith(kinds)]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, least, quartiles and greatest value of each numeric column.

    Quartiles are exact and interpolated. No task sees a whole column: one pass takes the moments and
    a sketch whose error is known, the second counts the few values that the sketch brackets around
    each quartile, and only those are ranked.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    values = df.select(*[_number(df, c) for c in names])
    summary = _summary(values, names)
    return summary.join(_quartiles(values, names, summary), "column_nm", "left").select(
        "column_nm", F.col("n").alias("value_count"), F.col("mean").alias("mean_value"), F.col("std").alias("std_value"),
        F.col("low").alias("min_value"), *_quartile_names(), F.col("high").alias("max_value"),
    )


def pairs(df: DataFrame, x: str, y: str, fraction: float | None = None, rows: int | None = None) -> DataFrame:
    """Two columns for a scatter plot. Where the caller wants a sample, ``fraction`` draws a share of the rows, and
    ``rows`` that number of them: those of the least hash, the same in every run. Each task keeps no more than it."""
    points = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    if rows is not None:
        digest = F.md5(F.concat_ws("|", F.coalesce(F.col("x").cast("string"), F.lit("-")), F.coalesce(F.col("y").cast("string"), F.lit("-"))))
        points = points.orderBy(digest, "x", "y").limit(rows)
    return points.sample(fraction) if fraction is not None else points


def _number(df: DataFrame, column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value).alias(column)


def _summary(values: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per column: its moments from one aggregate over all columns, and brackets from its sketch.

    A sketch is kept by each of ``SKETCH_GROUPS`` groups of tasks, and these few are merged, so that no task merges the
    sketches of all tasks."""
    margin = 3.0 * BRACKET_SHARE
    points = [p for q in QUARTILES for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    moments, sketches = [], []
    for i, c in enumerate(names):
        v = F.col(c)
        moments.append(F.struct(
            F.lit(c).alias("column_nm"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("low"), F.max(v).alias("high"),
        ))
        sketches.append(F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)).alias(f"s{i}"))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    by_group = values.select(*names, group).groupBy("_group").agg(*sketches)
    merged = by_group.agg(*[F.kll_merge_agg_double(f"s{i}").alias(f"s{i}") for i in range(len(names))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_nm"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(names)])
    marks = merged.select(F.inline(rows)).select(
        "column_nm", F.when(F.kll_sketch_get_n_double("sketch") > 0, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, points)))).alias("marks")
    )
    return values.agg(F.array(*moments).alias("all")).select(F.inline("all")).join(F.broadcast(marks), "column_nm")


def _quartile_names() -> list[str]:
    return [f"p{int(p * 100)}" for p in QUARTILES]


def _quartiles(values: DataFrame, names: Sequence[str], summary: DataFrame) -> DataFrame:
    """Exact quartiles by rank, one row per column. A bracket that misses its rank fails the job.

    Values inside a bracket are counted one by one, all values of a gap between brackets together;
    in order of value, these counts add up to ranks.
    """
    # One row per column, a size fixed by the schema.
    brackets = F.broadcast(summary.where(F.col("n") > 0).select("column_nm", "n", "marks"))
    value, marks = F.col("value"), F.col("marks")
    inside = reduce(or_, [value.between(marks[2 * i], marks[2 * i + 1]) for i in range(len(QUARTILES))])
    gap = reduce(Column.__add__, [(value > marks[2 * i]).cast("int") for i in range(len(QUARTILES))])
    counted = (
        values.unpivot([], list(names), "column_nm", "value").where(value.isNotNull())
        .join(brackets, "column_nm")
        .groupBy("column_nm", "n", F.when(~inside, gap).alias("gap"), F.when(inside, value).alias("single"))
        .agg(F.count(F.lit(1)).alias("times"), F.min("value").alias("value"))
    )
    # Ranks by prefix sums: values lie in ranges of one order, each range in its own task, and what comes before a range
    # is known from the ranges' totals, a row for each range and column.
    ranged = cut_lineage(counted.repartitionByRange("column_nm", "value").withColumn("range", F.spark_partition_id()))
    totals = ranged.groupBy("column_nm", "range").agg(F.sum("times").alias("total"))
    before = F.sum("total").over(Window.partitionBy("column_nm").orderBy("range")) - F.col("total")
    upto = F.sum("times").over(Window.partitionBy("column_nm", "range").orderBy("value"))
    ranked = ranged.join(totals.select("column_nm", "range", before.alias("before")), ["column_nm", "range"]).withColumn("upto", F.col("before") + upto)
    picks = []
    for p, name in zip(QUARTILES, _quartile_names(), strict=True):
        rank = (F.col("n") - 1) * p
        for end, place in (("a", F.floor(rank)), ("b", F.ceil(rank))):
            picks.append(F.min(F.when(F.col("upto") > place, F.struct("upto", "single"))).alias(f"{name}_{end}"))
    found = ranked.groupBy("column_nm", "n").agg(*picks)
    return found.select("column_nm", *[_interpolated(p, n) for p, n in zip(QUARTILES, _quartile_names(), strict=True)])


def _interpolated(p: float, name: str) -> Column:
    a, b = F.col(f"{name}_a.single"), F.col(f"{name}_b.single")
    rank = (F.col("n") - 1) * p
    missed = F.raise_error(F.lit("quartile outside its bracket"))
    return F.when(a.isNull() | b.isNull(), missed).otherwise(a + (b - a) * (rank - F.floor(rank))).alias(name)
