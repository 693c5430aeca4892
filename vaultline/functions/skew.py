"""Joins that stay even when one key holds a large share of the rows.

Rows of a hot key get one of ``SALTS`` numbers by the hash of what they hold, and the rows of the other side that have
this key are repeated once for each number. So one join on key and number is enough: each side is read and shuffled
once, and a hot key lies in as many tasks as there are numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.keys import all_equal, any_null

HOT_SHARE = 1000
SALTS = 64
# Groups of tasks whose sketches are combined first.
SKETCH_GROUPS = 64
# Types the frequency sketch counts as they are; others, and composite keys, are counted as text.
COUNTED_TYPES = ("int", "bigint", "string")


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold about one ``share``-th of all rows or more: at most ``share`` keys, whatever the
    data, and each of them a key of ``df``.

    Frequent-items sketches find them in one pass that shuffles no keys: those of a group of tasks are combined first,
    then those of the groups. Their counts are estimates, which only moves the border between hot and other keys.
    """
    types = dict(df.dtypes)
    plain = len(keys) == 1 and types[keys[0]] in COUNTED_TYPES
    item = F.col(keys[0]) if plain else F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group")
    counted = df.select(item.alias("_item"), group).groupBy("_group").agg(
        F.call_function("approx_top_k_accumulate", F.col("_item"), F.lit(10 * share)).alias("_sketch"), F.count(F.lit(1)).alias("_n")
    )
    top = counted.groupBy(F.lit("all").alias("_all")).agg(F.call_function("approx_top_k_combine", F.col("_sketch"), F.lit(10 * share)).alias("_sketch"), F.sum("_n").alias("total"))
    found = top.select("total", F.inline(F.call_function("approx_top_k_estimate", F.col("_sketch"), F.lit(share))))
    found = found.where(F.col("count") * share >= F.col("total"))
    if plain:
        return found.select(F.col("item").alias(keys[0]))
    parts = F.from_json("item", "array<string>")
    return found.select(*[parts[i].cast(types[k]).alias(k) for i, k in enumerate(keys)])


def known_hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame | None:
    """``hot_keys`` as one value, found once: at most ``share`` rows that every later use reads alike, so that a row
    is never hot in one branch and not in another. None if there are none, and the plan needs no salt."""
    found = hot_keys(df, keys, share)
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def salted_join(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], how: str,
    *, hot_left: DataFrame | None = None, hot_right: DataFrame | None = None,
) -> DataFrame:
    """``left`` joined to ``right`` on equal keys, ``left`` or ``full``; the columns of both. ``hot_left`` has keys of
    ``left`` that many of its rows share, ``hot_right`` keys of ``right``; a key in both is salted on the left.

    A repeated row that finds no partner for its number is no row without a partner: a key hot on one side is present
    there, so such rows are left out. Null keys match nothing; they are spread over all tasks.
    """
    if how not in ("left", "full"):
        raise ValueError(f"a salted join is left or full, not {how}")
    left_keys, right_keys = list(left_keys), list(right_keys)
    salted_left = _tagged(left, left_keys, hot_left, "_hot_left")
    salted_right = _tagged(right, right_keys, hot_left, "_hot_left")
    salted_left = _tagged(salted_left, left_keys, hot_right, "_hot_right")
    salted_right = _tagged(salted_right, right_keys, hot_right, "_hot_right")
    number, every = F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)), F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    own_number, zero = F.pmod(F.xxhash64(*right.columns), F.lit(SALTS)), F.lit(0).cast("bigint")
    by_left, by_right = F.col("_hot_left"), F.col("_hot_right") & ~F.col("_hot_left")
    salted_left = salted_left.select(
        *left.columns, F.explode(F.when(by_right, every).otherwise(F.array(F.when(by_left | any_null(left_keys), number).otherwise(zero)))).alias("_left_salt"),
        by_right.alias("_left_copy"),
    )
    salted_right = salted_right.select(
        *right.columns, F.explode(F.when(by_left, every).otherwise(F.array(F.when(by_right | any_null(right_keys), own_number).otherwise(zero)))).alias("_right_salt"),
        by_left.alias("_right_copy"),
    )
    met = salted_left.join(salted_right, all_equal([*left_keys, "_left_salt"], [*right_keys, "_right_salt"]), how)
    alone_left = F.col("_right_salt").isNull() & F.col("_left_copy")
    alone_right = F.col("_left_salt").isNull() & F.col("_right_copy")
    return met.where(~F.coalesce(alone_left, F.lit(False)) & ~F.coalesce(alone_right, F.lit(False))).select(*left.columns, *right.columns)


def _tagged(df: DataFrame, keys: list[str], hot: DataFrame | None, name: str) -> DataFrame:
    """Whether each row's key is one of a few, found in the scan: their number is bounded, so they are broadcast."""
    if hot is None:
        return df.withColumn(name, F.lit(False))
    few = hot.toDF(*[f"_hot_{i}" for i in range(len(keys))]).withColumn(name, F.lit(True))
    same = all_equal([f"_hot_{i}" for i in range(len(keys))], keys)
    return df.join(F.broadcast(few), same, "left").select(*df.columns, F.coalesce(F.col(name), F.lit(False)).alias(name))


def lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], share: int | None = HOT_SHARE
) -> DataFrame:
    """``left`` left-joined to ``right``, whose keys are unique. Hot left keys are salted; null keys match nothing.
    ``share=None`` is the ordinary join alone, for a left side known to be unique per key.
    """
    keys = list(keys)
    if share is None:
        return left.join(right, keys, "left")
    hot = known_hot_keys(left.where(~any_null(keys)), keys, share)
    extra: list[Column] = [F.col(c) for c in right.columns if c not in keys]
    if hot is None and not any(f.nullable for f in left.schema.fields if f.name in keys):
        return left.join(right, keys, "left")
    renamed = [f"_right_{i}" for i in range(len(keys))]
    other = right.withColumnsRenamed(dict(zip(keys, renamed)))
    return salted_join(left, other, keys, renamed, "left", hot_left=hot).select(*[F.col(c) for c in left.columns], *extra)
