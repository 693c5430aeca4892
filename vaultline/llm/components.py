"""Connected components of a distributed graph, and bounded bit filters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``v, label`` for every end of a link ``a, b``: the smallest vertex of its component.

    Every round takes the smallest label among a vertex and its neighbours and then that label's own label, so the
    distance to the smallest vertex shrinks by a factor; labels and links stay in tables, cut by a written table each
    round, and a vertex with many links is summed by task first.
    """
    both = links.select("a", "b").where("a is not null and b is not null and a <> b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "v").select("v", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lower = stored(lower, "labels")
        jump = lower.select(F.col("v").alias("label"), F.col("label").alias("next"))
        after = stored(lower.join(jump, "label").select("v", F.col("next").alias("label"), "was"), "labels")
        if not after.where(F.col("label") != F.col("was")).limit(1).count():
            return after.select("v", "label")
        labels = after.select("v", "label")


def bits_of(hashes: DataFrame, log_bits: int) -> np.ndarray:
    """A filter of ``2 ** log_bits`` bits in which each ``h``, modulo that number, sets one. Its size is fixed; a set
    too large for it only lets more through."""
    at = F.col("h").bitwiseAND(F.lit((1 << log_bits) - 1))
    words = (
        hashes.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    )
    out = np.zeros(1 << (log_bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.astype(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
