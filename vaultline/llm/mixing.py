"""Mixing sources to target weights.

Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the mix by weight; a source gives at most
``MAX_EPOCHS`` times its size, what is over goes to the others by weight. Within a source, documents are sorted by a
hash-random key (the md5 of their id). The key's first digits cut each source into ranges, whose sizes are summed and
prefix-summed; within a range a running sum gives each document's place. The words up to the source's exact budget are
taken: whole epochs first, then the documents in key order, the one at the cut in part.

A source of any share of the rows is spread over as many ranges as its number of documents asks for; only sums per
range and per source meet in one place. Sizes are integers and ties are broken by id and size, so reruns agree.

Defined results: a null or empty text has size 0 and gives nothing; null ids sort before others; rows alike in source,
id and size are interchangeable; repeated rows count each; an empty table gives an empty result; if all sizes are 0,
all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import row_key, stored

#: The sources' weights, repeating, and the most that a source may give.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RANGE_ROWS = 4096
MOST_RANGES = 16**7


def size_of(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, n_docs`` with each source's target: ``least(cap, weight * level)`` for the one level at
    which they add up to all sizes. The sources that reach their cap are those with the least cap per weight; sums of
    caps and weights in that order tell where they end. One row per source, whatever the number of documents."""
    weighed = sizes.select(
        "source", "source_size", "n_docs", (F.col("source_size") * max_epochs).alias("cap"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights) + 1).cast("long").alias("weight"),
    )
    # caps per weight are compared as whole numbers: cap * (product of the weights) / weight
    common = 1
    for w in weights:
        common *= w
    rank = Window.orderBy(F.expr(f"cap * {common} div weight"), F.asc_nulls_last("source"))
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    placed = weighed.select(
        "*", F.sum("source_size").over(all_rows).alias("total"), F.sum("weight").over(all_rows).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps"), F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weights"),
    ).withColumns({"left": F.col("total") - F.col("caps"), "open": F.col("all_weight") - F.col("weights")})
    # at its place in that order a source is full if its share of what the fuller ones leave exceeds its cap
    full = F.col("weight") * F.col("left") > F.col("cap") * F.col("open")
    levelled = placed.withColumn("full", full).withColumns({
        "rest": F.min(F.when(~full, F.struct(F.col("open") * -1, "left", "open"))).over(all_rows),
    })
    share = (F.col("weight") * F.col("rest.left")).cast("double") / F.col("rest.open").cast("double")
    return levelled.select(
        "source", "source_size", "n_docs", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.coalesce(share, F.lit(0.0))).alias("target")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words that the mix takes of it."""
    id_text = F.col("doc_id.doc_id" if docs.schema["doc_id"].dataType.typeName() == "struct" else "doc_id").cast("string")
    sized = stored(docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), size_of(F.col("text")).alias("size"),
        F.md5(F.coalesce(id_text, F.lit("")).cast("binary")).alias("key"),
    ), "mix-sizes")
    goals = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights, max_epochs), "mix-targets")
    joined = sized.join(goals, sized["source"].eqNullSafe(goals["source"])).select(
        sized["*"], "source_size", "n_docs", "target",
        F.expr(f"conv(substring(key, 1, 7), 16, 10)").cast("long").alias("place"),
    ).withColumn("bucket", F.expr(f"place * least({MOST_RANGES}L, n_docs div {range_rows} + 1) div {MOST_RANGES}"))
    ranges = joined.groupBy("source", "bucket").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("before_range")
    )
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = joined.withColumn("in_range", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = running.join(offsets, running["source"].eqNullSafe(offsets["s"]) & (running["bucket"] == offsets["b"]))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    cut = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before_range") - F.col("in_range")))
    return placed.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + cut).alias("taken"), "source", epochs.alias("epochs"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix as documents, with all their columns: each as often as it is taken whole, and once more if the cut takes
    half of its words or more. Without words to take (size 0) a document stays once. Rows alike in id and text each
    appear as often as the most taken of them."""
    names = docs.columns
    keyed = docs.select(F.struct(*[docs[c] for c in names]).alias("_doc"), row_key().alias("_row"))
    rows = docs.select(F.struct("doc_id", row_key().alias("row")).alias("doc_id"), "source", "text")
    times = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("int")
    taken = mix(rows, weights, max_epochs).select(F.col("doc_id.row").alias("_row"), times.alias("_times"))
    taken = taken.groupBy("_row").agg(F.max("_times").alias("_times")).where("_times > 0")
    return keyed.join(taken, "_row").select("_doc", F.explode(F.sequence(F.lit(1), "_times"))).select("_doc.*")
