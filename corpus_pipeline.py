"""The corpus pipeline: stages, each over all that the one before kept.

A stage takes the session, the documents and the data folder. All but the last return documents with the columns that
they came with. Each kind of edge case (nulls, empty and very long texts, ties, repeated rows, an empty table, further
columns) has the result that the stage's operator defines.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vaultline.llm import classifier, decontaminate, jaccard_join, mixing, token_files
from vaultline.llm.common import shared_folder, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near-duplicate stages on word shingles: words in a shingle, and percent of similarity.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return classifier.keep_good(docs, classifier.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.keep_one(docs, NEAR_WORDS, NEAR_PERCENT, parts_from=None)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words of a benchmark item's window go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids in bit-packed files, with each one's place in them."""
    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID / binary output", token_output),
]
#: SQL can express neither the classifier nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
