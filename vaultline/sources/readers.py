"""Inputs: files with a header, parquet, and tables of a database."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A CSV file with a header. Without a schema the types are inferred, at the cost of a pass over it."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
    lower: int | None = None, upper: int | None = None, partitions: int = 64, properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table or aliased query of a database; with a partition column, read by many tasks at once."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions,
        properties=properties,
    )


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored parquet table, or None before its first load."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
