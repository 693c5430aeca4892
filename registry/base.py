"""Registration of queries with their SQL, and the inputs that Spark and DuckDB derive alike.

A derived input is one SQL text over the given tables (or other derived inputs), valid in both engines:
Spark runs it as a frame, the SQL check embeds it as a named subquery. ``timestamp_ntz`` is the only
word that is written differently for DuckDB.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
INPUTS: dict[str, str] = {}

FILE_DATE = "2001-10-01 00:00:00"
AS_OF = "2024-01-30"
LOAD_TIME = "2024-02-01 00:00:00"


class Data:
    """The given tables and derived inputs of one data folder, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = (
                self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet") if name in TABLES else self.sql(INPUTS[name])
            )
        return self._frames[name]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: self[n] for n in _names(text)})


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def _duck(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text).replace("timestamp_ntz", "timestamp")


def _needed(text: str, seen: list[str]) -> list[str]:
    for name in _names(text):
        if name in INPUTS and name not in seen:
            _needed(INPUTS[name], seen)
            seen.append(name)
    return seen


def oracle(text: str) -> str:
    """The SQL check: ``text`` with every derived input it names put before it."""
    parts = [f"{n} as materialized (\n{_duck(INPUTS[n]).strip()}\n)" for n in _needed(text, [])]
    body = _duck(text).strip()
    if not parts:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[len("with "):]
    return "with " + ",\n".join(parts) + "\n" + body


def query(name: str, sql: str | None = None):
    """Registers a function of ``Data`` under ``name``, with its SQL."""

    def register(build: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Data(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return build

    return register
