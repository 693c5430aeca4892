"""Reading inputs, cutting lineage and telling rows apart."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import vaultline
from vaultline.plans.materialize import CHECKPOINT_DIR, ensure_checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the folder that the cluster shares."""
    ensure_checkpoint_dir(spark)
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later branches survive lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def drop(*frames: DataFrame) -> None:
    """Gives back the disk of frames from ``stored`` that nothing will read any more."""
    for df in frames:
        delete(df.sparkSession, df._stored_at)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is planned inside go when it ends; else they stay until the driver happens to
    collect garbage. For queries that run once: frames given to others are made outside."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and text alone, so that no other column can clash with the operators' own."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that tell rows apart by id and text; rows alike in both share a key, and all results with it."""
    return F.unhex(F.md5(F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit(":"), F.when(F.col(text).isNull(), "-").otherwise("+"),
        F.coalesce(F.col(text), F.lit("")),
    ).cast("binary")))


def give_back() -> None:
    """Memory that a worker has freed goes back to the system. Workers are reused, and would keep the most that any
    task needed beside what the next one holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow``, for functions of this package: its modules are sent along to the executors, once a session."""
    context = df.sparkSession.sparkContext
    if getattr(context, "_vaultline_sent", None) is None:
        package = Path(vaultline.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="vaultline-modules-"), "vaultline.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, str(path.relative_to(package.parent)))
        context.addPyFile(str(archive))
        context._vaultline_sent = str(archive)

    @functools.wraps(run)  # the plan keeps its name
    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(parts)
        give_back()

    return df.mapInArrow(task, schema)
