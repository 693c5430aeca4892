"""Where a frame is read more than once, it is stored once, in the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators.screens import ROW_ADDRESS

CHECKPOINT_DIR = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses ``spark.checkpoint.dir``. Only a local session without that setting (a test) gets a
    temporary folder; a cluster without it is an error, since its executors share no local disk."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vaultline-checkpoint-")
    context.setCheckpointDir(configured)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: later branches read the stored rows and survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_addresses(df: DataFrame) -> DataFrame:
    """``df`` with the address of each row. Rows read straight from Parquet files have theirs from the scan: the file and
    the place in it, which no later reading changes. Any other frame is stored first."""
    try:
        found = df.select("*", _address().alias(ROW_ADDRESS))
        found.schema  # noqa: B018 - resolves the columns
    except AnalysisException:
        return store_addressed(df)
    return found


def _address() -> Column:
    return F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def store_addressed(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once (to a new folder of those that the cluster shares, if none is given) and read back, each row
    with its address: the file and its place there. No two rows share one, whatever they hold."""
    spark = df.sparkSession
    if path is None:
        ensure_checkpoint_dir(spark)
        path = f"{spark.sparkContext.getCheckpointDir()}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select("*", _address().alias(ROW_ADDRESS))
