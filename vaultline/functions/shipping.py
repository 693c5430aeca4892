"""The package's modules for executors that do not have it installed."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import vaultline


def ship_package(spark: SparkSession) -> None:
    """Sends the modules along with the session's jobs, once a session."""
    context = spark.sparkContext
    if getattr(context, "_vaultline_shipped", False):
        return
    package = Path(vaultline.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="vaultline-package-"), "vaultline.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, str(path.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._vaultline_shipped = True
