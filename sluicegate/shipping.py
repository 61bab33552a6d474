"""Gives executors this package, so that Arrow functions can import it wherever the driver was started."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's own files to the session, once; Spark serves them to every executor."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()  # the driver's own; Spark serves the file from there while the driver lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "sluicegate.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"sluicegate/{f.relative_to(root)}")
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
