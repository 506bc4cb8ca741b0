"""Make this package importable in the Python workers of every executor."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package once per application, as a zip file that Spark hands to its workers."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    base = Path(tempfile.mkdtemp(prefix="cohortscope-code-")) / package.name
    archive = shutil.make_archive(str(base), "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
