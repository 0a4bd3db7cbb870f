"""Sends this library to the Python workers of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_MARK = "spark.coverlens.shipped"


def ship(spark: SparkSession) -> SparkSession:
    """Have every worker find the library, once a session; Spark copies the archive to the executors."""
    if spark.conf.get(_MARK, None) != spark.sparkContext.applicationId:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="library-")) / "coverlens.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        spark.conf.set(_MARK, spark.sparkContext.applicationId)
    return spark
