"""The package's code on the executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to Python workers that do not have it on their path, once per Spark application.

    Where the session leaves Arrow batches at Spark's number of rows, they are made smaller: rows hold whole texts.
    """
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    context = spark.sparkContext
    if getattr(context, "_ordermill_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ordermill-"), "ordermill.zip")  # on the driver alone, from where Spark serves it
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w") as held:
        for file in sorted(package.rglob("*.py")):
            held.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._ordermill_shipped = True
