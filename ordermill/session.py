"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ordermill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and a disk-backed state store."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # plans are built faster
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as ``spark.checkpoint.dir`` names it.

    Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="ordermill-")
    context.setCheckpointDir(own)
    return context.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, so that several readers do not repeat its scan."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def ship_package(spark: SparkSession) -> None:
    """Send this package to Python workers that do not have it on their path, once per Spark application."""
    context = spark.sparkContext
    if getattr(context, "_ordermill_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="ordermill-"), "ordermill.zip")  # on the driver alone, from where Spark serves it
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w") as held:
        for file in sorted(package.rglob("*.py")):
            held.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._ordermill_shipped = True
