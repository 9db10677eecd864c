"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


LOCAL_MEMORY = "8g"  # a local session computes in the driver process


def get_session(app_name: str = "gaugelake", master: str | None = None,
                shuffle_partitions: int | None = None, shared: str | None = None) -> SparkSession:
    """A session for scripts and tests; on a cluster submit with its own settings instead."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
        builder = builder.master(master).config("spark.driver.memory", LOCAL_MEMORY)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # shuffle files go when their query has ended, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Every observation time is UTC, so calendar functions must work in UTC too; and jobs one after the other share a disk."""
    # a task per directory, as many as there are, would take longer to start than to list it
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism)}
    for key, value in {**_SETTINGS, **listing}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")  # one machine, such as in tests


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without replacing a folder already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) + "/checkpoints")


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would.

    Spark fetches the archive from the driver, which keeps it until it ends.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix="gaugelake-code-")
    packed = f"{folder.name}/{root.name}.zip"
    with zipfile.ZipFile(packed, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(packed)
