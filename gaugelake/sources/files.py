"""Publishing tables as a whole and reading single partitions of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def located(spark: SparkSession, path: str):
    """The file system that a path names, and the path on it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that its scheme names."""
    file_system, target = located(spark, path)
    return file_system.exists(target)


def state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Modification time, bytes and number of files of a table: they change with its content."""
    file_system, target = located(spark, path)
    summary = file_system.getContentSummary(target)
    return (file_system.getFileStatus(target).getModificationTime(),
            summary.getLength(), summary.getFileCount())


def rebalanced(df: DataFrame, by: list[str], then: list[str] | None = None) -> DataFrame:
    """Gather the rows of each output directory for writing, and sort them within a task.

    At run time Spark splits a directory that is too large for one task and joins small ones, so a
    station with most of the rows is written by many tasks.
    """
    return df.hint("rebalance", *by).sortWithinPartitions(*by, *(then or []))


def atomic_replace(df: DataFrame, path: str, by: list[str], format: str = "parquet", **options: str) -> None:
    """Overwrite just the partitions that occur in ``df``; repeating the call changes nothing.

    For folders of raw files that others read by their path. The partitions are swapped one after the other when the job
    commits, so a reader may meanwhile see some of them old and some new; ``snapshots`` has tables without that. ``df`` must not read from
    ``path``.
    """
    (
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**options).partitionBy(*by).format(format).save(path)
    )
