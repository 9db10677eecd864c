"""What several operators need: tables in the shared folder, ranges of an ordered key, words as SQL."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugelake.session import shared_dir

WHITE = r"[\x20\x09-\x0D]+"  # fixed: what separates words
WORD = r"[^\x20\x09-\x0D]+"  # fixed: a word

BATCH_BYTES = 4_000_000  # of text worked on at once in a task
MAX_RANGES = 4096  # bound of what the driver holds of an ordered key


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query as it ends, rather than when the driver collects garbage.

    For queries that write a table: what follows reads the table and needs no shuffle of theirs.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Scratch:
    """Tables written to the folder all executors share, so that a lost executor costs no lineage.

    ``drop`` removes those that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = (f"{shared_dir(spark)}/gaugelake-llm/{spark.sparkContext.applicationId}/"
                     f"{name}-{uuid.uuid4().hex[:12]}")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with shuffles_end_with_query(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def range_bounds(df: DataFrame, column: str, ranges: int) -> list[int]:
    """At most ``ranges - 1`` ascending bounds that cut the values of an integer column about evenly."""
    ranges = max(1, min(ranges, MAX_RANGES))
    shares = [i / ranges for i in range(1, ranges)]
    if not shares:
        return []
    found = df.select(F.percentile_approx(column, shares, 10 * MAX_RANGES).alias("b")).first()["b"]
    return sorted({int(b) for b in found or []})


def range_of(column: str, bounds: list[int]) -> F.Column:
    """The number of bounds below the value, found by halving, so the expression has log(bounds) steps.

    Null values come first, in range 0.
    """
    def search(lo: int, hi: int) -> F.Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(column) > bounds[mid], search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds)).cast("int")


def running_before(df: DataFrame, key: str, value: str, name: str, ranges: int) -> DataFrame:
    """Add the sum of ``value`` over all rows before this one in the order of ``key``.

    The rows are cut into ranges of the key; each range is summed up on its own and starts at the total
    of the ranges before it, so no task sees more than one range (and one row per range). Rows with
    equal keys follow each other in the order of all their columns. ``df`` must give the same rows
    each time it is read (pass a written table), as the ranges and the rows are read separately.
    """
    bounds = range_bounds(df, key, ranges)
    rows = df.withColumn("_range", range_of(key, bounds))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_range").agg(F.sum(value).alias("_sum")).select(
        "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = (Window.partitionBy("_range")
              .orderBy(F.col(key).asc_nulls_first(), *[c for c in df.columns if c != key])
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(starts, "_range")
            .withColumn(name, (F.col("_start") + F.coalesce(F.sum(value).over(within), F.lit(0)))
                        .cast("long"))
            .drop("_range", "_start"))


def ranges_for(spark: SparkSession) -> int:
    """As many ranges as a shuffle has partitions."""
    return min(MAX_RANGES, max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def distinct_texts_first(texts: list) -> tuple[list, list[int]]:
    """The distinct texts of a batch, and for each text its place among them.

    Copies lie side by side in many corpora; each is worked on once per batch.
    """
    places: dict = {}
    index = [places.setdefault(t, len(places)) for t in texts]
    return list(places), index


def text_batches(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes together; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    lo, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total >= most:
            yield batch.slice(lo, i + 1 - lo)
            lo, total = i + 1, 0
    if lo < batch.num_rows:
        yield batch.slice(lo)
