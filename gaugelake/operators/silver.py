"""Refined rows -> validated silver rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.functions import fixed_point, quality
from gaugelake.schema import (
    MAPPED_COLUMNS,
    MAX_MISSING_PCT,
    MAX_OUTLIER_PCT,
    MIN_QUALITY_SCORE,
    SILVER,
    SILVER_DECLARED,
    SILVER_MAPPING,
    SILVER_VERSION,
)

# time first: the first column leads the sort, and the ids of stations begin alike
KEY = ["timestamp", "station_id"]


def _as(column, source: T.DataType, target: T.DataType):
    """Lenient cast; NaN counts as no value, also where it comes as text."""
    if isinstance(source, (T.DoubleType, T.FloatType)):
        column = F.when(~F.isnan(column), column)
    if source == target:
        return column
    column = column.try_cast(target)
    return F.when(~F.isnan(column), column) if isinstance(target, T.DoubleType) else column


def map_silver_schema(refined: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rename the 21 mapped columns; an absent one is null and an unmapped one is dropped.

    ``keep`` passes further columns through, such as those that order the rows for ``dedup_first``.
    """
    present = {f.name: f.dataType for f in refined.schema}
    out = []
    for code, name in SILVER_MAPPING.items():
        target = SILVER[name].dataType
        column = (_as(F.col(f"`{code}`"), present[code], target) if code in present
                  else F.lit(None).cast(target))
        out.append(column.alias(name))
    return refined.select(*out, *[F.col(f"`{c}`") for c in keep or []])


def enforce_types(df: DataFrame) -> DataFrame:
    """The declared 22 columns with their types; a value that does not convert becomes null."""
    present = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        (_as(F.col(f.name), present[f.name], f.dataType) if f.name in present
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in SILVER_DECLARED
    ])


def flag_missing(df: DataFrame, columns: list[str] = MAPPED_COLUMNS) -> DataFrame:
    return df.withColumn("has_missing_values", quality.any_missing(columns))


def flag_outliers(df: DataFrame, sentinel_first: bool = False) -> DataFrame:
    return df.withColumn("has_outliers", quality.any_outlier(sentinel_first))


def quality_flags(df: DataFrame, sentinel_first: bool = False) -> DataFrame:
    return df.withColumn("quality_flags", quality.flag_text(sentinel_first))


def outlier_flags(df: DataFrame, sentinel_first: bool = False) -> DataFrame:
    """The flags as an array of column names."""
    return df.withColumn("outlier_flags", quality.flag_array(sentinel_first))


def quality_score(df: DataFrame, sentinel_first: bool = False,
                  missing_columns: list[str] = MAPPED_COLUMNS) -> DataFrame:
    return df.withColumn("quality_score", quality.score(sentinel_first, missing_columns))


def rain_sentinel(df: DataFrame) -> DataFrame:
    return df.withColumn("rainfall_mm", quality.without_trace(F.col("rainfall_mm")))


def apply_quality(df: DataFrame, sentinel_first: bool = False) -> DataFrame:
    """All quality columns, then trace rain as 0.

    By default trace rain (-1) is checked before it becomes 0, so it counts as an outlier;
    ``sentinel_first`` checks the cleaned value instead.
    """
    checked = df.select(
        "*",
        quality.score(sentinel_first).alias("quality_score"),
        quality.flag_text(sentinel_first).alias("quality_flags"),
        quality.any_missing().alias("has_missing_values"),
        quality.any_outlier(sentinel_first).alias("has_outliers"),
    )
    return rain_sentinel(checked)


def dedup_first(df: DataFrame, order_by: list[str], key: list[str] = KEY) -> DataFrame:
    """Keep the first row of each (station, time) in the given order.

    Spark limits each group to one row before the shuffle as well as after it, so a key with very
    many copies costs no more than one row per map task. ``order_by`` must tell rows with unlike
    values apart.
    """
    first = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


_BUCKETS = 4096
_CROWD = 1_000_000  # rows that a task can sort


def thin_crowds(df: DataFrame, order_by: list[str], key: list[str] = KEY) -> DataFrame:
    """``df`` without most copies of keys that have a crowd of them: rows that ``dedup_first`` would drop anyway.

    For plans that gather the copies of a key in one task. Keys are counted by 4,096 buckets, so the count
    shuffles next to nothing, and without a crowded bucket ``df`` comes back as it is.
    """
    bucket = F.pmod(F.xxhash64(*key), F.lit(_BUCKETS))
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()
    most = max(_CROWD, 8 * sum(row["n"] for row in counts) // _BUCKETS)
    crowded = [row["bucket"] for row in counts if row["n"] > most]
    if not crowded:
        return df
    return df.where(~bucket.isin(crowded)).unionByName(dedup_first(df.where(bucket.isin(crowded)), order_by, key))


def stamp_silver(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("_processed_timestamp", F.current_timestamp())
        .withColumn("_bronze_to_silver_version", F.lit(SILVER_VERSION))
    )


def sort_time(df: DataFrame) -> DataFrame:
    """Order each output file by time; no global sort."""
    return df.sortWithinPartitions("timestamp")


def to_silver(refined: DataFrame, order_by: list[str], sentinel_first: bool = False,
              stamped: bool = True, placed: Callable[[DataFrame], DataFrame] | None = None,
              key: list[str] = KEY) -> DataFrame:
    """The whole refined -> silver step.

    Rows are deduplicated before they are scored. The result is the same, as the score looks at
    one row at a time, but the shuffle then carries the mapped columns only.

    ``placed`` deals the mapped rows as they are to be written, by ``key`` (that of a row, and columns that follow from it, which stay), so that one
    shuffle and one sort serve both.
    """
    mapped = map_silver_schema(refined, keep=order_by)
    if placed is not None:
        mapped = placed(thin_crowds(mapped, order_by))
    unique = dedup_first(mapped, order_by, key)
    follows = [c for c in key if c not in MAPPED_COLUMNS]
    checked = apply_quality(unique.select(*MAPPED_COLUMNS, *follows), sentinel_first)
    return stamp_silver(checked) if stamped else checked


def quality_report(refined: DataFrame, silver: DataFrame, by: str = "station_id",
                   refined_by: str = "location_id") -> DataFrame:
    """Per station: rows, duplicates removed, mean quality, percentage missing and of outliers."""
    before = refined.groupBy(F.col(refined_by).alias("_batch")).agg(F.count("*").alias("rows_in"))
    after = silver.groupBy(F.col(by).alias("_batch_out")).agg(
        F.count("*").alias("rows_out"),
        fixed_point.mean("quality_score", 2).alias("avg_quality"),
        fixed_point.percent("count_if(has_missing_values)", "count(*)").alias("missing_pct"),
        fixed_point.percent("count_if(has_outliers)", "count(*)").alias("outlier_pct"),
    )
    # per-station rows on both sides; a null station must still match itself
    return before.join(after, F.col("_batch").eqNullSafe(F.col("_batch_out"))).select(
        F.col("_batch").alias(by), "rows_in", "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("duplicates_removed"),
        "avg_quality", "missing_pct", "outlier_pct",
    )


def quality_totals(report: DataFrame) -> DataFrame:
    """Totals over the rows of ``quality_report``."""
    return report.agg(
        F.count("*").alias("batches"),
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_out").alias("rows_out"),
        F.sum("duplicates_removed").alias("duplicates_removed"),
    )


def split_by_quality(silver: DataFrame, min_score: float = MIN_QUALITY_SCORE
                     ) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows for the quarantine)."""
    good = is_good(min_score)
    return silver.where(good), silver.where(~good)


def is_good(min_score: float = MIN_QUALITY_SCORE) -> Column:
    """Whether a row has the least score; one without a score does not."""
    return F.coalesce(F.col("quality_score") >= F.lit(min_score), F.lit(False))


def quality_gate(silver: DataFrame, min_score: float = MIN_QUALITY_SCORE,
                 max_outlier_pct: float = MAX_OUTLIER_PCT,
                 max_missing_pct: float = MAX_MISSING_PCT) -> DataFrame:
    """Per station: rows above and below the least score, and whether the percentages pass."""
    rows = F.count("*")
    outliers = F.count_if("has_outliers")
    missing = F.count_if("has_missing_values")
    good = F.count_if(F.col("quality_score") >= F.lit(min_score))
    return silver.groupBy("station_id").agg(
        rows.alias("total_rows"),
        good.alias("good_rows"),
        (rows - good).alias("quarantined_rows"),
        fixed_point.percent("count_if(has_outliers)", "count(*)").alias("outlier_pct"),
        fixed_point.percent("count_if(has_missing_values)", "count(*)").alias("missing_pct"),
        # compared as products: the rounded percentages could hide a breach
        ((outliers * 100 <= rows * F.lit(max_outlier_pct))
         & (missing * 100 <= rows * F.lit(max_missing_pct))).alias("passed"),
    )
