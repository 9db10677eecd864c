"""Incremental load: new raw files -> new silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.operators import coverage, silver
from gaugelake.plans import summaries
from gaugelake.plans.jobs import REFINED_ORDER, SILVER_CODES
from gaugelake.schema import CORRUPT_COLUMN, RAW_DOCUMENT
from gaugelake.session import configure
from gaugelake.sources import raw, tables
from gaugelake.sources.snapshots import Snapshots


MOST_FILES = raw.SMALL_FILES  # of a batch; each batch costs some passes over lists of files and versions


def stream_raw(spark: SparkSession, root: str, multiline: bool = False,
               max_files: int | None = None) -> DataFrame:
    """Raw documents as a stream of new files under ``root``."""
    schema = T.StructType([
        *RAW_DOCUMENT.fields,
        T.StructField("station_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField(CORRUPT_COLUMN, T.StringType()),
    ])
    reader = (
        spark.readStream.schema(schema).option("multiLine", multiline)
        .option("pathGlobFilter", raw.RAW_FILES)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    docs = reader.json(root)
    return docs.withColumn("_source_file", docs.metadataColumn("_metadata")["file_path"]).withColumn(
        "station_id", raw.canonical_id(F.col("station_id")))


def refined_rows(docs: DataFrame) -> DataFrame:
    return coverage.add_lineage(
        coverage.flatten_wide(docs.drop("station_id", "year"), SILVER_CODES))


KEEP = ("first", "last")


def _same_key(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, list[Column]]:
    """The keys of ``rows`` under other names, and the null-safe condition that joins on them."""
    named = rows.select(*[F.col(k).alias(f"_{k}") for k in keys])
    return named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]


def upsert(batch: DataFrame, path: str, layout: list[str] = tables.BY_YEAR, keep: str = "first") -> list[str | None]:
    """Bring silver rows, one per (station, time), into the table; gives the days of the batch (ISO, null for rows without a time).

    ``first``: the row that the table has of an hour stays, and only rows of other hours are added, so no stored
    file is replaced. ``last``: the row of the batch counts, so a correction arrives; what the table has of the touched stations is merged
    with the batch and replaced, directory by directory. In both cases the batch is written beside the table before it is looked at,
    readers see all of the change or none, and repeating a batch changes nothing.
    """
    if keep not in KEEP:
        raise ValueError(f"keep is one of {KEEP}")
    table = tables.stored(batch.sparkSession, path, layout)
    base = table.version()
    return _publish(table, table.stage(tables.clustered(batch, layout)), base, layout, keep)


def _publish(table: Snapshots, commit: str, base: int, layout: list[str], keep: str) -> list[str | None]:
    """The second part of ``upsert``, for a batch that is staged beside version ``base`` of the table."""
    schema = tables.silver_schema(layout)
    new = table.staged(commit, schema)
    days = [row[0] for row in new.select(F.to_date("timestamp").cast("string")).distinct().collect()]
    if not base:
        table.add(commit, base)
        return days
    parts = list(dict.fromkeys(["station_id", *layout]))
    old = _of_touched(_directories_of(new, table.read(schema), layout), new, parts)
    if keep == "first":
        hours, at_hours = _same_key(old, silver.KEY)
        table.append(tables.clustered(new.join(hours, at_hours, "left_anti"), layout), base)
    else:
        hours, at_hours = _same_key(new, silver.KEY)
        merged = tables.clustered(old.join(hours, at_hours, "left_anti").unionByName(new), layout)
        if table.within is None:
            table.replace(merged, base)
        else:
            table.replace_values(merged, base, lambda df: tables.clustered(df, layout))
    table.discard(commit)
    return days


def _of_touched(old: DataFrame, new: DataFrame, parts: list[str]) -> DataFrame:
    """The rows of ``old`` in the directories and stations of ``new``.

    These are counted first: where they are few, the rest of the table is passed over as it is read, and only what is to be merged is shuffled.
    """
    found = new.select(*parts).distinct()
    few = found.limit(raw.SMALL_FILES + 1).count() <= raw.SMALL_FILES
    touched, at_touched = _same_key(found, parts)
    return old.join(F.broadcast(touched) if few else touched, at_touched, "left_semi")


def _directories_of(new: DataFrame, old: DataFrame, layout: list[str]) -> DataFrame:
    """The rows of ``old`` in the years of ``new``, as plain values that prune the scan."""
    years = [row[0] for row in new.select("year").distinct().collect()] if "year" in layout else []
    if not years:
        return old
    some = [y for y in years if y is not None]
    return old.where(F.col("year").isin(some) | (F.col("year").isNull() if None in years else F.lit(False)))


def insert_new(batch: DataFrame, path: str, layout: list[str] = tables.BY_YEAR) -> None:
    """Add the silver rows whose (station, time) the table does not hold yet."""
    upsert(batch, path, layout, "first")


def incremental_load(spark: SparkSession, raw_root: str, silver_path: str, checkpoint: str,
                     sentinel_first: bool = False, layout: list[str] = tables.BY_YEAR,
                     multiline: bool | None = None, max_files: int | None = MOST_FILES,
                     order_by: list[str] = REFINED_ORDER, quarantine: str | None = None,
                     keep: str = "first", gold_path: str | None = None) -> None:
    """Process the raw files that came since the last call, in batches of ``max_files``, then stop.

    ``order_by`` decides between copies of an hour within one batch, ``keep`` between a batch and the table: with ``first`` a file that
    repeats hours already loaded, such as one that looks back over the last two days, changes nothing for them; with ``last``
    it corrects them. The days of a batch are brought up to date in the summary tables at ``gold_path``, if given. The checkpoint
    remembers the files seen. Both forms of files are read, unless ``multiline`` says which one
    they have. Documents that do not parse are written to ``quarantine``, a directory per batch; if it
    is not given they are an error that names a file, and every later call meets the same batch first: nothing behind it loads
    until the file is mended, taken away or a quarantine is named.
    """
    configure(spark)

    if keep not in KEEP:
        raise ValueError(f"keep is one of {KEEP}")
    table = tables.stored(spark, silver_path, layout)

    def staged(docs: DataFrame) -> str:
        good, _, _ = raw.isolate_bad_files(docs)
        return table.stage(tables.clustered(silver.to_silver(refined_rows(good), order_by, sentinel_first), layout))

    def load(read: DataFrame, batch_id: int) -> None:
        base = table.version()
        docs, counts = raw.counted(read)
        commit = staged(docs)
        # pretty-printed files are looked for only where something did not parse line by line
        if multiline is None and raw.losses(counts, docs)["bad"]:
            either = raw.reread_pretty_printed(read, raw_root)
            if either is not read:
                table.discard(commit)
                docs, counts = raw.counted(either)
                commit = staged(docs)
        if quarantine is not None:
            raw.isolate_bad_files(docs)[1].write.mode("overwrite").json(f"{quarantine}/batch={batch_id}")
        days = _publish(table, commit, base, layout, keep)
        if gold_path is not None:
            summaries.refresh(spark, silver_path, gold_path, days, layout)
        if quarantine is None:
            raw.refuse_losses(counts, docs)

    query = (
        stream_raw(spark, raw_root, bool(multiline), max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def compact(spark: SparkSession, path: str, layout: list[str] = tables.BY_YEAR, most_layers: int = 1) -> None:
    """Rewrite the directories that loads have added to, or replaced parts of, more than ``most_layers`` times."""
    tables.stored(spark, path, layout).compact(
        tables.silver_schema(layout), lambda df: tables.clustered(df, layout), most_layers)
