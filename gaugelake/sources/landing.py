"""The landing index: what each raw file holds, found out once.

A row per file: its form (a document per line, or pretty-printed), how many documents it holds and how many of them do not parse, first and last time,
and the parameter names. Jobs that have the index parse every document once: the names of the columns come from it, the form of a file
need not be tried out, and a job for one year opens only directories with a file that reaches it. The index is a table
with versions; bringing it up to date looks at the list of files and parses only those that are new or have changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.operators.coverage import payload
from gaugelake.schema import CORRUPT_COLUMN, PAYLOAD
from gaugelake.session import ensure_checkpoint_dir
from gaugelake.sources import raw
from gaugelake.sources.snapshots import Snapshots

LINES, PRETTY = "lines", "pretty"

INDEX = T.StructType([
    T.StructField("_source_file", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("documents", T.LongType()),
    T.StructField("bad_documents", T.LongType()),
    T.StructField("first_time", T.TimestampType()),
    T.StructField("last_time", T.TimestampType()),
    T.StructField("names", T.ArrayType(T.StringType())),
    T.StructField("year", T.IntegerType()),
])


def _table(spark: SparkSession, index: str) -> Snapshots:
    return Snapshots(spark, index, ["year"], within="_source_file")


def scan(spark: SparkSession, index: str) -> DataFrame:
    return _table(spark, index).read(INDEX)


def list_files(spark: SparkSession, root: str, glob: str = raw.RAW_FILES) -> DataFrame:
    """The files under ``root`` with their length and time of change; none is opened. Empty ones are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    path = F.col("_metadata.file_path")

    def directory(name: str) -> Column:
        value = F.regexp_extract(path, f"/{name}=([^/]*)/", 1)
        return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))

    return files.select(path.alias("_source_file"), "length", F.col("modificationTime").alias("modified"),
                        raw.canonical_id(directory("station_id")).alias("station_id"), directory("year").cast("int").alias("year"))


def _described(docs: DataFrame, form: str) -> DataFrame:
    """A row per file of documents read with ``keep_corrupt``."""
    held = payload(docs)["coverages"]
    members = F.coalesce(held, F.array().cast(PAYLOAD["coverages"].dataType))
    times = F.flatten(F.transform(members, lambda c: c["domain"]["axes"]["t"]["values"]))
    names = F.array_distinct(F.flatten(F.transform(members, lambda c: F.map_keys(c["ranges"]))))
    parsed = F.transform(F.filter(times, lambda t: t.isNotNull()), lambda t: F.try_to_timestamp(t))
    each = docs.select(*raw.FILE_KEY, CORRUPT_COLUMN, raw.is_bad(docs).alias("_bad"), F.array_min(parsed).alias("_first"),
                       F.array_max(parsed).alias("_last"), names.alias("_names"), held.isNotNull().alias("_filled"))
    return each.groupBy(*raw.FILE_KEY).agg(
        F.count("*").alias("documents"), F.count_if("_bad").alias("bad_documents"),
        F.count_if(F.col("_filled") & F.col(CORRUPT_COLUMN).isNull()).alias("_filled"),
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("_corrupt"),
        F.min("_first").alias("first_time"), F.max("_last").alias("last_time"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_names")))).alias("names"),
    ).withColumn("form", F.lit(form))


def update(spark: SparkSession, root: str, index: str, glob: str = raw.RAW_FILES) -> int:
    """Take in the files that are new or have changed; gives how many there were."""
    ensure_checkpoint_dir(spark)
    listed = list_files(spark, root, glob)
    known = scan(spark, index).select(*[F.col(c).alias(f"_known_{c}") for c in ("_source_file", "length", "modified")])
    same = [F.col(c) == F.col(f"_known_{c}") for c in ("_source_file", "length", "modified")]
    fresh = listed.join(known, same, "left_anti").checkpoint()
    n = fresh.count()
    if not n:
        return 0
    chosen = fresh.where(F.col("length") >= 0)
    lines = _described(raw.of_files(raw.read_raw_coverage(spark, root, keep_corrupt=True, glob=glob), chosen), LINES).checkpoint()
    pretty = lines.where("_filled = 0 and _corrupt > 0")
    found = lines.where("not (_filled = 0 and _corrupt > 0)")
    if not pretty.isEmpty():
        whole = raw.read_raw_coverage(spark, root, multiline=True, keep_corrupt=True, glob=glob)
        found = found.unionByName(_described(raw.of_files(whole, pretty), PRETTY))
    # a file of blank lines has no documents, and is listed all the same
    entries = chosen.join(found.drop("_filled", "_corrupt"), raw.FILE_KEY, "left").fillna(
        {"documents": 0, "bad_documents": 0, "form": LINES})
    table = _table(spark, index)
    table.replace_values(entries.select(*INDEX.names).coalesce(8), arranged=lambda df: df.hint("rebalance", "year"))
    table.compact(INDEX, lambda df: df.hint("rebalance", "year"))
    return n


def parameter_names(files: DataFrame) -> list[str]:
    """The vocabulary of indexed files; a few dozen names whatever their number."""
    return sorted(row[0] for row in files.select(F.explode("names")).distinct().collect())


def reaching(files: DataFrame, station_id: str | None = None, year: int | None = None) -> DataFrame:
    """The files of a station, and those with a time in a year."""
    if station_id is not None:
        files = files.where(F.col("station_id") == station_id)
    if year is not None:
        # a document lies under the year it starts in
        files = files.where((F.col("year") <= year) & (F.year("first_time") <= year) & (F.year("last_time") >= year))
    return files


def read(spark: SparkSession, root: str, files: DataFrame, glob: str = raw.RAW_FILES) -> DataFrame:
    """The documents of indexed files, with what does not parse, each in its form."""
    lines = raw.of_files(raw.read_raw_coverage(spark, root, keep_corrupt=True, glob=glob), files.where(F.col("form") == LINES))
    pretty = files.where(F.col("form") == PRETTY)
    if pretty.isEmpty():
        return lines
    whole = raw.read_raw_coverage(spark, root, multiline=True, keep_corrupt=True, glob=glob)
    return lines.unionByName(raw.of_files(whole, pretty))


def totals(files: DataFrame) -> DataFrame:
    """Files that were read in full and hold data, out of all."""
    ok = (F.col("bad_documents") == 0) & (F.size("names") > 0)
    return files.agg(F.count_if(ok).alias("ok_files"), F.count("*").alias("files"))
