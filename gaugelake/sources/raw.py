"""Raw coverage documents as JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.operators.coverage import payload
from gaugelake.schema import CORRUPT_COLUMN, INGEST_METADATA, RAW_DOCUMENT
from gaugelake.session import ensure_checkpoint_dir
from gaugelake.sources.files import atomic_replace

_DIRECTORIES = [
    T.StructField("station_id", T.StringType()),
    T.StructField("year", T.IntegerType()),
]
RAW_PARTITIONS = ["station_id", "year"]
RAW_FILES = "*.{json,json.gz}"


def canonical_id(station: Column) -> Column:
    """Directory names may have underscores where the id has hyphens."""
    return F.replace(station, F.lit("_"), F.lit("-"))


def read_raw_coverage(spark: SparkSession, root: str, station_id: str | None = None,
                      year: int | None = None, multiline: bool = False,
                      keep_corrupt: bool = False, glob: str = RAW_FILES) -> DataFrame:
    """Documents under ``root/station_id=/year=``, of one station and year if given.

    Both document forms are accepted, and both spellings of the directory. ``multiline`` is for
    files that hold one pretty-printed document each; a file of documents line by line is split
    over tasks, unless it is compressed. ``keep_corrupt`` keeps what does not parse as text in ``_corrupt_record``.
    """
    fields = [*RAW_DOCUMENT.fields, *_DIRECTORIES]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType()))
    reader = (
        spark.read.schema(T.StructType(fields))
        .option("multiLine", multiline).option("pathGlobFilter", glob)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    docs = reader.json(root)
    # unlike input_file_name() the path as a column lets a join with a list of files prune directories
    docs = docs.withColumn("_source_file", docs.metadataColumn("_metadata")["file_path"])
    if station_id is not None:
        docs = docs.where(F.col("station_id").isin(station_id, station_id.replace("-", "_")))
    if year is not None:
        docs = docs.where(F.col("year") == year)
    return docs.withColumn("station_id", canonical_id(F.col("station_id")))


FILE_KEY = ["station_id", "year", "_source_file"]
SMALL_FILES = 100_000  # files of a table that is broadcast (some 20 MB)


def of_files(docs: DataFrame, files: DataFrame, among: bool = True) -> DataFrame:
    """The documents of some files, or of all others; ``files`` has the columns FILE_KEY.

    The directories of a table of up to SMALL_FILES files prune the scan while it runs, so files elsewhere are not opened.
    """
    wanted = files.select(*[F.col(c).alias(f"_of_{c}") for c in FILE_KEY])
    if files.limit(SMALL_FILES + 1).count() <= SMALL_FILES:
        wanted = F.broadcast(wanted)
    without = {"station_id": "", "year": -1, "_source_file": ""}  # null directories must meet, too
    same = [F.coalesce(c, F.lit(none)) == F.coalesce(f"_of_{c}", F.lit(none)) for c, none in without.items()]
    return docs.join(wanted, same, "left_semi" if among else "left_anti")


def file_outcomes(docs: DataFrame) -> DataFrame:
    """Documents that hold coverages, and lines that do not parse, of each file read with ``keep_corrupt``."""
    filled = F.col(CORRUPT_COLUMN).isNull() & payload(docs)["coverages"].isNotNull()
    return docs.groupBy(*FILE_KEY).agg(
        F.count_if(filled).alias("filled"), F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("corrupt"))


def reread_pretty_printed(docs: DataFrame, root: str, glob: str = RAW_FILES) -> DataFrame:
    """``docs``, read line by line with ``keep_corrupt``, with pretty-printed files read as a whole.

    A file counts as pretty-printed if lines of it do not parse and none holds a coverage. These files are a (checkpointed) table that is
    joined, so no path passes the driver.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    files = file_outcomes(docs).where("filled = 0 and corrupt > 0").select(*FILE_KEY, "corrupt").checkpoint()
    if files.isEmpty():
        return docs
    pretty = files.where("corrupt > 0")  # again, as Spark prunes directories by tables that are filtered
    whole = read_raw_coverage(spark, root, multiline=True, keep_corrupt=True, glob=glob)
    return of_files(docs, pretty, among=False).unionByName(of_files(whole, pretty))


def read_either_form(spark: SparkSession, root: str, station_id: str | None = None,
                     glob: str = RAW_FILES) -> DataFrame:
    """Documents with what does not parse, from files of a document per line and pretty-printed ones.

    Telling them apart reads the documents once more; ``read_raw_coverage`` reads one form.
    """
    docs = read_raw_coverage(spark, root, station_id, keep_corrupt=True, glob=glob)
    return reread_pretty_printed(docs, root, glob)


SMALL_REGISTRY = 100_000  # names of a table that is broadcast (some 10 MB)


def names_among(stations: DataFrame, ids: DataFrame) -> DataFrame:
    """station_id and _name of the stations in ``ids`` (column station_id), to be broadcast if they are up to SMALL_REGISTRY."""
    ensure_checkpoint_dir(stations.sparkSession)
    names = stations.select(F.col("id").alias("station_id"), F.col("name").alias("_name")).join(
        ids.select("station_id").distinct(), "station_id", "left_semi").checkpoint()
    return F.broadcast(names) if names.limit(SMALL_REGISTRY + 1).count() <= SMALL_REGISTRY else names


def with_metadata(split: DataFrame, stations: DataFrame | None, ingested_at: str, source_api: str,
                  collection: str, requested: int, observed: DataFrame | None = None) -> DataFrame:
    """Wrap each single-station document in an envelope that says where it came from.

    ``observed`` has the ids (column station_id) of all stations with documents, where these are known without reading the documents:
    a registry larger than them is cut to them, and then need not shuffle the documents to name their stations.
    """
    if stations is not None:
        if observed is not None:
            names = names_among(stations, observed)
        else:
            names = stations.select(F.col("id").alias("station_id"), F.col("name").alias("_name"))
        split = split.join(names, "station_id", "left")
    else:
        split = split.withColumn("_name", F.lit(None).cast("string"))
    values = {
        "ingestion_timestamp": F.lit(ingested_at),
        "station_id": F.col("station_id"),
        "station_name": F.col("_name"),
        "source_api": F.lit(source_api),
        "api_collection": F.lit(collection),
        "ingestion_method": F.lit("multi_station_batch" if requested > 1 else "single_station"),
    }
    envelope = F.struct(*[values[f.name].alias(f.name) for f in INGEST_METADATA])
    return split.select("station_id", envelope.alias("_metadata"), "data")


def first_year(data: str = "data") -> Column:
    """Year of the first time of a document, which names its directory."""
    domain = F.coalesce(F.get(F.col(f"{data}.coverages"), F.lit(0))["domain"], F.col(f"{data}.domain"))
    first = F.get(domain["axes"]["t"]["values"], F.lit(0))
    return F.year(F.try_to_timestamp(first))


def land_raw(enveloped: DataFrame, root: str, replace: bool = True, placed: bool = False) -> None:
    """Write documents line by line under ``root/station_id=/year=``, compressed.

    A station and year that occurs is replaced as a whole, or added to if ``replace`` is off. Documents are shuffled to their
    directories, unless they are ``placed``: those of a station and year come from one task, or a few if there are many.
    """
    rows = enveloped.withColumn("year", first_year())
    if not placed:
        rows = rows.hint("rebalance", *RAW_PARTITIONS)
    if replace:
        atomic_replace(rows, root, RAW_PARTITIONS, "json", compression="gzip")
    else:
        rows.write.mode("append").partitionBy(*RAW_PARTITIONS).option("compression", "gzip").json(root)


def is_bad(docs: DataFrame) -> Column:
    """Whether the JSON or one of the times of a document does not parse."""
    bad_time = F.exists(payload(docs)["coverages"], lambda c: F.exists(
        c["domain"]["axes"]["t"]["values"],
        lambda t: t.isNotNull() & F.try_to_timestamp(t).isNull()))
    return F.col(CORRUPT_COLUMN).isNotNull() | F.coalesce(bad_time, F.lit(False))


def _losses(docs: DataFrame) -> list[Column]:
    bad = is_bad(docs)
    return [F.count_if(bad).alias("bad"), F.count("*").alias("all"), F.min(F.when(bad, F.col("_source_file"))).alias("file")]


def counted(docs: DataFrame) -> tuple[DataFrame, Observation]:
    """The documents, counted on their way through the next job that reads them."""
    counts = Observation("documents")
    return docs.observe(counts, *_losses(docs)), counts


def losses(counts: Observation, docs: DataFrame) -> dict:
    """How many documents were bad, to be called after the job that read ``docs``."""
    # nothing is observed where Spark found a stage of the job to be empty and left out what follows
    observed = counts._jo.getRow().length() > 0
    return counts.get if observed else docs.agg(*_losses(docs)).first().asDict()


def refuse_losses(counts: Observation, docs: DataFrame) -> None:
    """An error if a document was bad, to be called after the job that read ``docs``."""
    found = losses(counts, docs)
    if found["bad"]:
        raise ValueError(f"{found['bad']} of {found['all']} documents do not parse, such as one in"
                         f" {found['file']}; the others are written. Name a quarantine folder to go on without them")


def isolate_bad_files(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(readable documents, quarantine, outcome per file): a bad document does not stop the others.

    A document is bad if its JSON or one of its times does not parse. One that parses but holds no
    coverages counts as empty.
    """
    members = payload(docs)["coverages"]
    bad = is_bad(docs)
    filled = members.isNotNull()
    ok, empty = F.count_if(~bad & filled), F.count_if(~bad & ~filled)
    outcome = docs.groupBy("station_id", "year", "_source_file").agg(
        ok.alias("ok_documents"), empty.alias("empty_documents"),
        # by difference: Spark refuses a scan that needs the corrupt text but no other column
        (F.count("*") - ok - empty).alias("bad_documents"))
    quarantine = docs.where(bad).select(
        "station_id", "year", "_source_file",
        F.coalesce(CORRUPT_COLUMN, F.to_json(payload(docs))).alias("document"))
    return docs.where(~bad).drop(CORRUPT_COLUMN), quarantine, outcome


def file_totals(outcome: DataFrame) -> DataFrame:
    """Files that were read in full and hold data, out of all."""
    ok = (F.col("bad_documents") == 0) & (F.col("ok_documents") > 0)
    return outcome.agg(
        F.count_if(ok).alias("ok_files"),
        F.count("*").alias("files"))
