"""Tables written once per session and set of inputs, in the shared folder."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugelake import derive
from gaugelake.operators import coverage, silver
from gaugelake.plans import jobs, summaries
from gaugelake.session import configure, shared_dir
from gaugelake.sources import files, raw, tables

INPUTS = ["lineitem", "orders", "customer", "nation", "region"]

_lock = threading.RLock()
_open: dict[str, "Workspace"] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Changes with any of the input tables."""
    states = [(name, files.state(spark, f"{sf_dir}/{name}.parquet")) for name in INPUTS]
    return hashlib.sha256(repr((sf_dir, states)).encode()).hexdigest()[:16]


class Workspace:
    """The derived inputs of one directory of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self.spark, self.sf_dir, self.root = spark, sf_dir, root
        self._done: set[str] = set()

    def table(self, name: str) -> DataFrame:
        return derive.table(self.spark, self.sf_dir, name)

    def written(self, name: str, write: Callable[[str], object]) -> str:
        """Path of a table that is written at the first call; ``write`` gets the path."""
        path = f"{self.root}/{name}"
        with _lock:
            if name not in self._done:
                write(path)
                self._done.add(name)
        return path

    @cached_property
    def observations(self) -> DataFrame:
        return derive.observations(self.table("lineitem"))

    @cached_property
    def mapped(self) -> DataFrame:
        """Silver columns before any check, with the columns that order the copies of an hour."""
        return silver.map_silver_schema(self.observations, keep=derive.LINE_ORDER)

    @cached_property
    def stations(self) -> DataFrame:
        return derive.stations(self.table("customer"), self.table("nation"), self.table("region"))

    @property
    def observed(self) -> DataFrame:
        """The stations with observations, from one column of the line items."""
        return self.observations.select(F.col("location_id").alias("station_id"))

    @cached_property
    def loads(self) -> DataFrame:
        return derive.loads(self.table("orders"), self.table("customer"))

    @cached_property
    def silver(self) -> DataFrame:
        """The silver table the analytical queries read: a directory per year, clustered by station and time."""
        return tables.scan_silver(self.spark, self.silver_path)

    @cached_property
    def silver_path(self) -> str:
        return self.written("silver", lambda p: tables.write_silver(
            tables.silver_to_write(self.observations, derive.LINE_ORDER), p, placed=True))

    @cached_property
    def gold_path(self) -> str:
        return self.written("gold", lambda p: summaries.build(self.spark, self.silver_path, p))

    def gold(self, name: str) -> DataFrame:
        """A stored summary table."""
        return summaries.scan(self.spark, self.gold_path, name)

    @cached_property
    def raw_root(self) -> str:
        def land(path: str) -> None:
            split = coverage.split_coverages(derive.responses(self.observations))
            raw.land_raw(raw.with_metadata(
                split, self.stations, derive.INGESTED_AT, derive.SOURCE_API, derive.COLLECTION,
                requested=10, observed=self.observed), path, placed=True)
        return self.written("raw", land)

    @cached_property
    def raw(self) -> DataFrame:
        return raw.read_raw_coverage(self.spark, self.raw_root)

    @cached_property
    def refined_path(self) -> str:
        return self.written("refined", lambda p: jobs.refine(
            self.spark, self.raw_root, p, multiline=False))

    @cached_property
    def refined(self) -> DataFrame:
        return tables.scan_refined(self.spark, self.refined_path, derive.PARAMETERS)


def open_workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    configure(spark)
    sf_dir = sf_dir.rstrip("/")
    root = (f"{shared_dir(spark)}/gaugelake/{spark.sparkContext.applicationId}/"
            f"{_fingerprint(spark, sf_dir)}")
    with _lock:
        if root not in _open:
            _open[root] = Workspace(spark, sf_dir, root)
        return _open[root]
