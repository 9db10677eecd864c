"""Tables as versions: files that never change, and lists of them that are published in one step.

    PATH/data/commit=ID/year=2024/part-....parquet     written by one job, never touched again
    PATH/versions/000000000012.json                    what the table is made of, from this version on

A version names *layers*: a commit, one of its directories, and the values of one column (``within``, such as the station or the
day) that later layers of the directory hold in its place. So a part as small as one station of a year, or one day, can be replaced while the
files hold many of them. A version file is written under another name and renamed; the rename fails if the
number is taken. A reader sees the last version whose file is there: all of a change or nothing of it, and it goes on reading
the files of its own version while later ones are published. A job that is cut off leaves files that no version names.

What passes the driver is a version: directories, and replaced values up to MOST_VALUES at a time; where a change touches more, the directories
are rewritten as a whole.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugelake.sources.files import located

ROUTE = "_route"  # directory between commit and part, where the rows of a job go to several tables
MOST_VALUES = 10_000
MOST_LAYERS = 8
ATTEMPTS = 20

Change = Callable[[list["Layer"]], list["Layer"]]


class Layer(NamedTuple):
    commit: str  # or a directory of it, where one job has written the files of several tables
    part: str  # directory below the commit, such as station_id=a/year=2024
    hidden: tuple[str | None, ...] = ()

    def without(self, values: list[str | None]) -> "Layer":
        return self._replace(hidden=tuple(sorted({*self.hidden, *values}, key=lambda v: (v is None, v or ""))))


class ConcurrentChange(Exception):
    """Another job has published a version that this change does not know."""


def _outside(column: str, kind: T.DataType, values: tuple[str | None, ...]) -> Column:
    """Whether a value is none of these; null is a value like others.

    There may be thousands, in each of many layers, so they go to Spark as one text; only those that would need escapes go one by one.
    """
    given = [v for v in values if v is not None]
    odd = [v for v in given if "'" in v or "\\" in v]
    plain = sorted({*given}.difference(odd))
    inside = F.col(column).isin([F.lit(v).cast(kind) for v in odd]) if odd else F.lit(False)
    if plain:
        quoted = (f"'{v}'" if isinstance(kind, T.StringType) else f"CAST('{v}' AS {kind.simpleString()})" for v in plain)
        inside = inside | F.expr(f"`{column}` IN ({', '.join(quoted)})")
    return ~F.coalesce(inside, F.lit(None in values))


class Snapshots:
    """A table with directories ``by``; single values of ``within`` can be replaced inside them.

    Tables of several ``branch`` names can share a path: each has versions of its own.
    """

    def __init__(self, spark: SparkSession, path: str, by: list[str], within: str | None = None, branch: str = ""):
        self.spark, self.path, self.by, self.within = spark, path.rstrip("/"), by, within
        self._folder = f"versions-{branch}" if branch else "versions"

    # --- versions ---------------------------------------------------------------

    def _names(self, folder: str) -> list[str]:
        file_system, target = located(self.spark, f"{self.path}/{folder}")
        if not file_system.exists(target):
            return []
        return sorted(status.getPath().getName() for status in file_system.listStatus(target))

    def versions(self) -> list[int]:
        names = (re.fullmatch(r"(\d+)\.json", name) for name in self._names(self._folder))
        return [int(name[1]) for name in names if name]

    def version(self) -> int:
        """The last published version, 0 if there is none."""
        return max(self.versions(), default=0)

    def layers(self, version: int | None = None) -> list[Layer]:
        version = self.version() if version is None else version
        if not version:
            return []
        file_system, target = located(self.spark, self._version_file(version))
        stream = file_system.open(target)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Layer(x["commit"], x["part"], tuple(x["hidden"])) for x in json.loads(text)]

    def _version_file(self, version: int) -> str:
        return f"{self.path}/{self._folder}/{version:012d}.json"

    def _put(self, version: int, layers: list[Layer]) -> bool:
        """Publish a version; False if its number is taken."""
        jvm = self.spark._jvm
        file_system, target = located(self.spark, self._version_file(version))
        _, draft = located(self.spark, f"{self.path}/{self._folder}/.{uuid.uuid4().hex}")
        stream = file_system.create(draft, False)
        try:
            stream.write(bytearray(json.dumps([layer._asdict() for layer in layers]), "utf-8"))
        finally:
            stream.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            file_system.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, target, options)
        except Exception:
            file_system.delete(draft, False)
            if file_system.exists(target):
                return False
            raise
        return True

    def _publish(self, change: Change, base: int | None = None) -> int:
        """Publish what ``change`` makes of the layers; an error if ``base`` is given and no longer the last version."""
        for _ in range(ATTEMPTS):
            now = self.version()
            if base is not None and now != base:
                raise ConcurrentChange(f"{self.path}: version {base} was read, {now} is published")
            if self._put(now + 1, change(self.layers(now))):
                return now + 1
        raise ConcurrentChange(f"{self.path}: no version could be published in {ATTEMPTS} attempts")

    # --- reading ----------------------------------------------------------------

    def read(self, schema: T.StructType, version: int | None = None) -> DataFrame:
        """The table as of a version, the last one if not given; ``schema`` has the directory columns, too."""
        return self._frame(self.layers(version), schema)

    def _frame(self, layers: list[Layer], schema: T.StructType) -> DataFrame:
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
        alike: dict[tuple, list[str]] = {}
        for layer in layers:
            folder = f"{self.path}/data/commit={layer.commit}/{layer.part}".rstrip("/")
            alike.setdefault(layer.hidden, []).append(folder)
        frames = []
        for hidden, folders in alike.items():
            frame = reader.parquet(*folders).drop("commit", ROUTE)
            frames.append(frame.where(_outside(self.within, schema[self.within].dataType, hidden)) if hidden else frame)
        if not frames:
            stored = [f for f in schema if f.name not in self.by]
            return self.spark.createDataFrame([], T.StructType([*stored, *(schema[c] for c in self.by)]))
        return reduce(DataFrame.unionByName, frames)

    # --- writing ----------------------------------------------------------------

    def stage(self, df: DataFrame) -> str:
        """Write the files of a commit that no version names yet; rows with a column ROUTE go to a directory per route."""
        commit = f"c{uuid.uuid4().hex[:20]}"
        directories = [*([ROUTE] if ROUTE in df.columns else []), *self.by]
        writer = df.write.partitionBy(*directories) if directories else df.write
        writer.parquet(f"{self.path}/data/commit={commit}")
        return commit

    def replace_staged(self, commit: str, parts: list[str] | None = None) -> int:
        """Replace the directories of a staged commit, or these, as a whole; those it does not hold become empty."""
        own = self._parts(commit)
        gone = own if parts is None else [*own, *parts]
        return self._publish(lambda layers: [
            *(layer for layer in layers if layer.part not in gone), *(Layer(commit, part) for part in own)])

    def staged(self, commit: str, schema: T.StructType) -> DataFrame:
        return self._frame([Layer(commit, part) for part in self._parts(commit)], schema)

    def discard(self, commit: str) -> None:
        file_system, target = located(self.spark, f"{self.path}/data/commit={commit}")
        file_system.delete(target, True)

    def _parts(self, commit: str) -> list[str]:
        parts = [""]
        for _ in self.by:
            parts = [f"{part}/{name}".strip("/") for part in parts
                     for name in self._names(f"data/commit={commit}/{part}") if "=" in name]
        return parts

    def replace(self, df: DataFrame, base: int | None = None) -> int:
        """Replace the directories that occur in ``df`` as a whole."""
        commit = self.stage(df)
        parts = self._parts(commit)
        return self._publish(lambda layers: [
            *(layer for layer in layers if layer.part not in parts), *(Layer(commit, part) for part in parts)], base)

    def overwrite(self, df: DataFrame) -> int:
        """Replace the whole table."""
        commit = self.stage(df)
        return self._publish(lambda layers: [Layer(commit, part) for part in self._parts(commit)])

    def append(self, df: DataFrame, base: int | None = None) -> int:
        return self.add(self.stage(df), base)

    def add(self, commit: str, base: int | None = None) -> int:
        """Publish a staged commit beside what is there."""
        return self._publish(lambda layers: [*layers, *(Layer(commit, part) for part in self._parts(commit))], base)

    def replace_values(self, df: DataFrame, base: int | None = None,
                       arranged: Callable[[DataFrame], DataFrame] = lambda df: df,
                       emptied: list[str | None] = ()) -> int:
        """Replace, in each directory, the values of ``within`` that occur in ``df``, and those ``emptied`` in all directories.

        ``arranged`` lays out rows for writing, where whole directories have to be rewritten.
        """
        base = self.version() if base is None else base
        commit = self.stage(df)
        schema = T.StructType([*[f for f in df.schema if f.name not in self.by], *[df.schema[c] for c in self.by]])
        parts = {part: self._frame([Layer(commit, part)], schema) for part in self._parts(commit)}
        found = {part: rows.select(F.col(self.within).cast("string")).distinct().limit(MOST_VALUES + 1)
                 for part, rows in parts.items()}
        values = {part: [row[0] for row in rows.collect()] for part, rows in found.items()}
        few = {part: v for part, v in values.items() if len(v) <= MOST_VALUES}
        if len(few) < len(values):
            return self._rewrite(commit, parts, schema, base, arranged, emptied)

        return self._publish(lambda layers: [
            *(layer.without([*few.get(layer.part, ()), *emptied]) for layer in layers), *(Layer(commit, part) for part in few)], base)

    def _rewrite(self, commit: str, parts: dict[str, DataFrame], schema: T.StructType, base: int,
                 arranged: Callable[[DataFrame], DataFrame], emptied: list[str | None]) -> int:
        """As ``replace_values`` for more values than a version should name: the directories are written as a whole."""
        kept = []
        for part, rows in parts.items():
            old = self._frame([layer.without(emptied) for layer in self.layers(base) if layer.part == part], schema)
            gone = rows.select(F.col(self.within).alias("_gone")).distinct()
            kept += [old.join(gone, F.col(self.within).eqNullSafe(F.col("_gone")), "left_anti"), rows]
        whole = self.stage(arranged(reduce(DataFrame.unionByName, kept)))
        version = self._publish(lambda layers: [
            *(layer.without(emptied) for layer in layers if layer.part not in parts),
            *(Layer(whole, part) for part in self._parts(whole))], base)
        self.discard(commit)
        return version

    def compact(self, schema: T.StructType, arranged: Callable[[DataFrame], DataFrame], most_layers: int = MOST_LAYERS,
                parts: list[str] | None = None) -> int:
        """Rewrite the directories of more than ``most_layers`` layers, or those named, as one layer each."""
        base = self.version()
        layers = self.layers(base)
        count = {part: sum(layer.part == part for layer in layers) for _, part, _ in layers}
        chosen = [part for part, n in count.items() if (n > most_layers if parts is None else part in parts)]
        if not chosen:
            return base
        return self.replace(arranged(self._frame([x for x in layers if x.part in chosen], schema)), base)

    def expire(self, keep: int = 2) -> None:
        """Forget all but the last ``keep`` versions, with the files that only they name; their readers must be done."""
        versions = sorted(self.versions())
        old, kept = versions[:-keep], versions[-keep:]
        needed = {layer.commit for v in kept for layer in self.layers(v)}
        gone = {layer.commit for v in old for layer in self.layers(v)} - needed
        for version in old:
            file_system, target = located(self.spark, self._version_file(version))
            file_system.delete(target, False)
        for commit in gone:
            self.discard(commit)
