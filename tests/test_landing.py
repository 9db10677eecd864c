"""Queries that land raw documents, over small tables of their own."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugelake import derive
from gaugelake.entry.queries import OTHER_STATION, STATION, registered
from gaugelake.operators import coverage
from gaugelake.sources import raw
from gaugelake.sources import tables as tables_of
from gaugelake.streaming import incremental

YEARS = (1996, 1998, 2001)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Line items of two suppliers, one of them the station that is cut off in 1998, on some days of three years."""
    root = str(tmp_path_factory.mktemp("landing"))
    rows = [(k, k % 7, supplier, k % 3, "ANR"[k % 3], dt.datetime(year, 1 + k % 12, 1 + k % 28))
            for supplier in (int(STATION[-4:]) - 6200, int(OTHER_STATION[-4:]) - 6200)
            for year in YEARS for k in range(40)]
    written = {
        "lineitem": (rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                           " l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(1, 4, "F", dt.datetime(1998, 1, 1), "1-URGENT")],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(4, "Customer#4", 1, 10.0, "BUILDING")],
                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(1, "NL", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, (values, schema) in written.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_refine_from_index_reads_every_year(spark, tables):
    got = registered()["refine_from_index"](spark, tables).groupBy("station_id", "year").sum("n_rows").collect()
    # the cut year of one station is in the quarantine
    assert {(r[0], r[1]): r[2] for r in got} == {
        (station, year): 40 for station in (STATION, OTHER_STATION) for year in YEARS if (station, year) != (STATION, 1998)}


def observed(spark, n, station, time):
    return spark.range(0, n, 1, 3).selectExpr(
        f"{station} AS location_id", f"{time} AS timestamp", "1.5D AS longitude", "2.5D AS latitude",
        *[f"CASE WHEN id % 7 > 0 THEN double(id + {i}) END AS {p}" for i, p in enumerate(derive.PARAMETERS)])


def test_a_station_and_year_is_landed_as_one_compressed_document(spark, tmp_path):
    # neighbouring rows are of all stations and years; some have no station or time
    rows = observed(spark, 30_000, "CASE WHEN id % 11 > 0 THEN concat('s', id % 11) END",
                    "CASE WHEN id % 13 > 0 THEN timestamp_seconds(id * 3600 + id % 3 * 40000000) END")
    root = str(tmp_path / "raw")
    split = coverage.split_coverages(derive.responses(rows))
    raw.land_raw(raw.with_metadata(split, None, "2025-01-01T00:00:00Z", "api", "c", 10), root, placed=True)
    files = [f for f in Path(root).rglob("part-*") if f.suffix != ".crc"]
    folders = {f.parent for f in files}
    assert len(files) == len(folders) and all(f.name.endswith(".json.gz") for f in files)
    docs = raw.read_raw_coverage(spark, root)
    assert docs.count() == len(folders) == rows.where("location_id IS NOT NULL").select("location_id", F.year("timestamp")).distinct().count()
    back = coverage.flatten_wide(docs, derive.PARAMETERS).select(*rows.columns)
    kept = rows.where("location_id IS NOT NULL")
    assert back.exceptAll(kept).count() == 0 and kept.exceptAll(back).count() == 0


def test_a_crowded_station_is_packed_into_several_documents(spark):
    rows = observed(spark, 60_000, "CASE WHEN id % 10 > 0 THEN 'crowd' ELSE concat('s', id % 7) END", "timestamp_seconds(id % 5 * 3600)")
    packed = derive.responses(rows)
    back = coverage.flatten_wide(packed, derive.PARAMETERS).select(*rows.columns)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    sizes = packed.select(F.explode("data.coverages").alias("c")).select(
        F.col("c.`eumetnet:locationId`"), F.size("c.domain.axes.t.values")).collect()
    assert max(n for _, n in sizes) < 10_000 and sum(s == "crowd" for s, _ in sizes) == 7
    assert sum(s != "crowd" for s, _ in sizes) == 7


def test_shuffle_files_go_with_their_query(spark):
    from gaugelake.session import configure

    assert configure(spark).conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"


def test_a_drop_that_parses_is_not_read_again_for_its_form(spark, tmp_path, monkeypatch):
    root, silver, checkpoint = (str(tmp_path / name) for name in ("raw", "silver", "checkpoint"))
    rows = observed(spark, 300, "concat('s', id % 3)", "timestamp_seconds(id * 3600)")
    split = coverage.split_coverages(derive.responses(rows))
    raw.land_raw(raw.with_metadata(split, None, "2025-01-01T00:00:00Z", "api", "c", 10), root, placed=True)
    monkeypatch.setattr(raw, "reread_pretty_printed", lambda *_: pytest.fail("read again"))
    incremental.incremental_load(spark, root, silver, checkpoint)
    assert tables_of.scan_silver(spark, silver).count() == 300
