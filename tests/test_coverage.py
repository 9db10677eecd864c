import json
import random
from datetime import datetime

import pytest
from documents import A, B, collection, coverage, enveloped, hours, land
from pyspark.sql import functions as F

from gaugelake import derive
from gaugelake.operators import coverage as ops
from gaugelake.plans import jobs
from gaugelake.schema import RAW_DOCUMENT
from gaugelake.sources import raw, tables


def parse(spark, *documents):
    rows = [(json.dumps(d),) for d in documents]
    df = spark.createDataFrame(rows, "value string")
    return df.select(F.from_json("value", RAW_DOCUMENT).alias("d")).select("d.*")


def test_flatten_both_envelopes(spark):
    data = collection(coverage(A, hours("2024-01-01", 0, 2), {"T": [1.5, None], "NEW": [7, 8]}))
    for document in (enveloped(data), data):
        rows = ops.flatten_coverage(parse(spark, document)).orderBy("timestamp").collect()
        assert [(r["location_id"], str(r["timestamp"]), r["longitude"], r["latitude"]) for r in rows] == [
            (A, "2024-01-01 00:00:00", 6.65, 52.067), (A, "2024-01-01 01:00:00", 6.65, 52.067)]
        assert [dict(r["params"]) for r in rows] == [{"T": 1.5, "NEW": 7.0}, {"T": None, "NEW": 8.0}]


def test_short_range_missing_time_axis_and_missing_id(spark):
    data = collection(
        coverage(A, hours("2024-01-01", 0, 3), {"T": [1, 2, 3], "U": [50]}),
        coverage(B, None, {"T": [9]}),
        coverage(None, hours("2024-01-01", 5, 1), {"T": [4]}),
    )
    wide = ops.widen_params(ops.flatten_coverage(parse(spark, data)), ["T", "U", "X"])
    got = [(r["location_id"], r["T"], r["U"], r["X"]) for r in wide.orderBy("timestamp").collect()]
    assert got == [(A, 1, 50, None), (A, 2, None, None), (A, 3, None, None), (None, 4, None, None)]


def test_position_without_coordinates(spark):
    c = coverage(A, hours("2024-01-01", 0, 1), {"T": [1]})
    c["domain"]["axes"]["x"]["values"] = []
    del c["domain"]["axes"]["y"]
    row = ops.flatten_coverage(parse(spark, collection(c))).first()
    assert row["longitude"] is None and row["latitude"] is None


def test_wide_rows_equal_widened_maps(spark):
    docs = parse(spark, enveloped(collection(
        coverage(A, hours("2024-01-01", 0, 3), {"T": [1, None, 3], "U": [50], "LONG": list(range(9)), "NONE": None}),
        coverage(B, hours("2024-01-01", 0, 2), {"T": []}), coverage(B, None, {"T": [9]}), coverage(B, [], {"T": [9]}),
        coverage(None, hours("2024-01-01", 0, 1), {}))))
    names = ["T", "U", "LONG", "NONE", "ABSENT"]
    wide = ops.flatten_wide(docs, names).drop("_metadata")
    mapped = ops.widen_params(ops.flatten_coverage(docs), names).drop("_metadata")
    assert wide.count() == 6
    assert wide.exceptAll(mapped.select(wide.columns)).count() == 0
    assert mapped.select(wide.columns).exceptAll(wide).count() == 0
    assert {r["LONG"] for r in wide.where(F.col("location_id") == A).collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        ops.flatten_wide(docs, ["_pos"])


def test_random_documents_against_plain_loops(spark):
    rng = random.Random(11)
    documents, expected = [], []
    for _ in range(40):
        members = []
        for _ in range(rng.randrange(4)):
            times = rng.choice([None, [], hours("2024-05-01", rng.randrange(10), rng.randrange(1, 9))])
            ranges = {p: [rng.choice([None, round(rng.uniform(-60, 60), 1)]) for _ in range(rng.randrange(10))]
                      for p in rng.sample(["T", "U", "FF", "X1"], rng.randrange(5))}
            station = rng.choice([A, B, None])
            members.append(coverage(station, times, ranges, x=rng.choice([1.5, 2.5])))
            for i, t in enumerate(times or []):
                row = {p: v[i] for p, v in ranges.items() if i < len(v)}
                expected.append((t, station, members[-1]["domain"]["axes"]["x"]["values"][0],
                                 *(row.get(p) for p in ("T", "U", "FF", "X1"))))
        data = collection(*members)
        documents.append(rng.choice([data, enveloped(data)]))
    docs = parse(spark, *documents)
    names = ops.parameter_names(docs)
    assert names == ["FF", "T", "U", "X1"]
    for rows in (ops.flatten_wide(docs, names), ops.widen_params(ops.flatten_coverage(docs), names)):
        got = rows.select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "location_id", "longitude",
                          "T", "U", "FF", "X1").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


@pytest.mark.parametrize("codegen", ["true", "false"])
@pytest.mark.parametrize("flatten", [
    ops.flatten_coverage, lambda d: ops.flatten_wide(d, [f"P{i}" for i in range(23)])])
def test_a_year_in_one_document(spark, flatten, codegen):
    times = [f"2024-{m:02d}-{d:02d}T{h:02d}:00:00Z" for m in range(1, 13) for d in range(1, 29) for h in range(24)]
    values = {f"P{i}": list(range(len(times))) for i in range(23)}
    saved = spark.conf.get("spark.sql.codegen.wholeStage")
    try:
        spark.conf.set("spark.sql.codegen.wholeStage", codegen)
        rows = flatten(parse(spark, collection(*[coverage(s, times, values) for s in (A, B)])))
        rows.write.format("noop").mode("overwrite").save()
        assert rows.count() == 2 * len(times)
        # every time has its place
        spread = rows.groupBy("location_id").agg(F.countDistinct("_pos"), F.min("_pos"), F.max("_pos"))
        assert {tuple(r)[1:] for r in spread.collect()} == {(len(times), 0, len(times) - 1)}
        if "P22" in rows.columns:
            assert rows.where("P22 != _pos OR P22 IS NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", saved)


def test_parameter_names_and_clash(spark):
    docs = parse(spark, collection(coverage(A, [], {"T": [], "FF": []})), collection(coverage(B, None, {"U": []})))
    assert ops.parameter_names(docs) == ["FF", "T", "U"]
    rows = ops.flatten_coverage(parse(spark, collection(coverage(A, hours("2024-01-01", 0, 1), {"T": [1]}))))
    with pytest.raises(ValueError):
        ops.widen_params(rows, ["timestamp"])


def test_split(spark):
    both = collection(
        coverage(A, hours("2024-01-01", 0, 1), {"T": [1]}),
        coverage(B, hours("2024-01-01", 0, 1), {"T": [2]}),
        coverage(None, hours("2024-01-01", 0, 1), {"T": [3]}),
        coverage("", hours("2024-01-01", 0, 1), {"T": [4]}))
    got = ops.split_coverages(parse(spark, both)).select(
        "station_id", F.to_json("data").alias("j")).orderBy("station_id").collect()
    assert [r["station_id"] for r in got] == [B, A]
    for r in got:
        document = json.loads(r["j"])
        assert document["type"] == "CoverageCollection" and len(document["coverages"]) == 1
        assert document["coverages"][0]["eumetnet:locationId"] == r["station_id"]
        assert document["parameters"] == both["parameters"]
        assert document["referencing"] == both["referencing"]


def test_split_bare_coverage_needs_one_requested_station(spark):
    bare = parse(spark, coverage(None, hours("2024-01-01", 0, 1), {"T": [1]}))
    assert [r["station_id"] for r in ops.split_coverages(bare, [A]).collect()] == [A]
    assert ops.split_coverages(bare, [A, B]).count() == 0
    assert ops.split_coverages(bare).count() == 0
    assert ops.split_coverages(parse(spark, {"type": "Other"}), [A]).count() == 0


def test_points_and_profile(spark):
    two = collection(
        coverage(A, hours("2024-01-01", 0, 3), {"T": [None, 1, 2], "U": [3]}),
        coverage(B, None, {"T": [1]}))
    docs = parse(spark, two, coverage(A, hours("2024-02-01", 0, 2), {"Q": [1, 2]}), {"type": "Other"})
    assert ops.count_data_points(docs).first()["data_points"] == 6
    assert ops.count_data_points(parse(spark, {"type": "Other"})).first()["data_points"] == 0
    docs = docs.withColumn("_source_file", F.lit("f"))
    row = ops.profile_raw(docs).first()
    assert row["types"] == ["Coverage", "CoverageCollection", "Other"]
    assert (row["n_coverages"], row["n_times"]) == (3, 5)
    assert (row["first_t"], row["last_t"]) == ("2024-01-01T00:00:00Z", "2024-02-01T01:00:00Z")
    assert row["parameters"] == ["Q", "T", "U"]
    first = ops.profile_coverages(docs).where(F.col("first_t") == "2024-01-01T00:00:00Z").first()
    assert first["samples"] == {"T": [1.0, 2.0], "U": [3.0]}


def test_read_pretty_files_of_both_layouts(spark, tmp_path):
    root = str(tmp_path / "raw")
    land(root, A, 2024, "data.json", collection(coverage(A, hours("2024-01-01", 0, 2), {"T": [1, 2]})))
    land(root, A.replace("-", "_"), 2023, "20230101_to_20230131.json",
         enveloped(collection(coverage(A, hours("2023-01-01", 0, 1), {"T": [3]}))))
    land(root, B, 2024, "data.json", collection(coverage(B, hours("2024-01-01", 0, 1), {"T": [4]})))
    land(root, B, 2024, "data.json.tmp", "{")
    docs = raw.read_raw_coverage(spark, root, multiline=True)
    assert docs.count() == 3
    one = raw.read_raw_coverage(spark, root, station_id=A, multiline=True)
    assert {(r["station_id"], r["year"]) for r in one.collect()} == {(A, 2024), (A, 2023)}
    assert raw.read_raw_coverage(spark, root, A, 2023, multiline=True).count() == 1
    names = jobs.refine(spark, root, str(tmp_path / "refined"), multiline=True, layout=tables.MONTHLY)
    table = tables.scan_refined(spark, str(tmp_path / "refined"), names, layout=tables.MONTHLY)
    got = {(r["station_id"], r["year"], r["month"], r["T"], r["_source_api"]) for r in table.collect()}
    assert got == {(A, 2024, 1, 1.0, None), (A, 2024, 1, 2.0, None), (A, 2023, 1, 3.0, "api"),
                   (B, 2024, 1, 4.0, None)}
    assert table.where(F.col("_source_file").endswith(".json")).count() == 4


def test_refining_one_year_keeps_hours_of_documents_that_run_on(spark, tmp_path):
    root, path = str(tmp_path / "raw"), str(tmp_path / "refined")
    land(root, A, 2023, "a.json", enveloped(collection(
        coverage(A, hours("2023-12-31", 22, 2) + hours("2024-01-01", 0, 2), {"T": [1, 2, 3, 4]}))))
    land(root, A, 2024, "b.json", enveloped(collection(
        coverage(A, hours("2024-01-01", 2, 2), {"T": [5, 6]}))))
    jobs.refine(spark, root, path, multiline=True)
    jobs.refine(spark, root, path, A, 2024, multiline=True)
    jobs.refine(spark, root, path, A, 2023, multiline=True)
    assert sorted(r["T"] for r in tables.scan_refined(spark, path, ["T"]).collect()) == [1, 2, 3, 4, 5, 6]


def test_land_replaces_a_station_year_and_reads_back(spark, tmp_path):
    root = str(tmp_path / "raw")

    def landing(*values, replace=True):
        docs = ops.split_coverages(parse(spark, collection(
            coverage(A, hours("2024-01-01", 0, len(values)), {"T": list(values)}))))
        raw.land_raw(raw.with_metadata(docs, None, "2025-01-01T00:00:00Z", "api", "c", 1), root, replace)

    def temperatures():
        rows = ops.flatten_coverage(raw.read_raw_coverage(spark, root))
        return sorted(r["params"]["T"] for r in rows.collect())

    landing(1, 2)
    landing(3, 4)
    assert temperatures() == [3, 4]
    landing(5, replace=False)
    assert temperatures() == [3, 4, 5]
    meta = raw.read_raw_coverage(spark, root).select("_metadata.*").first()
    assert (meta["ingestion_method"], meta["station_id"]) == ("single_station", A)


def test_documents_are_not_shuffled_to_name_their_stations(spark, monkeypatch):
    made = [collection(coverage(station, hours("2024-01-01", 0, 1), {"T": [1]})) for station in (A, B, A)]
    docs = ops.split_coverages(parse(spark, *made))
    # a registry with names that repeat, are missing or belong to no document
    stations = spark.createDataFrame([(A, "a"), (A, "a again"), ("C", "c"), (None, "none")], "id string, name string")
    observed = spark.createDataFrame([(A,), (A,), (B,), (None,)], "station_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def named(observed):
            out = raw.with_metadata(docs, stations, "2025-01-01T00:00:00Z", "api", "c", 1, observed)
            plan = out._jdf.queryExecution().executedPlan().toString()
            return sorted((r["station_id"], r["_metadata"]["station_name"]) for r in out.collect()
                          if r["station_id"] == A) + [r["_metadata"]["station_name"] for r in out.collect()
                                                      if r["station_id"] == B], plan
        whole, shuffled = named(None)
        cut, plan = named(observed)
        assert cut == whole == [(A, "a"), (A, "a"), (A, "a again"), (A, "a again"), None]
        assert "Exchange hashpartitioning(station_id" in shuffled and "Exchange hashpartitioning(station_id" not in plan
        # more names than are broadcast are joined as before
        monkeypatch.setattr(raw, "SMALL_REGISTRY", 1)
        many, plan = named(observed)
        assert many == whole and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bad_files_are_isolated(spark, tmp_path):
    root = str(tmp_path / "raw")
    good = json.dumps(collection(coverage(A, hours("2024-01-01", 0, 1), {"T": [1]})))
    land(root, A, 2024, "good.json", good)
    land(root, A, 2024, "bad.json", good[:-5])
    land(root, A, 2024, "mixed.json", good + "\n" + good[:30] + "\n")
    land(root, A, 2024, "empty.json", json.dumps({"type": "Other"}))
    land(root, A, 2024, "time.json", json.dumps(collection(coverage(A, ["yesterday"], {"T": [1]}))))
    docs = raw.read_raw_coverage(spark, root, keep_corrupt=True)
    readable, quarantine, outcome = raw.isolate_bad_files(docs)
    assert ops.flatten_coverage(readable).count() == 2
    assert sorted(r["document"][:20] for r in quarantine.collect()) == sorted(
        [good[:20], good[:20], '{"type":"CoverageCollection"'[:20]])
    got = {r["_source_file"].rsplit("/", 1)[1]: (r["ok_documents"], r["bad_documents"], r["empty_documents"])
           for r in outcome.collect()}
    assert got == {"good.json": (1, 0, 0), "bad.json": (0, 1, 0), "mixed.json": (1, 1, 0),
                   "empty.json": (0, 0, 1), "time.json": (0, 1, 0)}
    assert raw.file_totals(outcome).first().asDict() == {"ok_files": 1, "files": 5}


# --- landing index ----------------------------------------------------------------

def test_landing_index(spark, tmp_path):
    from gaugelake.sources import landing
    root, index = tmp_path / "raw + more", str(tmp_path / "index")

    def document(station, day, **values):
        return enveloped(collection(coverage(station, hours(day, 0, 3), {k: list(v) for k, v in values.items()})), station)

    land(root, A, 2023, "over.json", enveloped(collection(coverage(
        A, ["2023-12-31T23:00:00Z", "2024-01-01T00:00:00Z"], {"T": [1, 2]})), A))
    land(root, A.replace("-", "_"), 2024, "pretty.json", document(A, "2024-05-01", T=(3, 4, 5), U=(1, 1, 1)))
    land(root, B, 2024, "lines.json", "\n".join(json.dumps(document(B, f"2024-06-0{d}", T=(6, 7, 8), RH=(0, 0, 0))) for d in (1, 2)))
    land(root, B, 2025, "later.json", document(B, "2025-06-01", FF=(1, 2, 3)), indent=None)
    land(root, B, 2025, "blank.json", "\n\n")
    land(root, B, 2025, "empty.json", "")  # not listed
    assert landing.update(spark, str(root), index) == 5
    got = {r["_source_file"].rsplit("/", 1)[1]: r for r in landing.scan(spark, index).collect()}
    assert {k: (r["form"], r["documents"], r["bad_documents"], r["names"]) for k, r in got.items()} == {
        "over.json": ("pretty", 1, 0, ["T"]), "pretty.json": ("pretty", 1, 0, ["T", "U"]),
        "lines.json": ("lines", 2, 0, ["RH", "T"]), "later.json": ("lines", 1, 0, ["FF"]), "blank.json": ("lines", 0, 0, None)}
    assert got["pretty.json"]["station_id"] == A and got["lines.json"]["last_time"] == datetime(2024, 6, 2, 2)
    assert landing.update(spark, str(root), index) == 0
    totals = landing.totals(landing.scan(spark, index)).first()
    assert (totals["ok_files"], totals["files"]) == (4, 5)

    # a year on its own: a file of the year before that runs on into it is read, later ones are not opened
    names = jobs.refine(spark, str(root), str(tmp_path / "refined"), year=2024, index=index)
    assert names == ["RH", "T", "U"]
    rows = tables.scan_refined(spark, str(tmp_path / "refined"), names)
    assert rows.count() == 10 and rows.agg(F.sum("T")).first()[0] == 2 + 12 + 42
    plan = landing.read(spark, str(root), landing.reaching(landing.scan(spark, index), year=2024))
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()

    # a changed file is taken in again, a broken one is counted
    land(root, B, 2024, "lines.json", json.dumps(document(B, "2024-06-01", T=(6, 7, 8), RH=(0, 0, 0))) + "\n" + '{"coverages": [')
    assert landing.update(spark, str(root), index) == 1
    changed = landing.scan(spark, index).where("_source_file LIKE '%lines.json'").collect()
    assert [(r["documents"], r["bad_documents"]) for r in changed] == [(2, 1)]
    with pytest.raises(ValueError, match="1 of 5 documents.*lines.json"):
        jobs.refine(spark, str(root), str(tmp_path / "refined"), index=index)
    jobs.refine(spark, str(root), str(tmp_path / "refined"), index=index, quarantine=str(tmp_path / "bad"))
    assert spark.read.json(str(tmp_path / "bad")).count() == 1


def test_landing_index_of_an_empty_folder(spark, tmp_path):
    from gaugelake.sources import landing
    (tmp_path / "raw" / f"station_id={A}" / "year=2024").mkdir(parents=True)
    assert landing.update(spark, str(tmp_path / "raw"), str(tmp_path / "index")) == 0
    assert landing.scan(spark, str(tmp_path / "index")).count() == 0


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_documents_are_packed_in_one_shuffle_of_plain_rows(spark):
    rows = spark.range(0, 20_000, 1, 3).selectExpr(
        "concat('s', id % 5) AS location_id", "timestamp_seconds(id * 90000) AS timestamp", "1.5D AS longitude",
        "2.5D AS latitude", *[f"CASE WHEN id % 7 > 0 THEN double(id + {i}) END AS {p}" for i, p in enumerate(derive.PARAMETERS)])
    packed = derive.responses(rows)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert _exchanges(packed) == 1
    assert plan.rindex("Aggregate") < plan.index("Exchange ")  # nothing is gathered by the tasks that read the input
    back = ops.flatten_wide(packed, derive.PARAMETERS).select(*rows.columns)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    assert packed.select(F.explode("data.coverages").alias("c")).where("size(c.domain.axes.t.values) > 8192").count() == 0
