from __future__ import annotations

import datetime as dt
import json
import os
import shutil

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import fixed, session
from gridlake.model import DETECTION_CSV
from gridlake.operators.quality import check_ledger
from gridlake.plans.detections import archive_to_store, refresh_detections, with_timestamps
from gridlake.plans.gridstore import update_from_files
from gridlake.plans.reanalysis import melt_from_files
from gridlake.sources import manifests, raster, readers, sinks, store
from gridlake.streaming.landing import stream_cube
from tests.conftest import rows


def days(cube, first, last):
    return cube.where(F.col("time").between(F.lit(f"{first} 00:00:00"), F.lit(f"{last} 23:59:59")))


def test_scratch_follows_the_cluster(spark):
    assert session.new_scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_csv_with_another_layout_is_refused(spark, tmp_path):
    spark.createDataFrame([(1.0, 2.0)], "longitude double, latitude double").write.option("header", True).csv(
        str(tmp_path / "fire_archive_1")
    )
    schema = T.StructType([T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_detections(spark, str(tmp_path), "archive", schema).collect()


def test_read_store_prunes(spark, tmp_path):
    df = spark.range(60).selectExpr(
        "date_add(DATE '2023-12-20', CAST(id AS INT)) AS acq_date",
        "'0312' AS acq_time",
        "'6.1' AS version",
        "'MODIS' AS instrument",
    )
    root = str(tmp_path / "s")
    sinks.write_store(with_timestamps(df), root)
    got = readers.read_store(spark, root, since=dt.date(2024, 1, 5), until=dt.date(2024, 1, 9))
    assert got.count() == 5
    assert "PartitionFilters: [isnotnull(year" in got._jdf.queryExecution().toString()
    assert readers.read_store(spark, root, year=2024, month=2).count() == 17
    assert readers.read_store(spark, root).first().acq_timestamp.hour == 3


def test_overwrite_replaces_only_its_partitions_and_refuses_loss(spark, tmp_path):
    root = str(tmp_path / "s")
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "6.1", "MODIS", 1), (dt.date(2024, 1, 1), "6.1", "VIIRS", 2), (dt.date(2024, 1, 2), "6.1", "MODIS", 3)],
        "acq_date date, version string, instrument string, v int",
    ).selectExpr("*", "year(acq_date) AS year", "month(acq_date) AS month", "day(acq_date) AS mday")
    sinks.write_store(df, root, force=False)
    half = df.where("v = 1").withColumn("v", F.lit(9))
    with pytest.raises(sinks.IncompletePartition):
        sinks.write_store(half, root, force=False)
    sinks.write_store(half, root, force=True)
    assert sorted(r.v for r in readers.read_store(spark, root).collect()) == [3, 9]


def test_half_written_year_is_written_again(spark, tmp_path):
    root = str(tmp_path / "y")
    df = spark.createDataFrame([(dt.date(y, 5, 1), y) for y in (2019, 2020)], "acq_date date, v int")
    # A lost job left data of 2020 but no record that the year is finished.
    sinks.write_partitions(df.where("v = 2020").withColumn("v", F.lit(0)).withColumn("year", F.year("acq_date")), root, ("year",))
    sinks.write_missing_years(df, root)
    sinks.write_missing_years(df.withColumn("v", F.lit(-1)), root)
    assert sorted(r.v for r in spark.read.parquet(root).collect()) == [2019, 2020]


def test_open_year_takes_later_rows(spark, tmp_path):
    root = str(tmp_path / "y")
    df = spark.createDataFrame([(dt.date(2020, m, 1), m) for m in (1, 2)], "acq_date date, v int")
    sinks.write_missing_years(df.where("v = 1"), root, open_years=(2020,))
    sinks.write_missing_years(df, root)
    sinks.write_missing_years(df.withColumn("v", F.lit(-1)), root)
    assert sorted(r.v for r in spark.read.parquet(root).collect()) == [1, 2]


def test_archive_and_near_real_time_share_partitions(spark, tmp_path):
    row = (1.0, 2.0, 300.0, 1.0, 1.0, dt.date(2024, 1, 1), "0312", "A", "MODIS", "n", "6.1", 290.0, 5.0, "D", 0.0)
    df = spark.createDataFrame([row], DETECTION_CSV)
    df.write.option("header", True).csv(str(tmp_path / "raw" / "fire_archive_1.csv"))
    late = df.withColumn("satellite", F.lit("B")).drop("type")
    late.write.option("header", True).csv(str(tmp_path / "raw" / "fire_nrt_1.csv"))
    archive_to_store(spark, *[str(tmp_path / d) for d in ("raw", "yearly", "store")])
    assert sorted(r.satellite for r in readers.read_store(spark, str(tmp_path / "store")).collect()) == ["A", "B"]


def test_hot_partition_is_cut_into_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 60000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('d', id % 20) END AS k", "uuid() AS v")
        sinks.write_partitions(df, str(tmp_path / "h"), ("k",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(tmp_path / "h" / "k=hot") if f.endswith(".parquet")]
    assert len(files) > 1 and spark.read.parquet(str(tmp_path / "h")).count() == 60000


def test_links(spark):
    def link(**k):
        return {"rel": "http://x/data#", "title": "t", **k}

    page = {
        "feed": {
            "entry": [
                {"links": [link(href="u/a"), link(href="v/a"), link(href="u/b", inherited=True), {"rel": "http://x/data#"}]},
                {"links": [link(href="u/c", rel="http://x/browse#"), link(href="u/d", rel="http://x/metadata#"), link(href="u/e", title="OPeNDAP")]},
                {"links": [{"href": "u/f"}]},
                {"id": "no links"},
            ]
        }
    }
    df = spark.createDataFrame([(1, json.dumps(page)), (2, json.dumps(page)), (3, "{}")], "page int, json string")
    got = manifests.granule_links(df)
    assert sorted((r.page, r.href) for r in got.collect()) == [(p, h) for p in (1, 2) for h in ("u/a", "u/d", "u/f")]


def test_expected_files(spark):
    dates = manifests.date_range(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    got = [r.path for r in manifests.expected_files(dates, "x_%d%03d.txt").orderBy("date").collect()]
    assert got == ["x_2024059.txt", "x_2024060.txt", "x_2024061.txt"]


def test_text_ledger_ignores_blank_lines(spark, tmp_path):
    (tmp_path / "done.txt").write_text("\na\n\n  \nb\n")
    files = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "path string")
    got = manifests.new_files(files, manifests.read_ledger(spark, str(tmp_path / "done.txt")))
    assert [r.path for r in got.collect()] == ["c"]


def test_manifest_lists_nested_files(spark, cube, tmp_path):
    cube.withColumn("d", F.to_date("time")).write.partitionBy("d").parquet(str(tmp_path / "m"))
    got = manifests.file_manifest(spark, str(tmp_path / "m"), "*.parquet")
    assert got.select(F.regexp_extract("path", "d=([0-9-]+)", 1)).distinct().count() == 3


def test_upsert_of_all_equals_create_of_all(spark, cube, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    store.create_store(cube, a, 24, 3600)
    store.create_store(days(cube, "2021-12-30", "2021-12-30"), b, 24, 3600)
    store.upsert_timesteps(b, days(cube, "2021-12-31", "2022-01-01"))
    store.upsert_timesteps(b, days(cube, "2021-12-31", "2022-01-01"))
    assert rows(store.read_cells(spark, a)) == rows(store.read_cells(spark, b))
    assert store.read_axis(spark, b).count() % 24 == 0


def test_late_gap_and_replaced_steps(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    store.create_store(days(cube, "2021-12-31", "2021-12-31"), root, 10, 3600)
    store.upsert_timesteps(root, days(cube, "2022-01-01", "2022-01-01"))
    store.upsert_timesteps(root, days(cube, "2021-12-30", "2021-12-30"))
    changed = days(cube, "2021-12-31", "2021-12-31").where("hour(time) = 5 AND lat = 60").withColumn("TS", F.lit(1.0))
    store.upsert_timesteps(root, changed)
    got = store.read_cells(spark, root)
    kept = cube.where("time <> TIMESTAMP_NTZ '2021-12-31 05:00:00'")
    assert rows(got.drop("time_chunk")) == rows(kept.unionByName(changed))
    axis = store.read_axis(spark, root)
    times = sorted(r.time for r in axis.collect())
    assert len(times) % 10 == 0 and len(set(times)) == len(times)
    assert {b - a for a, b in zip(times, times[1:])} == {dt.timedelta(hours=1)}
    assert got.select("time").distinct().join(axis, "time", "left_anti").count() == 0


def test_far_gap_loses_nothing(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    store.create_store(days(cube, "2021-12-30", "2021-12-30"), root, 5, 3600)
    store.upsert_timesteps(root, days(cube, "2022-01-01", "2022-01-01"))
    assert store.read_cells(spark, root).count() == cube.where("day(time) <> 31").count()


def test_populate_leaves_other_leads(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    leads = cube.select("time", "lat", "lon", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("forecast"), "SWGNT")
    store.create_store(leads.where("time < '2021-12-31'"), root, 24, 3600)
    new = leads.where("forecast <= 1").withColumn("SWGNT", F.lit(99.0))
    store.upsert_timesteps(root, new, keys=("time", "forecast"), extend=False)
    # The axis of the first day is padded by a whole chunk, the second day.
    got = store.read_cells(spark, root)
    assert got.where("forecast = 2 AND SWGNT = 99").count() == 0
    assert got.where("forecast <= 1 AND SWGNT <> 99").count() == 0
    assert got.agg(F.max("time")).first()[0] < dt.datetime(2022, 1, 1)


def test_repeated_batch_is_taken_once_and_continues_from_staging(spark, cube, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    store.create_store(days(cube, "2021-12-30", "2021-12-30"), root, 48, 3600)
    new = days(cube, "2021-12-31", "2021-12-31")

    files = spark.createDataFrame([("f1",)], "path string")
    with monkeypatch.context() as m:
        m.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            store.upsert_timesteps(root, new, batch="b1", paths=files)
    # Half published: the chunk of both days was removed and not yet put back.
    shutil.rmtree(f"{root}/cells/time_chunk=0")
    # The next batch, whichever it is, first publishes what was staged.
    store.upsert_timesteps(root, days(cube, "2022-01-01", "2022-01-01"), batch="b2")
    assert rows(store.read_cells(spark, root).drop("time_chunk")) == rows(cube)
    assert [r.path for r in store.processed_files(spark, root).collect()] == ["f1"]
    # A batch in the ledger is not taken again.
    store.upsert_timesteps(root, new.withColumn("TS", F.lit(0.0)), batch="b1")
    assert rows(store.read_cells(spark, root).drop("time_chunk")) == rows(cube)
    with pytest.raises(ValueError, match="batch name"):
        store.upsert_timesteps(root, new, batch="a/b")


def test_batches_with_parts_of_steps_keep_all_cells(spark, cube, tmp_path):
    base = str(tmp_path)
    first, rest = days(cube, "2021-12-30", "2021-12-30"), days(cube, "2021-12-31", "2022-01-01")
    north = F.col("lat") > cube.agg(F.avg("lat")).first()[0]
    for n, part in enumerate((rest.where(north), rest.where(~north))):
        part.coalesce(1).write.parquet(f"{base}/in{n}")
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    store.create_store(first, f"{base}/a", 24, 3600)
    while update_from_files(spark, f"{base}/in", f"{base}/a", lambda df: df, limit=1):
        pass
    assert rows(store.read_cells(spark, f"{base}/a").drop("time_chunk")) == rows(cube)

    # One file at a time, and two folders with checkpoints of their own.
    store.create_store(first, f"{base}/b", 24, 3600)
    stream_cube(spark, f"{base}/in", f"{base}/b", f"{base}/cp", cube.schema, max_files=1).awaitTermination()
    assert rows(store.read_cells(spark, f"{base}/b").drop("time_chunk")) == rows(cube)
    store.create_store(first, f"{base}/b", 24, 3600)
    assert not os.path.exists(f"{base}/b/batches")
    for n in (0, 1):
        stream_cube(spark, f"{base}/in{n}", f"{base}/b", f"{base}/cp{n}", cube.schema).awaitTermination()
    assert rows(store.read_cells(spark, f"{base}/b").drop("time_chunk")) == rows(cube)
    assert store.read_batches(spark, f"{base}/b").select("batch").distinct().count() == 2


def test_equal_area_store(spark, cube, tmp_path):
    flat = cube.withColumnsRenamed({"lat": "northing_m", "lon": "easting_m"})
    root, first = str(tmp_path / "s"), days(flat, "2021-12-30", "2021-12-30")
    store.create_store(first, root, 24, 3600)
    store.upsert_timesteps(root, days(flat, "2021-12-31", "2022-01-01").where("northing_m IS NOT NULL"), by_cell=True)
    assert rows(store.read_cells(spark, root).drop("time_chunk")) == rows(flat)


def test_refused_rows_change_nothing(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    first, new = days(cube, "2021-12-30", "2021-12-30"), days(cube, "2021-12-31", "2021-12-31")
    store.create_store(first, root, 24, 3600)
    no_time = new.withColumn("time", F.when(F.hour("time") != 3, F.col("time")))
    half = new.withColumn("time", F.col("time") + F.expr("interval 30 minutes"))
    for wrong in (no_time, half):
        with pytest.raises(ValueError, match="rows have no time"):
            store.upsert_timesteps(root, wrong, batch="b")
    with pytest.raises(ValueError, match="rows have no time"):
        store.create_store(no_time, root, 24, 3600)
    assert rows(store.read_cells(spark, root).drop("time_chunk")) == rows(first)
    store.upsert_timesteps(root, new, batch="b")
    assert rows(store.read_cells(spark, root).drop("time_chunk")) == rows(days(cube, "2021-12-30", "2021-12-31"))
    assert not os.listdir(f"{root}/staged")


def test_duplicate_axis_stops_the_upsert(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    store.create_store(days(cube, "2021-12-30", "2021-12-30"), root, 24, 3600)
    spark.read.parquet(f"{root}/axis").limit(1).write.mode("append").partitionBy("time_chunk").parquet(f"{root}/axis")
    with pytest.raises(ValueError, match="match"):
        store.upsert_timesteps(root, days(cube, "2021-12-31", "2021-12-31"))


def test_ledger_agrees_after_upserts(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    store.create_store(days(cube, "2021-12-30", "2021-12-30"), root, 24, 3600)
    store.upsert_timesteps(root, days(cube, "2021-12-31", "2022-01-01"))
    ledger = cube.select(F.to_date("time").alias("date")).distinct()
    row = check_ledger(store.read_axis(spark, root), ledger, 24).first()
    assert row.whole_chunks and row.all_present and row.n_expected == 72


@pytest.mark.parametrize("old, new, kind", [(8, 24, "merge"), (24, 20, "split"), (24, 7, "shuffle")])
def test_rechunk_moves_no_more_than_it_must(spark, cube, tmp_path, old, new, kind):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    store.write_cube(cube, a, {"time": old, "lat": 2, "lon": 2})
    chunks = {"time": new, "lat": 2, "lon": 3}
    n = cube.select("time").distinct().count()
    cap = 2000 if kind == "shuffle" else 1 << 30
    plan = store.plan_rechunk(n, 10_000, old, new, cap, 1 << 27)
    assert plan.kind == kind
    planned = store.rechunked(spark.read.parquet(a), old, chunks, plan)
    text = planned._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in text) == (kind != "merge")
    if kind != "shuffle":
        assert "REPARTITION" not in text
    got = store.rechunk(spark, a, b, chunks, cap_bytes=cap)
    assert got.kind == kind
    again = spark.read.parquet(b)
    assert rows(again.drop("time_chunk")) == rows(cube)
    ranks = sorted({r.time for r in cube.select("time").distinct().collect()})
    assert all(r.time_chunk == ranks.index(r.time) // new for r in again.select("time", "time_chunk").distinct().collect())
    if kind == "shuffle":
        assert got.partitions == -(-session.path_state(spark, a)[0] // cap)
        assert planned.rdd.getNumPartitions() >= plan.partitions == 5
    third = str(tmp_path / "c")
    store.rechunk(spark, b, third, {"time": new * 2})  # the copy knows its chunks
    assert rows(spark.read.parquet(third).drop("time_chunk")) == rows(cube)


def test_a_shuffled_rechunk_writes_few_files(spark, cube, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    store.write_cube(cube, a, {"time": 48, "lat": 5, "lon": 5})
    plan = store.rechunk(spark, a, b, {"time": 7, "lat": 3, "lon": 100}, cap_bytes=500)
    again = spark.read.parquet(b)
    assert plan.kind == "shuffle" and plan.partitions >= 10
    # A hash of cells gave every task rows of every chunk, so a file for each pair of both.
    assert len(again.inputFiles()) <= plan.partitions + 72 // 7 + 1
    assert rows(again.drop("time_chunk")) == rows(cube)


def test_places_among_labels(spark):
    from pyspark.sql import types as T

    labels = [-2.5, 0.0, 1.0, 4.0, 9.0]
    values = [-3.0, -2.5, -1.0, 0.0, 0.5, 1.0, 8.9, 9.0, 99.0]
    for n in range(len(labels) + 1):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        got = {r.v: r.n for r in df.select("v", store._up_to(labels[:n], T.DoubleType(), df.v).alias("n")).collect()}
        assert got == {v: sum(x <= v for x in labels[:n]) for v in values} | {None: 0}


def test_rechunk_plan():
    assert store.plan_rechunk(1000, 10**9, 10, 30, 1 << 30, 1 << 27).kind == "merge"
    assert store.plan_rechunk(1000, 10**9, 30, 10, 1 << 30, 1 << 27).kind == "split"
    plan = store.plan_rechunk(10_000, 10**9, 5000, 1, 1 << 27, 1 << 27)
    assert plan.kind == "split" and plan.pieces == 10_000  # a file for each new chunk is what was asked for
    plan = store.plan_rechunk(10_000, 10**12, 100, 101, 1 << 26, 1 << 27)
    assert plan.kind == "shuffle" and 10**12 / plan.partitions <= 1 << 26


def test_rechunk_keeps_the_cells(spark, cube, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    store.write_cube(cube, a, {"time": 7, "lat": 2, "lon": 2})
    store.rechunk(spark, a, b, {"time": 50, "lat": 4, "lon": 1})
    assert rows(spark.read.parquet(b).drop("time_chunk")) == rows(cube)
    assert sorted(os.listdir(b))[-2:] == ["time_chunk=0", "time_chunk=1"]


def test_stream_equals_batch(spark, cube, tmp_path):
    base = str(tmp_path)
    store.create_store(days(cube, "2021-12-30", "2021-12-30"), f"{base}/s", 24, 3600)

    def run():
        stream_cube(spark, f"{base}/in", f"{base}/s", f"{base}/cp", cube.schema, max_files=2).awaitTermination()

    days(cube, "2021-12-30", "2021-12-31").repartition(3, "time").write.parquet(f"{base}/in")
    run()
    days(cube, "2021-12-31", "2022-01-01").withColumn("TS", F.lit(1.0)).coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    run()
    want = days(cube, "2021-12-30", "2021-12-30").unionByName(days(cube, "2021-12-31", "2022-01-01").withColumn("TS", F.lit(1.0)))
    assert rows(store.read_cells(spark, f"{base}/s").drop("time_chunk")) == rows(want)
    assert store.processed_files(spark, f"{base}/s").count() >= 2


def test_raster_round_trip_with_gaps(spark, cube):
    tiles = raster.raster_tiles(cube.select("time", "lat", "lon", "TS"), tile=3, prefix="p", unit="M", nodata=-1.0, crs="EPSG:4326")
    one_time = cube.where("time = TIMESTAMP_NTZ '2021-12-31 07:00:00'")
    tiles = raster.raster_tiles(one_time.select("time", "lat", "lon", "TS"), tile=3, nodata=-1.0)
    assert {len(r.pixels) for r in tiles.collect()} == {9}
    lats = sorted((r.lat for r in one_time.select("lat").distinct().collect()), reverse=True)
    lons = sorted(r.lon for r in one_time.select("lon").distinct().collect())
    got = {(lats[r.row], lons[r.col]): r.value for r in raster.tile_cells(tiles, 3).collect()}
    assert got == {(r.lat, r.lon): r.TS for r in one_time.collect() if r.TS is not None}
    unknown = one_time.select("time", "lat", "lon", F.lit(float("nan")).alias("TS"))
    assert {p for r in raster.raster_tiles(unknown, tile=3, nodata=-1.0).collect() for p in r.pixels} == {-1.0}


def test_geotransform(spark):
    df = spark.createDataFrame([(a * 0.5, b * 2.0) for a in range(4) for b in range(3)], "lat double, lon double")
    assert tuple(raster.geotransform(df).first()) == (-1.0, 2.0, 1.75, -0.5, 3, 4)


def test_unreadable_files_fail_and_the_run_goes_on(spark, cube, tmp_path):
    cube.coalesce(1).write.parquet(str(tmp_path / "in"))
    (tmp_path / "in" / "bad.parquet").write_bytes(b"PAR1 no parquet PAR1")
    files = manifests.file_manifest(spark, str(tmp_path / "in"), "*.parquet")
    kept = manifests.record_failures(manifests.file_status(spark, files, cube.schema), str(tmp_path / "failed"))
    assert kept.count() == 1
    assert [r.path.endswith("bad.parquet") for r in spark.read.parquet(str(tmp_path / "failed")).collect()] == [True]


def test_version_stays_text(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "6.10", "MODIS")], "acq_date date, version string, instrument string")
    sinks.write_store(df.selectExpr("*", "2024 AS year", "1 AS month", "1 AS mday"), str(tmp_path / "v"))
    assert readers.read_store(spark, str(tmp_path / "v"), version="6.10").first().version == "6.10"


def test_refresh_records_files_that_did_not_arrive(spark, tmp_path):
    root, landing = str(tmp_path / "s"), str(tmp_path / "in")
    day = dt.date(2024, 1, 1)
    row = (1.0, 2.0, 300.0, 1.0, 1.0, day, "03:12", "A", "MODIS", "n", "6.1", 290.0, 5.0, "D", 0.0)
    df = spark.createDataFrame([row], DETECTION_CSV)
    sinks.write_store(with_timestamps(df), root)
    for d, time in ((day, "04:30"), (day + dt.timedelta(days=1), "1:05:09")):
        out = df.drop("instrument").withColumns({"acq_date": F.lit(d), "acq_time": F.lit(time)})
        sinks.write_daily_text(out, f"{landing}/MODIS", fixed.DAILY_FILES["MODIS"].split("%")[0])
    where = landing + "/{instrument}/file_key={name}"
    refresh_detections(spark, root, where, dt.date(2024, 1, 3), failures=str(tmp_path / "failed"))
    got = readers.read_store(spark, root)
    assert sorted((r.acq_date.day, r.acq_time, r.acq_timestr) for r in got.collect()) == [(1, "0430", "043000"), (2, "0105", "010509")]
    assert spark.read.parquet(str(tmp_path / "failed")).count() == 7
    # Nothing is open on the same day; the next run starts from the last stored date again.
    refresh_detections(spark, root, where, dt.date(2024, 1, 2), failures=str(tmp_path / "none"))
    assert not session.path_exists(spark, str(tmp_path / "none"))
    refresh_detections(spark, root, where, dt.date(2024, 1, 4), failures=str(tmp_path / "next"))
    assert spark.read.parquet(str(tmp_path / "next")).agg(F.min("date")).first()[0] == dt.date(2024, 1, 2)


def test_dead_refresh_is_repeated(spark, tmp_path, monkeypatch):
    root, landing = str(tmp_path / "s"), str(tmp_path / "in")
    row = (1.0, 2.0, 300.0, 1.0, 1.0, dt.date(2024, 1, 1), "0312", "A", "MODIS", "n", "6.1", 290.0, 5.0, "D", 0.0)
    df = spark.createDataFrame([row], DETECTION_CSV)
    sinks.write_store(with_timestamps(df), root)
    for i in range(4):
        day = df.drop("instrument").withColumn("acq_date", F.lit(dt.date(2024, 1, 1 + i)))
        sinks.write_daily_text(day, f"{landing}/MODIS", fixed.DAILY_FILES["MODIS"].split("%")[0])
    where = landing + "/{instrument}/file_key={name}"

    def lose_a_day(rows, target, **k):
        sinks.write_store(rows.where("mday <> 2"), target, **k)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr("gridlake.plans.detections.write_store", lose_a_day)
        with pytest.raises(RuntimeError):
            refresh_detections(spark, root, where, dt.date(2024, 1, 4))
    refresh_detections(spark, root, where, dt.date(2024, 1, 4))
    assert sorted(r.acq_date.day for r in readers.read_store(spark, root).collect()) == [1, 2, 3, 4]


def test_upsert_reads_and_rewrites_only_touched_chunks(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    store.create_store(cube, root, 24, 3600)
    before = {c: os.listdir(f"{root}/cells/time_chunk={c}") for c in range(3)}
    store.upsert_timesteps(root, days(cube, "2021-12-31", "2021-12-31"))
    after = {c: os.listdir(f"{root}/cells/time_chunk={c}") for c in range(3)}
    assert before[0] == after[0] and before[2] == after[2] and before[1] != after[1]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(parts=st.lists(st.sets(st.integers(0, 5), min_size=1), min_size=1, max_size=3), chunk=st.sampled_from([5, 24]))
def test_any_sequence_of_upserts_keeps_axis_and_cells(spark, cube, tmp_path_factory, parts, chunk):
    root = str(tmp_path_factory.mktemp("u"))
    half_days = F.floor(F.timestamp_diff("HOUR", F.lit("2021-12-30").cast("timestamp_ntz"), F.col("time")) / 12)
    cells = cube.withColumn("h", half_days)
    store.create_store(cells.where("h = 2").drop("h"), root, chunk, 3600)
    latest = {2: 0.0}
    for i, chosen in enumerate(parts, 1):
        store.upsert_timesteps(root, cells.where(F.col("h").isin(list(chosen))).drop("h").withColumn("SWGNT", F.col("SWGNT") + 100 * i))
        latest.update({h: 100.0 * i for h in chosen})
    shift = F.create_map(*[F.lit(v) for h, s in latest.items() for v in (h, s)])
    want = cells.where(F.col("h").isin(list(latest))).withColumn("SWGNT", F.col("SWGNT") + shift[F.col("h").cast("int")]).drop("h")
    assert rows(store.read_cells(spark, root).drop("time_chunk")) == rows(want)
    times = sorted(r.time for r in store.read_axis(spark, root).collect())
    assert len(times) % chunk == 0
    assert {b - a for a, b in zip(times, times[1:])} == {dt.timedelta(hours=1)}
    assert {r.time for r in want.select("time").distinct().collect()} <= set(times)


def test_melt_skips_finished_years(spark, tmp_path):
    products = {"rad": fixed.RADIATION, "int": fixed.PRECIPITATION, "flx": fixed.FLUXES, "slv": fixed.NEAR_SURFACE}

    def land(n, temperature):
        hours = spark.range(n).selectExpr(
            "TIMESTAMP_NTZ '2020-12-31 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS time", "70D AS lat", "-40D AS lon"
        )
        for name, names in products.items():
            values = {v: F.lit(temperature if v == "TS" else 1.0) for v in names}
            hours.withColumns(values).write.mode("overwrite").parquet(str(tmp_path / name))

    where = {name: str(tmp_path / name) for name in products}
    root = str(tmp_path / "daily")
    land(24, 300.0)
    melt_from_files(spark, where, root, "GrIS")
    land(48, 250.0)
    melt_from_files(spark, where, root, "GrIS")
    got = {r.year: r for r in spark.read.parquet(root).collect()}
    assert (got[2020].TS, got[2021].TS) == (300.0, 250.0)
    assert got[2020].TScalc == pytest.approx(273.15) and got[2020].SMELT < 0 and got[2021].SMELT == 0


@pytest.mark.parametrize("chunk", [5, 24])
def test_time_bounds_prune_chunks(spark, cube, tmp_path, chunk):
    root = str(tmp_path / "s")
    store.create_store(days(cube, "2021-12-31", "2021-12-31"), root, chunk, 3600)
    store.upsert_timesteps(root, days(cube, "2021-12-30", "2022-01-01"))
    since, until = dt.datetime(2021, 12, 30, 22, 30), dt.datetime(2021, 12, 31, 4)
    got = store.read_cells(spark, root, since, until)
    assert "time_chunk" in got._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert rows(got.drop("time_chunk")) == rows(cube.where(F.col("time").between(F.lit(since), F.lit(until))))
    assert store.read_cells(spark, root, until=dt.datetime(2021, 12, 29)).count() == 0
