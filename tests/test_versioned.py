"""The versioned store: readers, lost and competing writers, pruning, digests and sums."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from gridlake.functions.curves import hilbert_places
from gridlake.operators.quality import compare_cubes
from gridlake.sources import versioned
from tests.conftest import rows


def days(cube, first, last):
    return cube.where(F.col("time").between(F.lit(f"{first} 00:00:00"), F.lit(f"{last} 23:59:59")))


def test_neighbours_on_the_curve_touch():
    for bits in (1, 2, 4):
        side = 1 << bits
        places = hilbert_places(bits)
        at = {p: divmod(i, side) for i, p in enumerate(places)}
        assert len(at) == side * side
        for p in range(side * side - 1):
            (a, b), (c, d) = at[p], at[p + 1]
            assert abs(a - c) + abs(b - d) == 1


def test_versions_stay_as_they_are(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    first = days(cube, "2021-12-31", "2021-12-31")
    one = versioned.create(first, root, 10, 3600, rows_per_file=40)
    assert len(set(one.blocks)) > 1
    pinned = versioned.read(spark, one)
    changed = cube.withColumn("SWGNT", F.col("SWGNT") + 100)
    two = versioned.upsert(root, changed.where("time >= '2021-12-31 12:00:00'"), batch="b", paths=spark.createDataFrame([("f",)], "path string"))
    assert versioned.upsert(root, cube, batch="b").version == two.version == 2
    three = versioned.upsert(root, days(cube, "2021-12-30", "2021-12-30"))
    want = cube.withColumn("SWGNT", F.when(F.col("time") >= F.lit("2021-12-31 12:00:00").cast("timestamp_ntz"), F.col("SWGNT") + 100).otherwise(F.col("SWGNT")))
    assert rows(pinned) == rows(first)
    assert rows(versioned.read(spark, versioned.open_version(spark, root))) == rows(want)
    assert rows(versioned.read(spark, versioned.open_version(spark, root, 2))) == rows(want.where("time >= '2021-12-31'"))
    made = dt.datetime.fromisoformat(two.created)
    assert versioned.open_version(spark, root, as_of=made).version == 2
    assert [r.path for r in versioned.processed_paths(spark, three).collect()] == ["f"]
    times = sorted(r.time for r in versioned.axis(spark, three).collect())
    assert len(times) % 10 == 0 and {b - a for a, b in zip(times, times[1:])} == {dt.timedelta(hours=1)}
    assert {r.time for r in want.select("time").distinct().collect()} <= set(times)

    back = versioned.restore(spark, root, 1)
    assert rows(versioned.read(spark, back)) == rows(first) and not versioned.batches(spark, back)
    versioned.upsert(root, changed.where("time >= '2021-12-31 12:00:00'"), batch="b")
    versioned.vacuum(spark, root, keep=1)
    now = versioned.open_version(spark, root)
    assert rows(versioned.read(spark, now)) == rows(want.where("time >= '2021-12-31'"))
    with pytest.raises(FileNotFoundError):
        versioned.open_version(spark, root, 2)
    assert versioned.history(spark, root).count() == 5 and versioned.batches(spark, now) == ["b"]
    for wrong in (cube.withColumn("time", F.lit(None).cast("timestamp_ntz")), cube.withColumn("time", F.col("time") + F.expr("interval 1 minute"))):
        with pytest.raises(ValueError, match="rows have no time"):
            versioned.upsert(root, wrong)
        with pytest.raises(ValueError, match="time"):
            versioned.create(wrong.where("hour(time) = 0 OR time IS NULL").unionByName(cube) if wrong.count() else wrong, root, 10, 3600)


@pytest.mark.parametrize("step", ["_write", "write_text", "rename_new"])
@pytest.mark.parametrize("change", ["create", "upsert"])
def test_lost_writer_leaves_the_old_version(spark, cube, tmp_path, monkeypatch, step, change):
    root = str(tmp_path / "s")
    versioned.create(days(cube, "2021-12-30", "2021-12-31"), root, 24, 3600)
    new = days(cube, "2021-12-31", "2022-01-01").withColumn("TS", F.lit(1.0))

    def run():
        return versioned.upsert(root, new) if change == "upsert" else versioned.create(new, root, 24, 3600)

    own = getattr(versioned, step)

    def lost(*a):
        if step == "_write":
            own(*a)  # the cells are there, the version is not
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versioned, step, lost)
        with pytest.raises(RuntimeError):
            run()
    now = versioned.open_version(spark, root)
    assert now.version == 1 and rows(versioned.read(spark, now)) == rows(days(cube, "2021-12-30", "2021-12-31"))
    after = run()
    kept = days(cube, "2021-12-30", "2021-12-30") if change == "upsert" else cube.limit(0)
    assert after.version == 2 and rows(versioned.read(spark, after)) == rows(kept.unionByName(new))
    versioned.vacuum(spark, root, keep=2)
    assert not [n for n in os.listdir(f"{root}/versions") if n.startswith(".new")]
    assert len(os.listdir(f"{root}/cells")) == 2
    assert rows(versioned.read(spark, now)) == rows(days(cube, "2021-12-30", "2021-12-31"))


def test_competing_writers(spark, cube, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    versioned.create(days(cube, "2021-12-30", "2021-12-30"), root, 24, 3600)
    own = versioned._write

    def meanwhile(other):
        def write(*a):
            out = own(*a)
            monkeypatch.setattr(versioned, "_write", own)
            versioned.upsert(root, other)
            return out

        monkeypatch.setattr(versioned, "_write", write)

    meanwhile(days(cube, "2022-01-01", "2022-01-01"))
    after = versioned.upsert(root, days(cube, "2021-12-31", "2021-12-31"))
    assert after.version == 3 and rows(versioned.read(spark, after)) == rows(cube)
    meanwhile(days(cube, "2022-01-01", "2022-01-01"))
    with pytest.raises(versioned.Conflict):
        versioned.upsert(root, days(cube, "2022-01-01", "2022-01-01").withColumn("TS", F.lit(0.0)))
    assert rows(versioned.read(spark, versioned.open_version(spark, root))) == rows(cube)


def test_boxes_and_times_open_few_files(spark, tmp_path):
    grid = spark.range(40 * 40 * 20).selectExpr(
        "TIMESTAMP_NTZ '2022-01-01' + make_dt_interval(0, CAST(id DIV 1600 AS INT)) AS time",
        "CAST(id % 40 AS DOUBLE) AS lat", "CAST(id DIV 40 % 40 AS DOUBLE) AS lon", "CAST(id AS DOUBLE) AS v",
    )
    store = versioned.create(grid, str(tmp_path / "s"), 5, 3600, rows_per_file=500)
    n = versioned.manifest(spark, store).count()
    assert n >= 60

    def opened(df):
        return df.select(F.col("_metadata.file_path")).distinct().count()

    cell = versioned.read(spark, store, bbox=(7, 7, 31, 31))
    assert cell.count() == 20 and opened(cell) <= 2 * 4
    box = versioned.read(spark, store, since=dt.datetime(2022, 1, 1, 5), until=dt.datetime(2022, 1, 1, 9), bbox=(0, 4, 0, 4))
    assert box.count() == 5 * 25 and opened(box) <= 3
    assert len(box.inputFiles()) == opened(box)  # nothing else was listed
    # An update of one cell rewrites its blocks alone.
    before = {r.path for r in versioned.manifest(spark, store).collect()}
    one = grid.where("lat = 3 AND lon = 3").withColumn("v", -F.col("v"))
    after = versioned.upsert(store.root, one, by_cell=True)
    now = {r.path for r in versioned.manifest(spark, after).collect()}
    assert len(before - now) == 4 and len(now - before) == 4
    assert versioned.read(spark, after, bbox=(3, 3, 3, 3)).where("v > 0").count() == 0


def test_digests_find_what_differs(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    one = versioned.create(cube, root, 24, 3600, rows_per_file=60)
    cell = days(cube, "2021-12-31", "2021-12-31").orderBy("time", "lat", "lon").where("TS IS NOT NULL").limit(1)
    two = versioned.upsert(root, cell.withColumn("TS", F.col("TS") + 2), by_cell=True)
    found = versioned.different_blocks(spark, one, two, ["TS", "SWGNT"]).collect()
    assert len(found) == 1 and found[0].variables == ["TS"]
    got = rows(versioned.compare(spark, one, two, ["TS", "SWGNT"]))
    assert got == rows(compare_cubes(versioned.read(spark, one), versioned.read(spark, two), ["TS", "SWGNT"]))
    assert versioned.different_blocks(spark, one, versioned.upsert(root, cell, by_cell=True), ["TS", "SWGNT"]).count() == 0
    # A store made anew from the same cells has the same digests, whatever its files.
    other = versioned.create(cube.repartition(3), str(tmp_path / "t"), 24, 3600, rows_per_file=60)
    assert versioned.different_blocks(spark, one, other, ["TS", "SWGNT"]).count() == 0


def test_sums_equal_a_scan(spark, cube, tmp_path):
    root = str(tmp_path / "s")
    versioned.create(days(cube, "2021-12-30", "2021-12-31"), root, 7, 3600, rows_per_file=50)
    versioned.upsert(root, days(cube, "2021-12-31", "2022-01-01").withColumn("TS", F.col("TS") * 2))
    now = versioned.upsert(root, cube.where("lat = 62").limit(5).withColumn("SWGNT", F.lit(-4.0)), by_cell=True)
    cells = versioned.read(spark, now)
    for r in versioned.summary(spark, now).collect():
        want = cells.agg(F.count(r.variable), F.avg(r.variable), F.min(r.variable), F.max(r.variable)).first()
        assert (r.n, r.low, r.high) == (want[0], want[2], want[3]) and r["mean"] == pytest.approx(want[1])
    b = versioned.bounds(spark, now).first()
    want = cells.agg(F.count("*"), F.min("time"), F.max("time"), F.min("lat"), F.max("lon")).first()
    assert (b.n_cells, b.min_time, b.max_time, b.min_x, b.max_y) == tuple(want)


def test_many_small_files_are_written_by_many_tasks(spark, tmp_path):
    grid = spark.range(40 * 40 * 10).selectExpr(
        "TIMESTAMP_NTZ '2022-01-01' + make_dt_interval(0, CAST(id DIV 1600 AS INT)) AS time",
        "CAST(id % 40 AS DOUBLE) AS lat", "CAST(id DIV 40 % 40 AS DOUBLE) AS lon", "CAST(id AS DOUBLE) AS v",
    )
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key, None)
    store = versioned.create(grid, str(tmp_path / "s"), 5, 3600, rows_per_file=100)
    paths = [r.path for r in versioned.manifest(spark, store).select("path").collect()]
    # All of them are a few hundred KB, which adaptive execution alone hands to one task.
    assert len(paths) >= 100 and len({re.search(r"part-(\d+)", p).group(1) for p in paths}) >= 4
    assert spark.conf.get(key, None) == before
    assert rows(versioned.read(spark, store)) == rows(grid)
