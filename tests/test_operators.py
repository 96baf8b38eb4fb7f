from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.geo import wrap_lon
from gridlake.functions.positions import axis_index
from gridlake.model import KEYS, attrs, set_attrs
from gridlake.operators import aggregate, energy, joins, quality, select, timeaxis
from gridlake.operators.axes import chunk_ids, complete, spread_over
from gridlake.plans import reanalysis
from gridlake.sources.readers import read_cube
from tests.conftest import rows

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def at(text):
    return dt.datetime.fromisoformat(text)


def test_bbox_and_variables_reach_the_scan(spark, cube, tmp_path):
    cube.write.parquet(str(tmp_path / "c"))
    df = read_cube(spark, str(tmp_path / "c"), bbox=(61.0, 62.0, 10.0, 12.0), variables=["TS"])
    plan = df._jdf.queryExecution().toString()
    assert "LessThanOrEqual(lat,62.0), Greater" in plan
    assert "SWGNT" not in plan.split("ReadSchema")[-1]


@pytest.mark.parametrize("region", ["GrIS", (0.0, 80.0, -10.0, 20.0), (0.0, 80.0, 170.0, 180.0)])
def test_wrapped_bbox(spark, tmp_path, region):
    spark.range(721).selectExpr("id / 2 AS lon", "60D AS lat").write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    got = select.wrapped_bbox(df, region)
    assert rows(got) == rows(select.bbox(wrap_lon(df), region)) and got.count() > 0
    assert "Or(" in got._jdf.queryExecution().toString().split("PushedFilters")[1]


def test_time_slice_covers_the_last_day(spark, cube):
    got = select.time_slice(cube, dt.date(2021, 12, 31), dt.date(2021, 12, 31))
    assert got.agg(F.min("time"), F.max("time")).first() == (at("2021-12-31"), at("2021-12-31T23:00"))


def test_nearest_label_ties_take_the_larger(spark, cube):
    got = select.sel_nearest(cube, lat=61.5, lon=10.2)
    by_axis = select.sel_nearest(cube, axes={"lat": axis_index(cube, "lat")}, lat=61.5, lon=10.2)
    assert rows(by_axis) == rows(got)
    assert {(r.lat, r.lon) for r in got.collect()} == {(62.0, 10.0)}


@pytest.mark.parametrize("chosen", [(0, None, 24), (5, 30, 1), (0, 1, 1)])
def test_isel(spark, cube, chosen):
    axis = sorted({r.time for r in cube.collect()})
    got = select.isel(cube, "time", *chosen)
    assert {r.time for r in got.collect()} == set(axis[chosen[0] : chosen[1] : chosen[2]])


def test_merge_refuses_shared_variables(cube):
    with pytest.raises(ValueError, match="TS"):
        joins.merge_cubes(cube, cube.select(*KEYS, "TS"))


def brute(cells, points):
    return {
        p: min((math.sqrt((c[1] - p[1]) * (c[1] - p[1]) + (c[0] - p[0]) * (c[0] - p[0])), *c) for c in cells)
        for p in points
    }


@pytest.mark.parametrize("shape", ["grid", "clustered", "line", "single"])
@pytest.mark.parametrize("per_leaf", [4, 64])
def test_nearest_pixels_equal_brute_force(spark, shape, per_leaf):
    rng = random.Random(shape)
    cells = {
        "grid": [(float(a), float(b)) for a in range(-10, 11) for b in range(0, 30) if rng.random() < 0.6],
        # A third of the cells crowd into a corner that one coarse box covers.
        "clustered": [(rng.random() / 1000, rng.random() / 1000) for _ in range(150)]
        + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)],
        "line": [(5.0, float(b)) for b in range(200)],
        "single": [(1.0, 2.0)],
    }[shape]
    points = [(rng.uniform(-20, 20), rng.uniform(-20, 40)) for _ in range(60)] + [(0.5, 0.5), (0.0005, 0.0005)]
    got = joins.nearest_pixels(
        spark.createDataFrame(cells, "lat double, lon double"),
        spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id int, lat double, lon double"),
        per_leaf=per_leaf,
    ).collect()
    want = brute(cells, points)
    assert len(got) == len(points)
    for r in got:
        assert (r.distance, r.pixel_lat, r.pixel_lon) == want[(r.lat, r.lon)]


def test_nearest_of_no_cells_is_missing(spark):
    none = spark.createDataFrame([], "lat double, lon double")
    got = joins.nearest_pixels(none, spark.createDataFrame([(1.0, 2.0)], "lat double, lon double"))
    assert got.collect()[0].pixel_lat is None


def test_previous_value(spark):
    """Missing stays missing, each cell and year starts with its own value."""
    data = [
        ("2020-12-30T22:00", 1.0, 5.0, 5.0),
        ("2020-12-30T23:00", 1.0, None, 5.0),
        ("2020-12-31T05:00", 1.0, 7.0, None),
        ("2020-12-31T06:00", 1.0, 8.0, 7.0),
        ("2021-01-01T00:00", 1.0, 9.0, 9.0),
        ("2021-03-01T00:00", 1.0, 10.0, 9.0),
        ("2020-12-31T06:00", 2.0, None, None),
        ("2020-12-31T07:00", 2.0, 3.0, None),
    ]
    df = spark.createDataFrame(
        [(at(t), lat, 0.0, v, w) for t, lat, v, w in data], "time timestamp_ntz, lat double, lon double, TS double, want double"
    )
    for unit in ("HOUR", "DAY", "MONTH"):
        for r in energy.previous_value(df, "TS", "before", unit=unit).collect():
            assert r.before == r.want, (unit, r)


def test_surface_temperature_solves_the_balance(spark):
    df = spark.range(400).selectExpr("CAST(id * 3 - 400 AS DOUBLE) AS flux", "200D + id / 5 AS TS_before")
    k = fixed.STEP_SECONDS / (fixed.ICE_HEAT_CAPACITY * fixed.LAYER_MASS)
    a = fixed.STEFAN_BOLTZMANN * k
    for r in energy.surface_temperature(df).collect():
        assert r.TScalc > 0
        assert abs(a * r.TScalc**4 + r.TScalc - (r.flux * k + r.TS_before)) < 1e-9


def test_melt_of_missing_and_cold_cells_is_zero(spark):
    df = spark.createDataFrame(
        [(400.0, 280.0), (400.0, 273.0), (100.0, 280.0), (None, None)], "flux double, TScalc double"
    )
    got = [tuple(r) for r in energy.melt_rate(df).select("TScalc", "SMELT").collect()]
    emitted = fixed.STEFAN_BOLTZMANN * 273.15**4
    assert got[0] == (273.15, pytest.approx((400 - emitted) / fixed.LATENT_HEAT))
    assert got[1] == (273.0, 0.0)
    assert got[2][1] < 0  # warm start, little flux
    assert got[3] == (None, 0.0)


def test_sum_of_missing_day_is_zero_and_mean_is_missing(spark):
    df = spark.createDataFrame([(at("2020-01-01T05:00"), 1.0, 1.0, None)], "time timestamp_ntz, lat double, lon double, v double")
    assert aggregate.resample_daily(df, "sum", 3600).first().v == 0.0
    assert aggregate.resample_daily(df, "mean").first().v is None


def test_filled_days(spark):
    hours = ["2020-01-01T05:00", "2020-01-04T05:00"]
    df = spark.createDataFrame(
        [(at(hours[0]), 1.0, 1.0, 2.0), (at(hours[1]), 1.0, 1.0, 4.0), (at(hours[1]), 2.0, 1.0, 6.0)],
        "time timestamp_ntz, lat double, lon double, v double",
    )
    mean = aggregate.resample_daily(df, "mean", fill_gaps=True)
    total = aggregate.resample_daily(df, "sum", 10, fill_gaps=True)
    missing = [(1.0, None), (2.0, None)]
    got = [r[1:] for r in rows(mean.select("time", "lat", "v"))]
    assert got == [(1.0, 2.0), (2.0, None), *missing, *missing, (1.0, 4.0), (2.0, 6.0)]
    assert [r.v for r in total.orderBy("time", "lat").collect()] == [20.0, 0.0, 0.0, 0.0, 0.0, 0.0, 40.0, 60.0]


def test_year_mean_needs_twelve_months(spark):
    data = [(at(f"2020-{m:02d}-01"), 1.0, 1.0, float(m)) for m in range(1, 13)]
    data += [(at(f"2020-{m:02d}-01"), 2.0, 1.0, None if m == 5 else float(m)) for m in range(1, 13)]
    df = spark.createDataFrame(data, "time timestamp_ntz, lat double, lon double, v double")
    assert rows(aggregate.year_mean(df, 2020, "v")) == [(1.0, 1.0, 6.5), (2.0, 1.0, None)]


def test_trend_is_missing_where_a_value_is(spark):
    df = spark.createDataFrame(
        [("a", i, 0.002 * i + 1) for i in range(24)] + [("b", i, None if i == 3 else 1.0 * i) for i in range(24)],
        "k string, month_index int, v double",
    )
    got = {r.k: r for r in aggregate.linear_trend(df, ["k"], "v").collect()}
    assert got["a"].mm_per_year == pytest.approx(24.0) and got["a"].intercept == pytest.approx(1.0)
    assert got["b"].slope is None
    line = aggregate.trend_line(df.where("k = 'a'"), ["k"], "v").collect()
    assert all(r.trend == pytest.approx(r.v) for r in line)


@quick
@given(sizes=st.lists(st.integers(0, 50_000_000), min_size=1, max_size=60))
def test_size_summary_equals_pandas(spark, sizes):
    got = aggregate.size_summary(spark.createDataFrame([(s,) for s in sizes], "length long")).first()
    want = (pd.Series(sizes) / 1e6).describe()
    assert got["count"] == want["count"]
    for name, key in [("mean", "mean"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
        assert got[name] == pytest.approx(want[key])
    assert (got["std"] is None) if len(sizes) == 1 else got["std"] == pytest.approx(want["std"])


@quick
@given(n=st.integers(1, 40), chunk=st.integers(1, 12))
def test_padding(spark, n, chunk):
    df = spark.range(n).selectExpr(
        "TIMESTAMP_NTZ '2020-01-30 00:00:00' + make_dt_interval(CAST(id AS INT)) AS time", "1D AS lat", "2D AS lon", "3D AS v"
    )
    times = sorted(r.time for r in timeaxis.pad_time(df, chunk, 86400).collect())
    assert len(times) % chunk == 0 and 1 <= len(times) - n <= chunk
    assert times == [at("2020-01-30") + dt.timedelta(days=i) for i in range(len(times))]
    dense = timeaxis.pad_time(df, chunk, 86400, dense=True)
    assert dense.where("lat IS NULL").count() == 0 and dense.count() == len(times)


def test_catch_up_is_empty_when_up_to_date(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),)], "acq_date date")
    assert timeaxis.catch_up_dates(df, dt.date(2024, 1, 3)).count() == 0
    assert timeaxis.catch_up_dates(df, dt.date(2024, 1, 5)).count() == 3


def test_first_per_hot_key(spark):
    df = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "1000 - id AS seq", "id AS v")
    got = timeaxis.first_per(df, ["k"], ["seq"])
    assert got.count() == 601 and got.where("k = 0").first().v == 897


def test_products_with_long_axes(spark):
    df = spark.range(40).selectExpr("id % 7 AS a", "id % 11 AS b")
    small, slotted = complete(df, "a", "b"), complete(df, "a", "b", max_rows=5)
    assert rows(small) == rows(slotted) and small.count() == 77
    assert rows(quality.missing_pairs(df, "a", "b")) == rows(quality.missing_pairs(df, "a", "b", max_rows=5))
    assert quality.missing_pairs(df, "a", "b").count() == 77 - 40


def test_spread_over_times(spark, cube):
    axis = cube.select("time").distinct()
    assert spread_over(spark.range(2), axis).count() == 2 * axis.count()


def test_chunk_ids(spark, cube):
    got = chunk_ids(cube, {"time": 24, "lon": 2})
    assert {r.lon_chunk for r in got.where("lon >= 14").collect()} == {2}
    assert got.agg(F.max("time_chunk")).first()[0] == 2


def test_compare_cubes(spark, cube):
    same = quality.compare_cubes(cube, cube.withColumn("TS", F.col("TS") + 0.0), ["TS", "SWGNT"])
    assert {r.variable: r.n_different for r in same.collect()} == {"TS": 0, "SWGNT": 0}
    off = cube.withColumn("TS", F.when(F.col("lat") == 60, F.col("TS") + 1).otherwise(F.col("TS")))
    n = cube.where("lat = 60 AND TS IS NOT NULL").count()
    assert quality.compare_cubes(cube, off, ["TS"]).first().n_different == n
    assert quality.compare_cubes(cube, off, ["TS"], tolerance=1.5).first().n_different == 0


def test_guards(spark, cube):
    quality.assert_unique_time(cube, KEYS)
    with pytest.raises(ValueError, match="match"):
        quality.assert_unique_time(cube.unionByName(cube), KEYS)
    with pytest.raises(ValueError, match="files"):
        quality.assert_counts(spark.range(3), cube)
    manifest = spark.createDataFrame([(dt.date(2021, 12, 30), "a"), (dt.date(2021, 12, 30), "b")], "date date, path string")
    with pytest.raises(Exception, match="files for 2021-12-3"):
        quality.rebuild_ledger(cube, manifest).collect()


def test_classify_dates(spark):
    day = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    base = spark.createDataFrame([(d,) for d in day], "date date")
    runs = spark.createDataFrame([(day[0], True), (day[0], True), (day[1], False), (day[1], True)], "date date, readable boolean")
    got = {r.date: (r.status, r.n_forecasts) for r in timeaxis.classify_dates(base, runs).collect()}
    assert got == {day[0]: ("complete", 2), day[1]: ("blank", 2), day[2]: ("blank", 0)}
    assert timeaxis.classify_dates(base, runs, mode="skip").count() == 1


def test_daily_mean_of_numpy(spark, cube):
    frame = cube.toPandas()
    frame["day"] = frame.time.dt.floor("D")
    want = frame.groupby(["day", "lat", "lon"]).TS.mean()
    got = aggregate.resample_daily(cube).toPandas().set_index(["time", "lat", "lon"]).TS
    assert np.allclose(got.sort_index().to_numpy(float), want.sort_index().to_numpy(), equal_nan=True)


def test_chunk_plan_with_copies(spark):
    paths = ["a"] + ["b"] * 10 + ["c", "d", "e"]
    got = aggregate.chunk_plan(spark.createDataFrame([(p,) for p in paths], "path string"), 4)
    want = [tuple([i, len(c), c[0], c[-1]]) for i, c in enumerate(paths[k : k + 4] for k in range(0, len(paths), 4))]
    assert rows(got) == want


def test_daily_melt_shuffles_the_hours_once(spark, cube):
    hours = cube.withColumns({v: F.col("SWGNT") + i for i, v in enumerate(("LWGAB", "HFLUX", "EFLUX", "GHTSKIN", "PRECSN", "T2M"))})
    rad = hours.select("time", "lat", "lon", "SWGNT", "LWGAB", "TS").where("hour(time) % 7 <> 3")
    int_ = hours.select("time", "lat", "lon", "PRECSN")
    flx = hours.select("time", "lat", "lon", "HFLUX", "EFLUX", "GHTSKIN").where("hour(time) % 5 <> 2")
    slv = hours.select("time", "lat", "lon", "T2M")
    got = reanalysis.daily_melt(rad, int_, flx, slv, (55.0, 90.0, 0.0, 360.0))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The hours, and three times one row of each cell and day: their last values, the order of days, the means.
    assert plan.count("Exchange hashpartitioning") == 4 and "Join" not in plan
    hours_side = plan.split("Union")[1]
    assert plan.split("Union")[0].count("Exchange hashpartitioning") == 2 and hours_side.count("Exchange hashpartitioning") == 2
    hourly = reanalysis.hourly_melt(rad, flx)
    parts = [aggregate.resample_daily(p) for p in (hourly, int_, flx, slv)]
    want = joins.merge_cubes(*parts, on=("time", "lat", "lon"))
    names = want.columns
    rounded = [F.round(c, 6).alias(c) if c not in ("time", "lat", "lon") else c for c in names]
    assert rows(got.select(*rounded)) == rows(want.select(*rounded))
    assert got.schema["SMELT"].metadata == fixed.MELT_ATTRS


def test_scaled_variables_keep_attributes(spark):
    df = set_attrs(spark.createDataFrame([(2.0, 0.5), (None, 1.0)], "h double, p double"), "h", {"units": "m", "long_name": "height"})
    got = select.difference(select.rescale(df, "h", 1000, 1.0, units="mm", out="mm"), "h", "p", "rest")
    assert [(r["h"], r["mm"], r["rest"]) for r in got.collect()] == [(2.0, 2001.0, 1.5), (None, None, None)]
    assert attrs(got, "mm") == {"units": "mm", "long_name": "height"} and attrs(got, "rest") == attrs(df, "h")


def test_absent_keys_take_missing_for_equal(spark):
    wanted = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, n int")
    present = spark.createDataFrame([("b", None), ("c", 3)], "k string, n int")
    assert {tuple(r) for r in quality.absent_keys(wanted, present, "k", "n").collect()} == {("a", 1), (None, 2)}
