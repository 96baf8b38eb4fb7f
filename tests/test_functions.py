from __future__ import annotations

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions import geo, labels, paths, times
from gridlake.functions.positions import axis_index, broadcast_if_small, ordered_position
from gridlake.model import attrs, nan_to_null, set_attrs
from tests.conftest import rows


def one(df):
    return df.collect()[0]


def test_date_from_path(spark):
    df = spark.createDataFrame([("a/x.20240229.nc",), ("a/x.20240231.nc",), ("a/x.nc",)], "p string")
    got = [r[0] for r in df.select(paths.date_from_path("p")).collect()]
    assert got == [dt.date(2024, 2, 29), None, None]


@pytest.mark.parametrize("text,want", [("312", "0312"), ("0312", "0312"), ("3:12", "0312"), ("03:12:45", "0312")])
def test_normalise_hhmm(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert one(df.select(times.normalise_hhmm("t")))[0] == want


def test_clock_timestamp(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "03:04:05", "03:04")], "d date, a string, b string")
    r = one(df.select(times.clock_timestamp("d", "a"), times.clock_timestamp("d", "b")))
    assert tuple(r) == (dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4))


def test_recode_keeps_unmapped(spark):
    df = spark.createDataFrame([("A",), ("X",), (None,)], "s string")
    got = [r[0] for r in df.select(labels.recode("s", fixed.SATELLITES)).collect()]
    assert got == ["Aqua", "X", None]


def test_instrument_label(spark):
    df = spark.createDataFrame([("A", "MODIS"), ("1", "VIIRS"), ("Z", "OTHER")], "satellite string, instrument string")
    assert [r.label for r in labels.instrument_label(df).collect()] == ["MODIS Aqua", "NOAA-20-VIIRS", "OTHER"]


def test_wrap_lon_moves_only_above_180(spark):
    df = spark.createDataFrame([(0.0,), (180.0,), (180.5,), (359.0,)], "lon double")
    assert [r.lon for r in geo.wrap_lon(df).collect()] == [0.0, 180.0, -179.5, -1.0]


def test_point_wkb(spark):
    df = spark.createDataFrame([(1.5, -2.25), (None, 1.0)], "x double, y double")
    got = df.select(geo.point_wkb("x", "y").alias("g"))
    first, second = [r.g for r in got.collect()]
    assert bytes(first) == struct.pack("<BIdd", 1, 1, 1.5, -2.25)
    assert second is None
    assert [tuple(r) for r in got.select(geo.wkb_xy("g").alias("p")).select("p.*").collect()][0] == (1.5, -2.25)


def test_nan_becomes_null_and_is_skipped(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (2.0, 4.0)], "lat double, v double")
    assert one(nan_to_null(df).agg(F.avg("v")))[0] == 4.0


def test_attributes_survive_a_projection(spark):
    df = set_attrs(spark.range(1).selectExpr("1D AS v"), "v", {"units": "K"})
    assert attrs(df.select("v"), "v") == {"units": "K"}


@pytest.mark.parametrize("descending", [False, True])
def test_positions_in_ranges(spark, descending):
    """A third of the rows share a key; many small ranges number them as one would."""
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k", "(id * 7919) % 3001 AS v")
    got = ordered_position(df, ["v"], keys=("k",), descending=descending, rows_per_split=100)
    want = {}
    for k, v in sorted(((r.k, r.v) for r in df.collect()), key=lambda r: r[1], reverse=descending):
        want.setdefault(k, []).append(v)
    assert {(r.k, r.v): r.position for r in got.collect()} == {
        (k, v): i for k, values in want.items() for i, v in enumerate(values)
    }
    assert "rangepartitioning" not in got._jdf.queryExecution().toString()


def test_weighted_positions(spark):
    df = spark.range(1000).selectExpr("id AS v", "id % 4 AS w")
    got = {r.v: r.position for r in ordered_position(df, ["v"], weight="w", rows_per_split=50).collect()}
    total = 0
    for v in range(1000):
        assert got[v] == total
        total += v % 4


def test_axis_index_beyond_the_local_bound(spark, cube):
    small = rows(axis_index(cube, "time", descending=True))
    assert rows(axis_index(cube, "time", descending=True, max_rows=3)) == small


def test_broadcast_only_within_the_bound(spark):
    df = spark.range(50)
    assert broadcast_if_small(df, 49) is df
    assert broadcast_if_small(df, 50).count() == 50
