"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.functions.geo import ease_coordinates, latlon_from_attrs, wrap_lon
from gridlake.functions.paths import base_name, has_extension, match_names
from gridlake.functions.times import (
    clock_digits,
    clock_text,
    clock_timestamp,
    day_of_year,
    hhmm_timestamp,
    hour_axis,
    normalise_hhmm,
    time_label,
)
from gridlake.operators.select import difference, rescale
from workload.registry import query


@query(
    "f2_hhmm_timestamp",
    "SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS a, date_trunc('minute', ts)::TIMESTAMP AS b FROM events",
)
def _(t):
    clock = F.date_format("ts", "HH:mm:ss")
    return t.events.select(
        "event_id",
        hhmm_timestamp(F.to_date("ts"), F.date_format("ts", "HHmm")).alias("a"),
        hhmm_timestamp(F.to_date("ts"), normalise_hhmm(clock)).alias("b"),
    )


@query(
    "f3_clock_timestamp",
    "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS acq_timestamp, strftime(ts, '%H%M%S') AS acq_timestr FROM events",
)
def _(t):
    at = clock_timestamp(F.to_date("ts"), F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", at.alias("acq_timestamp")).withColumn("acq_timestr", clock_digits("acq_timestamp"))


@query("f5_day_of_year", "SELECT o_orderkey, strftime(o_orderdate, '%j') AS doy FROM orders")
def _(t):
    return t.orders.select("o_orderkey", day_of_year("o_orderdate").alias("doy"))


@query("f6_clock_text", "SELECT event_id, strftime(ts, '%H:%M') AS clock FROM events")
def _(t):
    return t.events.select("event_id", clock_text(F.date_format("ts", "HHmm")).alias("clock"))


@query("f9_wrap_lon", "SELECT event_id, lat, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon FROM cube_long")
def _(t):
    return wrap_lon(t.cube_long.select("event_id", "lat", "lon"))


@query(
    "f10_equal_area_grid",
    """SELECT event_id, -17367530.45::DOUBLE + 0.5 * 36032.22::DOUBLE + 36032.22::DOUBLE * ((user_id // 15 + user_id % 15) % 10) AS easting_m,
  7314540.83::DOUBLE - 0.5 * 36032.22::DOUBLE - 36032.22::DOUBLE * (user_id % 15) AS northing_m FROM events""",
    "easting_m northing_m",
)
def _(t):
    cells = t.events.selectExpr("event_id", "user_id % 15 AS row", "(user_id DIV 15 + user_id % 15) % 10 AS col")
    return ease_coordinates(cells).drop("row", "col")


@query(
    "f11_axes_from_attributes",
    """SELECT event_id, lat0 AS orig_lat, CAST(CAST((user_id % 15) * ((30.126::DOUBLE + 0.02 * 15 - 30.126) / 15) + 30.126 AS FLOAT) AS DOUBLE) AS lat,
  CAST(CAST((user_id // 15) * ((-95.877::DOUBLE + 0.02 * 4000 + 95.877) / 4000) - 95.877 AS FLOAT) AS DOUBLE) AS lon
FROM (SELECT *, value AS lat0 FROM events)""",
    "orig_lat lat lon",
)
def _(t):
    cells = t.events.selectExpr("event_id", "value AS lat", "user_id % 15 AS north_south", "user_id DIV 15 AS east_west")
    grid = {"DX": "0.0200001", "DY": 0.02, "SOUTH_WEST_CORNER_LAT": 30.1260004, "SOUTH_WEST_CORNER_LON": -95.8770001}
    return latlon_from_attrs(cells, grid, (15, 4000)).drop("north_south", "east_west")


@query("f12_hour_axis", "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS time FROM events")
def _(t):
    source = t.events.select("event_id", F.to_date("ts").alias("date"), (F.hour("ts") + 1).alias("hour"))
    return hour_axis(source)


@query(
    "f13_time_label",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, strftime(o_orderdate, '%Y-%m') AS m,
  strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%j') AS day FROM orders""",
)
def _(t):
    at = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        time_label(at, "D").alias("d"),
        time_label(at, "M").alias("m"),
        time_label(F.month(at), "month").alias("month"),
        time_label(F.dayofyear(at), "day").alias("day"),
    )


@query(
    "f14_path_pieces",
    """SELECT path, list_extract(string_split(path, '/'), -1) AS name, ends_with(path, '.nc') AS is_nc, contains(path, '1998') AS in_1998
FROM granules""",
)
def _(t):
    return t.granules.select(
        "path",
        base_name("path").alias("name"),
        has_extension("path", "nc").alias("is_nc"),
        F.contains("path", F.lit("1998")).alias("in_1998"),
    )


@query("f15_match_names", "SELECT path FROM granules WHERE path LIKE '%/grid.%.1998%' OR path LIKE '%/grid%0701.nc'")
def _(t):
    return match_names(t.granules, ["*.1998", "0701.nc"]).select("path")


@query(
    "f17_scale_arithmetic",
    "SELECT time, lat, lon, SSH - OBP AS steric, SSH * 1000 AS height_mm FROM monthly",
    "steric height_mm",
)
def _(t):
    cube = rescale(difference(t.monthly, "SSH", "OBP", "steric"), "SSH", 1000, units="mm", out="height_mm")
    return cube.select("time", "lat", "lon", "steric", "height_mm")
