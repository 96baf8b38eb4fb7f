"""Positions, concatenation, padding, blanks and repair."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridlake.functions.positions import axis_index
from gridlake.operators.axes import blank_cube, chunk_ids
from gridlake.operators.timeaxis import (
    concat_forecast,
    concat_time,
    dedupe_time,
    first_per,
    lead_index,
    pad_time,
    relabel_time,
)
from workload.registry import query

_K = ["time", "lat", "lon"]


@query(
    "w2_lead_index",
    """SELECT date, path, row_number() OVER (PARTITION BY date ORDER BY priority <> '1-URGENT', path) - 1 AS forecast FROM granules""",
)
def _(t):
    runs = t.granules.select("date", "path", (F.col("priority") != "1-URGENT").alias("is_forecast"))
    return lead_index(runs).drop("is_forecast")


@query(
    "w3_axis_position",
    """SELECT 'lat' AS dim, lat AS label, row_number() OVER (ORDER BY lat DESC) - 1 AS index FROM (SELECT DISTINCT lat FROM cube)
UNION ALL SELECT 'lon', lon, row_number() OVER (ORDER BY lon) - 1 FROM (SELECT DISTINCT lon FROM cube)""",
)
def _(t):
    rows, cols = axis_index(t.cube, "lat", descending=True), axis_index(t.cube, "lon")
    return rows.select(F.lit("lat").alias("dim"), F.col("lat").alias("label"), "index").unionByName(
        cols.select(F.lit("lon").alias("dim"), F.col("lon").alias("label"), "index")
    )


@query(
    "w4_first_per_key",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1""",
    "l_quantity",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"]
    return first_per(lines, ["l_partkey"], order).drop("l_shipdate")


@query(
    "f18_chunk_ids",
    """SELECT time, lat, lon, (dense_rank() OVER (ORDER BY time) - 1) // 120 AS time_chunk,
  (dense_rank() OVER (ORDER BY lat) - 1) // 4 AS lat_chunk, (dense_rank() OVER (ORDER BY lon) - 1) // 4 AS lon_chunk FROM cube""",
)
def _(t):
    return chunk_ids(t.cube.select(*_K), {"time": 120, "lat": 4, "lon": 4})


@query("t1_concat_time", "SELECT time, lat, lon, TS FROM cube", "TS")
def _(t):
    cube = t.cube.select(*_K, "TS")
    return concat_time(cube.where("day(time) < 10"), cube.where("day(time) BETWEEN 10 AND 20"), cube.where("day(time) > 20"))


@query(
    "t2_concat_forecast",
    """SELECT date::TIMESTAMP AS time, row_number() OVER (PARTITION BY date ORDER BY priority <> '1-URGENT', path) - 1 AS forecast,
  length::DOUBLE AS v FROM granules""",
    "v",
)
def _(t):
    runs = t.granules.select("date", "path", (F.col("priority") != "1-URGENT").alias("is_forecast"))
    cells = t.granules.select(F.lit(None).cast("timestamp_ntz").alias("time"), "path", F.col("length").cast("double").alias("v"))
    return concat_forecast(runs, cells)


_PAD = "(SELECT max(time) AS last, 50 - count(DISTINCT time) % 50 AS m FROM cube)"


@query(
    "t6_pad_time",
    f"""SELECT time, lat, lon, TS FROM cube UNION ALL
SELECT last + to_hours(i), NULL, NULL, NULL FROM (SELECT last, unnest(range(1, m + 1)) AS i FROM {_PAD})""",
    "TS",
)
def _(t):
    return pad_time(t.cube.select(*_K, "TS"), 50, 3600)


@query(
    "t6_pad_time_dense",
    f"""SELECT time, lat, lon, TS FROM cube UNION ALL
SELECT last + to_hours(i), lat, lon, NULL FROM (SELECT last, unnest(range(1, m + 1)) AS i FROM {_PAD}), (SELECT DISTINCT lat, lon FROM cube)""",
    "TS",
)
def _(t):
    return pad_time(t.cube.select(*_K, "TS"), 50, 3600, dense=True)


@query(
    "t7_blank_cube",
    """SELECT date::TIMESTAMP AS time, lat, lon, forecast, NULL::DOUBLE AS TS FROM files,
  (SELECT DISTINCT lat FROM cube), (SELECT DISTINCT lon FROM cube), (SELECT DISTINCT length(event_type) AS forecast FROM events)""",
)
def _(t):
    times = t.files.select(F.col("date").cast("timestamp_ntz").alias("time"))
    axes = [t.cube.select(d).distinct() for d in ("lat", "lon")]
    return blank_cube(times, axes + [t.events.select(F.length("event_type").alias("forecast")).distinct()], ["TS"])


@query(
    "t10_dedupe_time",
    """SELECT time, lat, lon, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY time, lat, lon ORDER BY event_id) AS rn
FROM cube_long) WHERE rn = 1""",
    "value",
)
def _(t):
    return dedupe_time(t.cube_long.select(*_K, "event_id", "value"), "event_id")


@query(
    "t10_relabel_time",
    """SELECT CASE WHEN time = TIMESTAMP '2024-01-03 05:00:00' THEN TIMESTAMP '2014-05-01' ELSE time END AS time, lat, lon, TS FROM cube""",
    "TS",
)
def _(t):
    return relabel_time(t.cube.select(*_K, "TS"), dt.datetime(2024, 1, 3, 5), dt.datetime(2014, 5, 1))
