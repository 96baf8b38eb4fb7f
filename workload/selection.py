"""Projections and filters over cubes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridlake import model
from gridlake.operators.aggregate import resample_daily
from gridlake.operators.axes import blank_steps
from gridlake.operators import select as s
from gridlake.operators.timeaxis import classify_dates
from workload.registry import query

_ALL = "TS SWGNT LWGAB HFLUX EFLUX GHTSKIN PRECTOT"


@query("p1_select_variables", "SELECT time, lat, lon, SWGNT, TS FROM cube", "SWGNT TS")
def _(t):
    return s.select_variables(t.cube, ["SWGNT", "TS"])


@query("p1_select_by_prefix", "SELECT time, lat, lon, LWGAB FROM cube", "LWGAB")
def _(t):
    return s.select_variables(t.cube, prefix="LW")


@query(
    "p2_rename_suffix",
    "SELECT time, lat AS orig_lat, lon AS orig_lon, TS AS TS_pm, SWGNT AS SWGNT_pm FROM cube",
    "TS_pm SWGNT_pm",
)
def _(t):
    cube = s.select_variables(t.cube, ["TS", "SWGNT"])
    return s.rename_dims(s.suffix_variables(cube, "_pm"), {"lat": "orig_lat", "lon": "orig_lon"})


@query("p3_reorder", "SELECT acq_date, event_id, satellite, frp FROM det", "frp")
def _(t):
    return s.reorder_first(t.det.select("event_id", "satellite", "frp", "acq_date"), "acq_date")


@query("p4_cast_matching", "SELECT event_id, bright_t31, brightness::VARCHAR AS brightness FROM det", "bright_t31")
def _(t):
    text = t.det.select("event_id", F.col("bright_t31").cast("string"), F.col("brightness").cast("string"))
    return s.cast_matching(text, "^bright_", "double")


@query(
    "p5_bbox",
    f"""SELECT * REPLACE (CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon) FROM cube
WHERE lat BETWEEN 55 AND 90 AND (CASE WHEN lon > 180 THEN lon - 360 ELSE lon END) BETWEEN -80 AND -10""",
    _ALL,
)
def _(t):
    return t.cube.transform(s.wrapped_bbox, "GrIS")


@query("p6_time_slice", "SELECT * FROM cube WHERE CAST(time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'", _ALL)
def _(t):
    return s.time_slice(t.cube, dt.date(2024, 1, 5), dt.date(2024, 1, 12))


@query(
    "p10_positions",
    """SELECT c.* FROM cube c JOIN (SELECT time, row_number() OVER (ORDER BY time) - 1 AS i FROM (SELECT DISTINCT time FROM cube)) a
USING (time) WHERE i >= 4 AND i < 200 AND (i - 4) % 24 = 0""",
    _ALL,
)
def _(t):
    return s.isel(t.cube, "time", 4, 200, 24)


@query("p11_labels", "SELECT * FROM cube WHERE time = TIMESTAMP '2024-01-09 10:00:00' AND lat = 55", _ALL)
def _(t):
    return s.sel(t.cube, time=dt.datetime(2024, 1, 9, 10), lat=55.0)


@query(
    "p12_nearest_labels",
    """SELECT * FROM cube
WHERE lat = (SELECT lat FROM cube ORDER BY abs(lat - 61.2), lat DESC LIMIT 1)
  AND lon = (SELECT lon FROM cube ORDER BY abs(lon - 90), lon DESC LIMIT 1)""",
    _ALL,
)
def _(t):
    return s.sel_nearest(t.cube, lat=61.2, lon=90.0)


_RUNS = """(SELECT date, count(*) AS n, bool_and(state <> 'P') AS ok FROM granules WHERE priority = '5-LOW' GROUP BY 1)"""


def _runs(t):
    base = t.granules.select("date").distinct()
    runs = t.granules.where("priority = '5-LOW'").select("date", "path", (F.col("state") != "P").alias("readable"))
    return base, runs


@query(
    "p13_classify_dates",
    f"""SELECT date, coalesce(n, 0) AS n_forecasts, CASE WHEN coalesce(ok, false) THEN 'complete' ELSE 'blank' END AS status
FROM (SELECT DISTINCT date FROM granules) LEFT JOIN {_RUNS} USING (date)""",
)
def _(t):
    return classify_dates(*_runs(t), mode="blank")


@query("p13_skip_dates", f"SELECT date, n AS n_forecasts, 'complete' AS status FROM {_RUNS} WHERE ok")
def _(t):
    return classify_dates(*_runs(t), mode="skip")


@query(
    "t8_blank_steps",
    f"""SELECT date + to_hours(h) AS time, lat, NULL::DOUBLE AS TS
FROM (SELECT date FROM (SELECT DISTINCT date FROM granules) LEFT JOIN {_RUNS} USING (date) WHERE NOT coalesce(ok, false)),
  (SELECT DISTINCT lat FROM cube), (SELECT unnest(range(24)) AS h)""",
)
def _(t):
    blank = classify_dates(*_runs(t)).where("status = 'blank'")
    return blank_steps(blank, [t.cube.select("lat").distinct()], ["TS"], hours=24)


@query(
    "p14_add_dim",
    "SELECT event_id, DATE '2024-03-01' AS run, 'MODIS' AS instrument, NULL::DOUBLE AS type FROM events",
)
def _(t):
    df = s.add_dim(t.events.select("event_id"), "run", dt.date(2024, 3, 1), "date")
    return s.add_dim(s.add_dim(df, "instrument", "MODIS", "string"), "type", None, "double")


@query(
    "p15_attributes",
    "SELECT date_trunc('day', time)::TIMESTAMP AS time, lat, lon, avg(TS) AS TS, 'K' AS units, 'skin' AS long_name FROM cube GROUP BY 1, 2, 3",
    "TS",
)
def _(t):
    cube = model.set_attrs(t.cube.select("time", "lat", "lon", "TS"), "TS", {"units": "K", "long_name": "skin"})
    daily = resample_daily(cube)
    kept = model.attrs(daily, "TS")
    return daily.withColumns({k: F.lit(v) for k, v in kept.items()})


@query(
    "p16_fill_and_mask",
    """SELECT event_id, coalesce(v, -9999) AS filled, CASE WHEN value <> 6.55 THEN value END AS masked
FROM events JOIN (SELECT event_id, value AS v FROM cube_long) USING (event_id)""",
    "filled masked",
)
def _(t):
    filled = t.cube_long.select("event_id", F.col("value").alias("filled"))
    df = filled.join(t.events.select("event_id", F.col("value").alias("masked")), "event_id")
    return df.transform(s.fill_nodata, ["filled"], -9999.0).transform(s.mask_nodata, ["masked"], 6.55)


@query("p17_grid_reference", "SELECT time, lat, lon, TS, 'EPSG:4326' AS crs, 'x' AS lon_axis, 'y' AS lat_axis FROM cube", "TS")
def _(t):
    cube = model.set_crs(t.cube.select("time", "lat", "lon", "TS"), 4326)
    return cube.withColumns(
        {
            "crs": F.lit(model.crs_of(cube)),
            "lon_axis": F.lit(model.attrs(cube, "lon")["axis"]),
            "lat_axis": F.lit(model.attrs(cube, "lat")["axis"]),
        }
    )


@query("o1_sort_by_time", "SELECT time, lat, lon, TS FROM cube ORDER BY 1, 2, 3", "TS")
def _(t):
    return s.sort_by_time(s.select_variables(t.cube, ["TS"]), "lat", "lon")


@query("o2_raster_order", "SELECT DISTINCT lat, lon FROM cube ORDER BY lat DESC, lon")
def _(t):
    return s.raster_order(t.cube.select("lat", "lon").distinct())


@query("o4_top_k", "SELECT path, length FROM granules ORDER BY length DESC, path LIMIT 40")
def _(t):
    return s.top_k(t.granules.select("path", "length"), 40, F.desc("length"), F.asc("path"))
