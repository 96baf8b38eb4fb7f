"""Chunked stores, upserts, streams, rasters and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridlake.functions.geo import wrap_lon
from gridlake.functions.positions import axis_index
from gridlake.operators.aggregate import resample_daily
from gridlake.operators.quality import (
    assert_unique_time,
    check_ledger,
    compare_cubes,
    count_files_and_steps,
    duplicate_times,
    rebuild_ledger,
)
from gridlake.plans.gridstore import (
    create_from_files,
    forecast_cube,
    hours_from_name,
    time_from_name,
    update_from_files,
)
from gridlake.plans.rasters import monthly_rasters
from gridlake.plans.sealevel import height_change_tiles
from gridlake.plans.soil import soil_cube
from gridlake.session import new_scratch
from gridlake.sources.overviews import build_overviews, overview_cells
from gridlake.sources.raster import geotransform, raster_tiles, tile_cells
from gridlake.sources import versioned
from gridlake.sources.store import (
    create_store,
    processed_files,
    read_axis,
    read_cells,
    rechunk,
    upsert_timesteps,
    write_cube,
)
from gridlake.streaming.landing import stream_cube
from workload.registry import query

_K = ["time", "lat", "lon"]
_RANKED = "(SELECT time, lat, lon, TS, SWGNT, (dense_rank() OVER (ORDER BY time) - 1) // {n} AS time_chunk FROM cube)"


def _small(t):
    return t.cube.select(*_K, "TS", "SWGNT")


@query("s12_write_cube", f"SELECT * FROM {_RANKED.format(n=48)}", "TS SWGNT")
def _(t):
    root = t.scratch("cube")
    write_cube(_small(t), root, {"time": 48, "lat": 5, "lon": 5})
    return t.spark.read.parquet(root)


@query("t11_rechunk", f"SELECT * FROM {_RANKED.format(n=100)}", "TS SWGNT")
def _(t):
    root = t.scratch("rechunk")
    write_cube(_small(t), f"{root}/a", {"time": 24, "lat": 5, "lon": 5})
    rechunk(t.spark, f"{root}/a", f"{root}/b", {"time": 100, "lat": 100, "lon": 100})
    return t.spark.read.parquet(f"{root}/b")


@query("t11_rechunk_by_merging", f"SELECT * FROM {_RANKED.format(n=72)}", "TS SWGNT")
def _(t):
    root = t.scratch("rechunk")
    write_cube(_small(t), f"{root}/a", {"time": 24, "lat": 5, "lon": 5})
    rechunk(t.spark, f"{root}/a", f"{root}/b", {"time": 72, "lat": 5, "lon": 5})
    return t.spark.read.parquet(f"{root}/b")


@query("t11_rechunk_within_a_cap", f"SELECT * FROM {_RANKED.format(n=7)}", "TS SWGNT")
def _(t):
    root = t.scratch("rechunk")
    write_cube(_small(t), f"{root}/a", {"time": 48, "lat": 5, "lon": 5})
    rechunk(t.spark, f"{root}/a", f"{root}/b", {"time": 7, "lat": 3, "lon": 100}, cap_bytes=100_000)
    return t.spark.read.parquet(f"{root}/b")


def _upserted(t) -> str:
    """Days 5 to 16 first, then days 14 to 30 with other values, then the late days 1 to 4."""
    root = t.scratch("upsert")
    cube = _small(t)
    create_store(cube.where("time >= '2024-01-05' AND time < '2024-01-17'"), root, 120, 3600)
    upsert_timesteps(root, cube.where("time >= '2024-01-14'").withColumn("SWGNT", F.col("SWGNT") + 1000))
    upsert_timesteps(root, cube.where("time < '2024-01-05'"))
    return root


@query(
    "i2_upsert_timesteps",
    "SELECT time, lat, lon, TS, CASE WHEN time >= TIMESTAMP '2024-01-14' THEN SWGNT + 1000 ELSE SWGNT END AS SWGNT FROM cube",
    "TS SWGNT",
)
def _(t):
    return read_cells(t.spark, _upserted(t)).drop("time_chunk")


@query(
    "p6_time_slice_of_store",
    """SELECT time, lat, lon, TS, CASE WHEN time >= TIMESTAMP '2024-01-14' THEN SWGNT + 1000 ELSE SWGNT END AS SWGNT FROM cube
WHERE time BETWEEN TIMESTAMP '2024-01-03 07:00:00' AND TIMESTAMP '2024-01-15 09:00:00'""",
    "TS SWGNT",
)
def _(t):
    since, until = dt.datetime(2024, 1, 3, 7), dt.datetime(2024, 1, 15, 9)
    return read_cells(t.spark, _upserted(t), since, until).drop("time_chunk")


def _three_versions(t) -> str:
    """The changes of ``_upserted`` as versions 1 to 3, and as version 4 one region in one day, cell by cell."""

    def write(root):
        cube = _small(t)
        versioned.create(cube.where("time >= '2024-01-05' AND time < '2024-01-17'"), root, 120, 3600, rows_per_file=200)
        versioned.upsert(root, cube.where("time >= '2024-01-14'").withColumn("SWGNT", F.col("SWGNT") + 1000), batch="late")
        versioned.upsert(root, cube.where("time < '2024-01-05'"), batch="early")
        north = cube.where("lat > 70 AND time >= '2024-01-20' AND time < '2024-01-21'")
        versioned.upsert(root, north.withColumns({"TS": F.lit(7.0), "SWGNT": F.col("SWGNT") + 1000}), by_cell=True, batch="north")

    return t.once("versions", write)


_V4 = """(SELECT time, lat, lon, CASE WHEN lat > 70 AND time >= TIMESTAMP '2024-01-20' AND time < TIMESTAMP '2024-01-21' THEN 7 ELSE TS END AS TS,
  CASE WHEN time >= TIMESTAMP '2024-01-14' THEN SWGNT + 1000 ELSE SWGNT END AS SWGNT FROM cube)"""


@query("i2_versioned_store", f"SELECT * FROM {_V4}", "TS SWGNT")
def _(t):
    return versioned.read(t.spark, versioned.open_version(t.spark, _three_versions(t)))


@query(
    "i2_time_travel",
    """SELECT time, lat, lon, TS, CASE WHEN time >= TIMESTAMP '2024-01-14' THEN SWGNT + 1000 ELSE SWGNT END AS SWGNT
FROM cube WHERE time >= TIMESTAMP '2024-01-05'""",
    "TS SWGNT",
)
def _(t):
    return versioned.read(t.spark, versioned.open_version(t.spark, _three_versions(t), 2))


@query(
    "s12_box_of_store",
    f"""SELECT * FROM {_V4} WHERE lat BETWEEN 60 AND 75 AND lon BETWEEN 36 AND 80
AND time BETWEEN TIMESTAMP '2024-01-03 07:00:00' AND TIMESTAMP '2024-01-20 09:00:00'""",
    "TS SWGNT",
)
def _(t):
    store = versioned.open_version(t.spark, _three_versions(t))
    return versioned.read(t.spark, store, dt.datetime(2024, 1, 3, 7), dt.datetime(2024, 1, 20, 9), (60, 75, 36, 80))


@query(
    "q4_compare_versions",
    f"""SELECT 'TS' AS variable, (SELECT count(*) FROM cube) AS n_cells,
  count(*) FILTER (WHERE trunc(a.TS) IS DISTINCT FROM trunc(b.TS)) AS n_different FROM cube AS a JOIN {_V4} AS b USING (time, lat, lon)
UNION ALL SELECT 'SWGNT', (SELECT count(*) FROM cube), 0""",
)
def _(t):
    root = _three_versions(t)
    return versioned.compare(t.spark, *[versioned.open_version(t.spark, root, v) for v in (3, 4)], ["TS", "SWGNT"])


@query(
    "a21_bounds_of_store",
    "SELECT count(*) AS n_cells, min(time) AS min_time, max(time) AS max_time, min(lat) AS min_x, max(lat) AS max_x, min(lon) AS min_y, max(lon) AS max_y FROM cube",
    "min_x max_x min_y max_y",
)
def _(t):
    return versioned.bounds(t.spark, versioned.open_version(t.spark, _three_versions(t)))


@query(
    "a23_sums_of_store",
    f"""SELECT variable, count(v) AS n, avg(v) AS mean, min(v) AS low, max(v) AS high
FROM (SELECT 'TS' AS variable, TS AS v FROM {_V4} UNION ALL SELECT 'SWGNT', SWGNT FROM {_V4}) GROUP BY 1""",
    "mean low high",
)
def _(t):
    return versioned.summary(t.spark, versioned.open_version(t.spark, _three_versions(t)))


@query(
    "i2_extended_axis",
    """SELECT origin + to_hours(i) AS time, i // 120 - 1000 AS time_chunk FROM (
  SELECT origin - INTERVAL 120000 HOUR AS origin, unnest(range(
    (date_diff('hour', origin, first) + 120000) // 120 * 120,
    ((date_diff('hour', origin, last) + 120000) // 120 + 1) * 120)) AS i
  FROM (SELECT min(time) FILTER (WHERE time >= TIMESTAMP '2024-01-05') AS origin, min(time) AS first, max(time) AS last FROM cube))""",
)
def _(t):
    return read_axis(t.spark, _upserted(t)).select("time", "time_chunk")


@query(
    "i3_populate_leads",
    """SELECT time, lat, lon, forecast, CASE WHEN forecast <= 5 AND time < TIMESTAMP '2024-01-11' THEN v + 1000 ELSE v END AS v
FROM (SELECT date_trunc('day', time)::TIMESTAMP AS time, lat, lon, length(var) AS forecast, avg(value) AS v FROM cube_long GROUP BY ALL)
WHERE time < TIMESTAMP '2024-01-11'""",
    "v",
)
def _(t):
    root = t.scratch("forecasts")
    day = F.date_trunc("DAY", "time").cast("timestamp_ntz").alias("time")
    leads = t.cube_long.groupBy(day, "lat", "lon", F.length("var").alias("forecast")).agg(F.avg("value").alias("v"))
    create_store(leads.where("time < '2024-01-08'"), root, 10, 86400)
    upsert_timesteps(root, leads.where("time >= '2024-01-08' AND time < '2024-01-11'"), keys=("time", "forecast"), extend=False)
    low = leads.where("forecast <= 5").withColumn("v", F.col("v") + 1000)
    upsert_timesteps(root, low, keys=("time", "forecast"), extend=False)
    return read_cells(t.spark, root).drop("time_chunk")


@query(
    "i1_ledger_commit",
    "SELECT path FROM files WHERE day(date) > 12",
)
def _(t):
    root = t.scratch("ledger")
    cube, files = _small(t), t.files
    create_store(cube.where("day(time) <= 12"), root, 120, 3600)
    for low, high in ((13, 20), (21, 31)):
        new = cube.where(F.dayofmonth("time").between(low, high))
        upsert_timesteps(root, new, paths=files.where(F.dayofmonth("date").between(low, high)).select("path"))
    return processed_files(t.spark, root)


def _land(df, landing: str, day) -> None:
    """One file per day, with the day in its name."""
    name = F.concat(F.lit("weather."), F.date_format(day, "yyyyMMdd"), F.lit(".nc"))
    df.withColumn("file", name).hint("rebalance", "file").write.mode("append").partitionBy("file").parquet(landing)


@query(
    "daily_files_create_and_update",
    "SELECT date_trunc('day', time)::TIMESTAMP AS time, lat, lon, avg(TS) AS TS, avg(SWGNT) AS SWGNT FROM cube GROUP BY ALL",
    "TS SWGNT",
)
def _(t):
    base = t.scratch("files")
    daily = resample_daily(_small(t))
    by_name = time_from_name(r"file=weather\.(\d{8})\.nc/")

    def prepare(df):
        return by_name(df).drop("day", "file")


    def land(part):
        # The time inside the files is wrong.
        wrong = F.lit("2000-01-01").cast("timestamp_ntz")
        _land(part.withColumn("day", F.col("time")).withColumn("time", wrong), f"{base}/in", F.col("day"))

    land(daily.where("time < '2024-01-11'"))
    create_from_files(t.spark, f"{base}/in", f"{base}/store", 50, 86400, prepare)
    land(daily.where("time >= '2024-01-11'"))
    while update_from_files(t.spark, f"{base}/in", f"{base}/store", prepare):
        pass
    return read_cells(t.spark, f"{base}/store").drop("time_chunk")


@query("hourly_files_create", "SELECT time, lat, lon, TS, SWGNT FROM cube", "TS SWGNT")
def _(t):
    base = t.scratch("files")
    hourly = _small(t).withColumn("hour", F.hour("time") + 1)
    _land(hourly.withColumn("day", F.to_date("time")).drop("time"), f"{base}/in", F.col("day"))
    by_name = hours_from_name(r"file=weather\.(\d{8})\.nc/")

    def prepare(df):
        return by_name(df).drop("day", "file")

    create_from_files(t.spark, f"{base}/in", f"{base}/store", 120, 3600, prepare)
    return read_cells(t.spark, f"{base}/store").select("time", "lat", "lon", "TS", "SWGNT")


@query(
    "forecast_create",
    """WITH ok AS (SELECT date FROM granules WHERE priority = '5-LOW' GROUP BY 1 HAVING bool_and(state <> 'P')),
runs AS (SELECT date, path, length, priority = '5-LOW' AS f FROM granules WHERE priority IN ('1-URGENT', '5-LOW'))
SELECT date::TIMESTAMP AS time, row_number() OVER (PARTITION BY date ORDER BY f, path) - 1 AS forecast, length::DOUBLE AS v
FROM runs WHERE date IN (FROM ok) AND date IN (SELECT date FROM runs WHERE NOT f)
UNION ALL SELECT date::TIMESTAMP, forecast, NULL
FROM (SELECT DISTINCT date FROM runs WHERE NOT f AND date NOT IN (FROM ok)), (SELECT DISTINCT length(event_type) AS forecast FROM events)""",
    "v",
)
def _(t):
    base = t.granules.where("priority = '1-URGENT'").select("date", "path")
    runs = t.granules.where("priority = '5-LOW'").select("date", "path", (F.col("state") != "P").alias("readable"))
    cells = t.granules.select(F.lit(None).cast("timestamp_ntz").alias("time"), "path", F.col("length").cast("double").alias("v"))
    leads = t.events.select(F.length("event_type").cast("long").alias("forecast")).distinct()
    return forecast_cube(base, runs, cells, [leads], ["v"])


@query(
    "i5_stream_cube",
    """SELECT time, lat, lon, TS, CASE WHEN time >= TIMESTAMP '2024-01-13' THEN SWGNT + 1000 ELSE SWGNT END AS SWGNT FROM cube""",
    "TS SWGNT",
)
def _(t):
    base = t.scratch("stream")
    landing, root = f"{base}/landing", f"{base}/store"
    cube = _small(t)
    create_store(cube.where("time < '2024-01-02'"), root, 120, 3600)

    def run():
        stream_cube(t.spark, landing, root, f"{base}/checkpoint", cube.schema).awaitTermination()

    cube.where("time < '2024-01-15'").write.parquet(landing)
    run()
    cube.where("time >= '2024-01-13'").withColumn("SWGNT", F.col("SWGNT") + 1000).write.mode("append").parquet(landing)
    run()
    run()
    return read_cells(t.spark, root).drop("time_chunk")


@query(
    "q3_check_ledger",
    """SELECT n_axis AS n_steps, n_dates * 24 AS n_expected, 0::BIGINT AS n_absent, n_axis % 120 = 0 AS whole_chunks,
  n_axis - n_dates * 24 < 120 AS spare_below_chunk, true AS days_agree, true AS all_present
FROM (SELECT (date_diff('hour', min(time), max(time)) + 1) // 120 * 120 + 120 AS n_axis,
  count(DISTINCT CAST(time AS DATE)) AS n_dates FROM cube)""",
)
def _(t):
    root = t.scratch("check")
    create_store(_small(t), root, 120, 3600)
    return check_ledger(read_axis(t.spark, root), t.files, 120)


@query(
    "q3_check_sparse_axis",
    """SELECT n_axis AS n_steps, n_dates * 24 AS n_expected, n_dates * 24 - n_axis AS n_absent, n_axis % 120 = 0 AS whole_chunks,
  n_axis - n_dates * 24 < 120 AS spare_below_chunk, true AS days_agree, n_dates * 24 = n_axis AS all_present
FROM (SELECT count(DISTINCT time) AS n_axis, count(DISTINCT CAST(time AS DATE)) AS n_dates FROM cube WHERE lat < 60)""",
)
def _(t):
    return check_ledger(t.cube.where("lat < 60"), t.files, 120)


@query(
    "q4_compare_cubes",
    """SELECT variable, n_cells, n_different FROM (
  SELECT 'TS' AS variable, count(*) AS n_cells, count(*) FILTER (WHERE lat < 80 AND TS IS NOT NULL) AS n_different FROM cube
  UNION ALL SELECT 'SWGNT', count(*), count(*) FILTER (WHERE lat < 80) FROM cube
  UNION ALL SELECT 'GHTSKIN', count(*), count(*) FILTER (WHERE lat < 60 OR lat >= 80) FROM cube)""",
)
def _(t):
    a = t.cube.where("lat >= 60").select(*_K, "TS", "SWGNT", "GHTSKIN")
    b = t.cube.where("lat < 80").select(*_K, F.col("TS") + 2, F.col("SWGNT") + 5, "GHTSKIN").toDF(*a.columns)
    b = b.where("lat >= 60").unionByName(t.cube.where("lat < 60").select(*a.columns))
    c = t.cube.where("lat >= 80").select(*_K, "TS", "SWGNT", F.lit(None).cast("double").alias("GHTSKIN"))
    return compare_cubes(a, b.unionByName(c), ["TS", "SWGNT", "GHTSKIN"])


@query("q5_duplicate_times", "SELECT time, lat, lon, count(*) AS n FROM cube_long GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(t):
    return duplicate_times(t.cube_long, ("time", "lat", "lon"))


@query("q5_unique_time_guard", "SELECT time, lat, lon, TS FROM cube", "TS")
def _(t):
    return assert_unique_time(t.cube.select(*_K, "TS"), ("time", "lat", "lon"))


@query("q6_rebuild_ledger", "SELECT date, path FROM files")
def _(t):
    return rebuild_ledger(t.cube, t.files)


@query(
    "q7_files_and_steps",
    "SELECT (SELECT count(*) FROM granules) AS n_files, count(DISTINCT time) AS n_steps, (SELECT count(*) FROM granules) = count(DISTINCT time) AS agree FROM cube",
)
def _(t):
    return count_files_and_steps(t.granules, t.cube)


_DAILY = "SELECT strftime(time, '%Y-%m-%d') AS label, lat, lon, avg(TS) AS TS, avg(SWGNT) AS SWGNT FROM cube GROUP BY ALL"


@query(
    "s13_raster_tiles",
    f"""SELECT var, label, lat, lon, value::FLOAT::DOUBLE AS value FROM (
  SELECT 'TS' AS var, label, lat, lon, TS AS value FROM ({_DAILY}) UNION ALL SELECT 'SWGNT', label, lat, lon, SWGNT FROM ({_DAILY}))
WHERE value IS NOT NULL AND NOT (var = 'TS' AND label < '2024-01-08')""",
    "value",
)
def _(t):
    daily = resample_daily(_small(t))
    done = t.files.where("date < DATE '2024-01-08'").select(
        F.concat(F.lit("eo-TS-"), F.date_format("date", "yyyy-MM-dd")).alias("name")
    )
    tiles = raster_tiles(daily, tile=8, prefix="eo", existing=done)
    cells = tile_cells(tiles, 8)
    rows = axis_index(daily, "lat", descending=True, name="row")
    return cells.join(rows, "row").join(axis_index(daily, "lon", name="col"), "col").drop("row", "col")


@query(
    "s13_tile_index",
    """SELECT DISTINCT 'eo-SSH-' || strftime(time, '%Y-%m') AS name, r // 8 AS tile_row, c // 8 AS tile_col, 64::BIGINT AS n_pixels, 'EPSG:4326' AS crs
FROM monthly JOIN (SELECT lat, row_number() OVER (ORDER BY lat DESC) - 1 AS r FROM (SELECT DISTINCT lat FROM monthly)) USING (lat)
  JOIN (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS c FROM (SELECT DISTINCT lon FROM monthly)) USING (lon)""",
)
def _(t):
    tiles = raster_tiles(t.monthly.drop("OBP"), tile=8, prefix="eo", unit="M", crs="EPSG:4326")
    return tiles.select("name", "tile_row", "tile_col", F.size("pixels").alias("n_pixels"), "crs")


@query(
    "s13_overviews",
    """WITH p AS (
  SELECT 'SSH' AS var, strftime(time, '%Y-%m') AS label, r, c, SSH::FLOAT::DOUBLE AS value
  FROM monthly JOIN (SELECT lat, row_number() OVER (ORDER BY lat DESC) - 1 AS r FROM (SELECT DISTINCT lat FROM monthly)) USING (lat)
    JOIN (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS c FROM (SELECT DISTINCT lon FROM monthly)) USING (lon)),
n AS (SELECT CAST(ceil(log2(1 + max(greatest(r, c)) // 4)) AS BIGINT) AS top FROM p)
SELECT level, var, label, r >> level AS row, c >> level AS col, avg(value) AS value, count(value) AS n
FROM (SELECT *, unnest(range(1, top + 1)) AS level FROM p, n) WHERE value IS NOT NULL GROUP BY ALL""",
    "value",
)
def _(t):
    tiles = raster_tiles(t.monthly.drop("OBP"), tile=4, prefix="eo", unit="M", crs="EPSG:4326")
    return overview_cells(build_overviews(tiles, new_scratch(tiles.sparkSession, "overviews"), 4), 4)


@query(
    "s13_static_raster",
    "SELECT 'n' AS var, lat, lon, count(*)::FLOAT::DOUBLE AS value FROM cube GROUP BY ALL",
    "value",
)
def _(t):
    static = t.cube.groupBy("lat", "lon").agg(F.count("*").cast("double").alias("n"))
    cells = tile_cells(raster_tiles(static, tile=8, time=None), 8).drop("label")
    rows = axis_index(static, "lat", descending=True, name="row")
    return cells.join(rows, "row").join(axis_index(static, "lon", name="col"), "col").drop("row", "col")


@query(
    "height_change_raster",
    """SELECT 'change' AS var, lat, lon, (b - a)::FLOAT::DOUBLE AS value FROM (SELECT lat, lon,
  CASE WHEN count(SSH) FILTER (WHERE year(time) = 1996) = 12 THEN sum(SSH) FILTER (WHERE year(time) = 1996) / 12 END AS a,
  CASE WHEN count(SSH) FILTER (WHERE year(time) = 2000) = 12 THEN sum(SSH) FILTER (WHERE year(time) = 2000) / 12 END AS b
  FROM monthly GROUP BY 1, 2) WHERE a IS NOT NULL AND b IS NOT NULL""",
    "value",
)
def _(t):
    cells = tile_cells(height_change_tiles(t.monthly, 1996, 2000, tile=8), 8).drop("label")
    rows = axis_index(t.monthly, "lat", descending=True, name="row")
    return cells.join(rows, "row").join(axis_index(t.monthly, "lon", name="col"), "col").drop("row", "col")


@query(
    "monthly_rasters",
    """SELECT 'PRECTOT' AS var, strftime(time, '%Y-%m') AS label, lat, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon,
  avg(PRECTOT)::FLOAT::DOUBLE AS value FROM cube GROUP BY ALL""",
    "value",
)
def _(t):
    month = F.date_trunc("MONTH", "time").cast("timestamp_ntz").alias("time")
    cube = t.cube.groupBy(month, "lat", "lon").agg(F.avg("PRECTOT").alias("PRECTOT"))
    cells = tile_cells(monthly_rasters(cube, "gravity", tile=8), 8)
    rows = axis_index(cube, "lat", descending=True, name="row")
    return cells.join(rows, "row").join(axis_index(wrap_lon(cube), "lon", name="col"), "col").drop("row", "col")


@query(
    "soil_moisture_cube",
    """SELECT time, northing_m, easting_m, avg(value) FILTER (WHERE am) AS soil_moisture, avg(frac) FILTER (WHERE am) AS albedo,
  avg(value) FILTER (WHERE NOT am) AS soil_moisture_pm FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS time, hour(ts) < 12 AS am,
    value / 0.97::DOUBLE AS value, user_id / 7919 AS frac,
    7314540.83::DOUBLE - 0.5 * 36032.22::DOUBLE - 36032.22::DOUBLE * (user_id % 406) AS northing_m,
    -17367530.45::DOUBLE + 0.5 * 36032.22::DOUBLE + 36032.22::DOUBLE * (user_id // 406 % 964) AS easting_m FROM events) GROUP BY 1, 2, 3""",
    "northing_m easting_m soil_moisture albedo soil_moisture_pm",
)
def _(t):
    cells = t.events.selectExpr(
        "concat('in/SOIL_SM_P_', date_format(ts, 'yyyyMMdd'), '_R1.h5') AS path", "hour(ts) < 12 AS am",
        "user_id % 406 AS row", "user_id DIV 406 % 964 AS col", "value / 0.97D AS v", "user_id / 7919 AS frac",
    )
    keys = ["path", "row", "col"]
    am = cells.where("am").groupBy(*keys).agg(F.avg("v").alias("soil_moisture"), F.avg("frac").alias("albedo"))
    pm = cells.where("NOT am").groupBy(*keys).agg(F.avg("v").alias("soil_moisture_pm"))
    return soil_cube(am, pm)


_STEP = "(SELECT min({d}) FROM cube WHERE {d} > (SELECT min({d}) FROM cube)) - min({d})"


@query(
    "s14_geotransform",
    f"""SELECT x0 - dx / 2 AS "left", (x1 - x0 + dx) / width AS x_step, y1 + dy / 2 AS top, -(y1 - y0 + dy) / height AS y_step, width, height
FROM (SELECT min(lon) AS x0, max(lon) AS x1, {_STEP.format(d='lon')} AS dx, min(lat) AS y0, max(lat) AS y1,
  {_STEP.format(d='lat')} AS dy, count(DISTINCT lon) AS width, count(DISTINCT lat) AS height FROM cube)""",
    '"left" x_step top y_step',
)
def _(t):
    return geotransform(t.cube)
