"""Means, changes, trends, melt and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.geo import wrap_lon
from gridlake.functions.times import month_index
from gridlake.operators import aggregate as a
from gridlake.operators.energy import energy_flux, melt_rate, previous_value, surface_temperature
from gridlake.plans.reanalysis import daily_mass, daily_melt, melt_from_files, regional_daily_mean
from workload.registry import query

_K = ["time", "lat", "lon"]
_ALL = "TS SWGNT LWGAB HFLUX EFLUX GHTSKIN PRECTOT"
_MEANS = ", ".join(f"avg({v}) AS {v}" for v in _ALL.split())
_DAY = "date_trunc('day', time)::TIMESTAMP AS time"
_WRAPPED = "(SELECT * REPLACE (CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon) FROM cube)"
_GREENLAND = "lat BETWEEN 55 AND 90 AND lon BETWEEN -80 AND -10"


@query(
    "regional_daily_mean",
    f"""SELECT time, {_MEANS} FROM (SELECT {_DAY}, lat, lon, {_MEANS} FROM {_WRAPPED} c
  WHERE {_GREENLAND} GROUP BY ALL) GROUP BY 1""",
    _ALL,
)
def _(t):
    return regional_daily_mean(t.cube, "GrIS")


@query("a1_daily_mean", f"SELECT {_DAY}, lat, lon, {_MEANS} FROM cube GROUP BY ALL", _ALL)
def _(t):
    return a.resample_daily(t.cube, "mean")


@query(
    "a1_daily_mean_filled",
    f"""WITH d AS (SELECT {_DAY}, lat, lon, avg(TS) AS TS FROM cube GROUP BY ALL),
s AS (SELECT lat, lon, time FROM (SELECT DISTINCT lat, lon FROM d),
  (SELECT unnest(generate_series(min(time), max(time), INTERVAL 1 DAY)) AS time FROM d))
SELECT time, lat, lon, TS FROM s LEFT JOIN d USING (time, lat, lon)""",
    "TS",
)
def _(t):
    return a.resample_daily(t.cube.select(*_K, "TS"), "mean", fill_gaps=True)


@query(
    "a2_daily_sum",
    f"SELECT {_DAY}, lat, lon, coalesce(sum(PRECTOT), 0) * 3600 / 1000 AS PRECTOT, coalesce(sum(TS), 0) * 3600 / 1000 AS TS FROM cube GROUP BY ALL",
    "PRECTOT TS",
)
def _(t):
    sums = a.resample_daily(t.cube.select(*_K, "PRECTOT", "TS"), "sum", 3600)
    return sums.withColumns({c: F.col(c) / 1000 for c in ("PRECTOT", "TS")})  # ten digits, to 6 decimals


@query(
    "a2_daily_mass",
    f"""SELECT {_DAY}, lat, lon, avg(TS) AS TS, sum(PRECTOT) * 3600 AS PRECTOT,
  coalesce(sum(CASE WHEN hour(time) % 3 = 0 THEN EFLUX END), 0) * 10800 AS RUNOFF FROM cube GROUP BY ALL""",
    "TS PRECTOT RUNOFF",
)
def _(t):
    runoff = t.cube.select(*_K, F.when(F.hour("time") % 3 == 0, F.col("EFLUX")).alias("RUNOFF"))
    return daily_mass(t.cube.select(*_K, "PRECTOT"), t.cube.select(*_K, "TS"), runoff)


@query("a3_spatial_mean", "SELECT time, avg(value) AS value FROM cube_long GROUP BY 1", "value")
def _(t):
    return a.spatial_mean(t.cube_long.select(*_K, "value"))


@query("a4_annual_mean", "SELECT year(time) AS year, avg(SSH) AS SSH, avg(OBP) AS OBP FROM monthly GROUP BY 1", "SSH OBP")
def _(t):
    return a.annual_mean(t.monthly)


@query(
    "a5_mean_over_dims",
    "SELECT lat, lon, avg(value) AS value FROM cube_long GROUP BY 1, 2",
    "value",
)
def _(t):
    leads = t.cube_long.select(*_K, F.length("var").alias("forecast"), "value")
    return a.mean_over(leads, ["time", "forecast"])


@query(
    "a6_year_mean",
    """SELECT lat, lon, CASE WHEN count(SSH) = 12 THEN sum(SSH) / 12 END AS SSH FROM monthly WHERE year(time) = 1998 GROUP BY 1, 2""",
    "SSH",
)
def _(t):
    return a.year_mean(t.monthly, 1998, "SSH")


@query(
    "a6_year_mean_first_file",
    """SELECT lat, lon, CASE WHEN count(v) = 12 THEN sum(v) / 12 END AS v FROM (
  SELECT lat, lon, month(time) AS m, arg_min(v, path) AS v FROM (
    SELECT lat, lon, time, SSH AS v, 'b' AS path FROM monthly UNION ALL SELECT lat, lon, time, OBP, 'a' FROM monthly WHERE lat < 20)
  WHERE year(time) = 1999 GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "v",
)
def _(t):
    files = t.monthly.select(*_K, F.col("SSH").alias("v"), F.lit("b").alias("path")).unionByName(
        t.monthly.where("lat < 20").select(*_K, F.col("OBP").alias("v"), F.lit("a").alias("path"))
    )
    return a.year_mean(files, 1999, "v", path="path")


@query(
    "a7_year_change",
    """SELECT lat, lon, CASE WHEN count(CASE WHEN year(time) = 2000 THEN SSH END) = 12
  THEN sum(CASE WHEN year(time) = 2000 THEN SSH END) / 12 END - CASE WHEN count(CASE WHEN year(time) = 1996 THEN SSH END) = 12
  THEN sum(CASE WHEN year(time) = 1996 THEN SSH END) / 12 END AS change
FROM monthly WHERE year(time) IN (1996, 2000) GROUP BY 1, 2""",
    "change",
)
def _(t):
    return a.year_change(t.monthly, 1996, 2000, "SSH")


@query("a8_yearly_mean", "SELECT lat, lon, year(time) AS year, avg(SSH) AS SSH FROM monthly GROUP BY 1, 2, 3", "SSH")
def _(t):
    return a.yearly_mean(t.monthly, ["lat", "lon"], "SSH")


@query(
    "a8_yearly_mean_11_months",
    "SELECT lat, lon, year(time) AS year, avg(CASE WHEN month(time) <= 11 THEN SSH END) AS SSH FROM monthly GROUP BY 1, 2, 3",
    "SSH",
)
def _(t):
    return a.yearly_mean(t.monthly, ["lat", "lon"], "SSH", months=11)


_INDEX = "(year(time) - 1995) * 12 + month(time) - 1"


def _indexed(t):
    return t.monthly.select(*_K, "SSH", month_index("time", 1995).alias("month_index"))


@query("w5_month_index", f"SELECT time, lat, lon, SSH, {_INDEX} AS month_index FROM monthly", "SSH")
def _(t):
    return _indexed(t)


@query(
    "a9_linear_trend",
    f"""SELECT lat, lon, regr_slope(SSH, {_INDEX}) AS slope, regr_intercept(SSH, {_INDEX}) AS intercept,
  regr_slope(SSH, {_INDEX}) * 12000 AS mm_per_year FROM monthly GROUP BY 1, 2""",
    "slope intercept mm_per_year",
)
def _(t):
    return a.linear_trend(_indexed(t), ["lat", "lon"], "SSH")


@query(
    "a9_trend_of_whole_series",
    f"""SELECT lat, lon, CASE WHEN count(*) = 83 THEN regr_slope(SSH, {_INDEX}) * 12000 END AS mm_per_year
FROM monthly GROUP BY 1, 2""",
    "mm_per_year",
)
def _(t):
    return a.linear_trend(_indexed(t), ["lat", "lon"], "SSH", expected=83).drop("slope", "intercept")


@query(
    "a10_trend_line",
    f"""SELECT m.time, lat, lon, SSH, {_INDEX} AS month_index, intercept + slope * ({_INDEX}) AS trend
FROM monthly m JOIN (SELECT lat, lon, regr_slope(SSH, {_INDEX}) AS slope, regr_intercept(SSH, {_INDEX}) AS intercept
  FROM monthly GROUP BY 1, 2) USING (lat, lon)""",
    "SSH trend",
)
def _(t):
    return a.trend_line(_indexed(t), ["lat", "lon"], "SSH")


@query("a12_energy_flux", "SELECT time, lat, lon, SWGNT + LWGAB - HFLUX - EFLUX + GHTSKIN AS flux FROM cube", "flux")
def _(t):
    return energy_flux(t.cube).select(*_K, "flux")


_LAGGED = """(SELECT *, CASE WHEN row_number() OVER w = 1 THEN TS ELSE lag(TS) OVER w END AS TS_before FROM cube
  WINDOW w AS (PARTITION BY lat, lon, year(time) ORDER BY time))"""


@query("a13_previous_temperature", f"SELECT time, lat, lon, TS, TS_before FROM {_LAGGED}", "TS TS_before")
def _(t):
    return previous_value(t.cube.select(*_K, "TS"), "TS", "TS_before")


@query("w1_previous_in_year", f"SELECT time, lat, lon, TS, TS_before FROM {_LAGGED}", "TS TS_before")
def _(t):
    return previous_value(t.cube.select(*_K, "TS"), "TS", "TS_before", unit="MONTH")


_KFLUX = f"({fixed.STEP_SECONDS}::DOUBLE / ({fixed.ICE_HEAT_CAPACITY}::DOUBLE * {fixed.LAYER_MASS}::DOUBLE))"
_A = f"({fixed.STEFAN_BOLTZMANN!r}::DOUBLE * {_KFLUX})"


def _newton(source: str, steps: int = 6) -> str:
    sql = f"SELECT *, CASE WHEN c > 0 THEN c END AS x FROM (SELECT *, flux * {_KFLUX} + TS_before AS c FROM {source})"
    for _ in range(steps):
        sql = f"SELECT * REPLACE ((3 * {_A} * x * x * x * x + c) / (4 * {_A} * x * x * x + 1) AS x) FROM ({sql})"
    return sql


_FLUXED = f"(SELECT *, SWGNT + LWGAB - HFLUX - EFLUX + GHTSKIN AS flux FROM {_LAGGED})"
_MELTED = f"""(SELECT *, CASE WHEN x >= 273.15 THEN 273.15::DOUBLE ELSE x END AS TScalc,
  CASE WHEN x >= 273.15 THEN (flux - 5.67e-8 * 273.15::DOUBLE * 273.15 * 273.15 * 273.15) / 333500 ELSE 0::DOUBLE END AS SMELT
  FROM ({_newton(_FLUXED)}))"""


@query("a14_surface_temperature", f"SELECT time, lat, lon, x AS TScalc FROM ({_newton(_FLUXED)})", "TScalc")
def _(t):
    cube = previous_value(energy_flux(t.cube), "TS", "TS_before")
    return surface_temperature(cube).select(*_K, "TScalc")


@query("a15_melt_rate", f"SELECT time, lat, lon, TScalc, SMELT FROM {_MELTED}", "TScalc SMELT")
def _(t):
    cube = previous_value(energy_flux(t.cube), "TS", "TS_before")
    return melt_rate(surface_temperature(cube)).select(*_K, "TScalc", "SMELT")


@query(
    "a16_daily_melt",
    f"""SELECT {_DAY}, lat, lon, avg(SWGNT) AS SWGNT, avg(LWGAB) AS LWGAB, avg(TS) AS TS, avg(TScalc) AS TScalc,
  avg(SMELT) AS SMELT, avg(PRECTOT) AS PRECSN, avg(HFLUX) AS HFLUX, avg(EFLUX) AS EFLUX, avg(GHTSKIN) AS GHTSKIN, avg(TS - 1) AS T2M
FROM {_MELTED} WHERE lat BETWEEN 55 AND 90 GROUP BY ALL""",
    "SWGNT LWGAB TS TScalc SMELT PRECSN HFLUX EFLUX GHTSKIN T2M",
)
def _(t):
    cube = t.cube
    rad = cube.select(*_K, "SWGNT", "LWGAB", "TS")
    int_ = cube.select(*_K, F.col("PRECTOT").alias("PRECSN"))
    flx = cube.select(*_K, "HFLUX", "EFLUX", "GHTSKIN")
    slv = cube.select(*_K, (F.col("TS") - 1).alias("T2M"))
    return daily_melt(rad, int_, flx, slv, (55.0, 90.0, 0.0, 360.0))


@query(
    "daily_melt_from_files",
    f"""SELECT {_DAY}, lat, lon, avg(SWGNT / 300) AS ALBEDO, avg(LWGAB) AS LWGAB, avg(LWGAB + 1) AS LWGEM, -1::DOUBLE AS LWGNT,
  avg(SWGNT * 1.3::DOUBLE) AS SWGDN, avg(SWGNT) AS SWGNT, avg(TS) AS TS, avg(TScalc) AS TScalc, avg(SMELT) AS SMELT,
  avg(PRECTOT) AS PRECCU, avg(PRECTOT / 3) AS PRECLS, avg(PRECTOT / 7) AS PRECSN, avg(PRECTOT / 11) AS EVAP,
  avg(HFLUX) AS HFLUX, avg(EFLUX) AS EFLUX, avg(GHTSKIN) AS GHTSKIN, avg(SWGNT / 13) AS PS, avg(TS - 1) AS T2M,
  avg(SWGNT / 17) AS U2M, avg(SWGNT / 19) AS V2M, avg(SWGNT / 23) AS QV2M
FROM {_MELTED.replace('FROM cube', 'FROM ' + _WRAPPED + ' c')} WHERE {_GREENLAND} GROUP BY ALL""",
    "ALBEDO LWGAB LWGEM LWGNT SWGDN SWGNT TS TScalc SMELT PRECCU PRECLS PRECSN EVAP HFLUX EFLUX GHTSKIN PS T2M U2M V2M QV2M",
)
def _(t):
    root = t.scratch("melt")
    cube = wrap_lon(t.cube)
    products = {
        "rad": "SWGNT / 300 AS ALBEDO, LWGAB, LWGAB + 1 AS LWGEM, -1D AS LWGNT, SWGNT * 1.3D AS SWGDN, SWGNT, TS",
        "int": "PRECTOT AS PRECCU, PRECTOT / 3 AS PRECLS, PRECTOT / 7 AS PRECSN",
        "flx": "PRECTOT / 11 AS EVAP, HFLUX, EFLUX, GHTSKIN",
        "slv": "SWGNT / 13 AS PS, TS - 1 AS T2M, SWGNT / 17 AS U2M, SWGNT / 19 AS V2M, SWGNT / 23 AS QV2M",
    }
    for name, columns in products.items():
        cube.selectExpr(*_K, *columns.split(", ")).write.parquet(f"{root}/{name}")
    melt_from_files(t.spark, {name: f"{root}/{name}" for name in products}, f"{root}/daily", "GrIS")
    return t.spark.read.parquet(f"{root}/daily").drop("year")


@query(
    "a21_extent",
    """SELECT min(lat)::VARCHAR AS southernmost, max(lat)::VARCHAR AS northernmost, min(lon)::VARCHAR AS westernmost,
  max(lon)::VARCHAR AS easternmost, strftime(min(time), '%Y-%m-%d %H:%M:%S') AS range_beginning,
  strftime(max(time), '%Y-%m-%d %H:%M:%S') AS range_ending FROM cube""",
)
def _(t):
    return a.extent(t.cube)


@query(
    "a21_dataset_attributes",
    """UNPIVOT (SELECT min(lat)::VARCHAR AS SouthernmostLatitude, max(lat)::VARCHAR AS NorthernmostLatitude,
  min(lon)::VARCHAR AS WesternmostLongitude, max(lon)::VARCHAR AS EasternmostLongitude,
  strftime(min(time), '%Y-%m-%d %H:%M:%S') AS RangeBeginningDate,
  strftime(max(time), '%Y-%m-%d %H:%M:%S') AS RangeEndingDate, 'daily' AS comment1 FROM cube)
ON COLUMNS(*) INTO NAME key VALUE value""",
)
def _(t):
    return a.dataset_attributes(t.cube, comment1="daily").select(F.explode("attrs"))


@query(
    "a22_size_summary",
    """SELECT count(length) AS count, avg(length) AS mean, stddev_samp(length) AS std, min(length)::DOUBLE AS min,
  quantile_cont(length, 0.25)::DOUBLE AS q25, quantile_cont(length, 0.5)::DOUBLE AS q50,
  quantile_cont(length, 0.75)::DOUBLE AS q75, max(length)::DOUBLE AS max FROM granules""",
    "mean std min q25 q50 q75 max",
)
def _(t):
    # In bytes again: quartiles of MB would end exactly on a half of the sixth decimal.
    summary = a.size_summary(t.granules)
    return summary.select("count", *[(F.col(c) * 1e6).alias(c) for c in summary.columns[1:]])


@query("a23_valid_count", "SELECT count(TS) AS n FROM cube")
def _(t):
    return a.valid_count(t.cube, "TS")


@query(
    "a24_chunk_plan",
    """SELECT chunk, count(*) AS n_files, min(path) AS first_path, max(path) AS last_path
FROM (SELECT path, (row_number() OVER (ORDER BY path) - 1) // 365 AS chunk FROM granules) GROUP BY 1""",
)
def _(t):
    return a.chunk_plan(t.granules, 365)
