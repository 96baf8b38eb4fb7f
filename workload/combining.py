"""Joins of cubes, nearest pixels and sea-level components."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators.joins import attach, combine, merge_cubes, nearest_pixels, series_at
from gridlake.operators.timeaxis import stored_times
from gridlake.plans.sealevel import gauge_components, gauge_pixels
from gridlake.sources.sinks import series_long
from workload.registry import query

_K = ["time", "lat", "lon"]


@query(
    "j1_merge_cubes",
    """SELECT time, lat, lon, TS, HFLUX, PRECTOT FROM (SELECT time, lat, lon, TS FROM cube WHERE lat > 60)
FULL JOIN (SELECT time, lat, lon, HFLUX FROM cube WHERE lon < 200) USING (time, lat, lon)
FULL JOIN (SELECT time, lat, lon, PRECTOT FROM cube WHERE lat < 75) USING (time, lat, lon)""",
    "TS HFLUX PRECTOT",
)
def _(t):
    return merge_cubes(
        t.cube.where("lat > 60").select(*_K, "TS"),
        t.cube.where("lon < 200").select(*_K, "HFLUX"),
        t.cube.where("lat < 75").select(*_K, "PRECTOT"),
    )


@query(
    "j2_attach",
    """SELECT time, lat, lon, a.TS, b.PRECTOT FROM cube a
LEFT JOIN (SELECT time, lat, lon, PRECTOT FROM cube WHERE SWGNT > 20) b USING (time, lat, lon)""",
    "TS PRECTOT",
)
def _(t):
    return attach(t.cube.select(*_K, "TS"), t.cube.where("SWGNT > 20").select(*_K, "PRECTOT"))


@query("j3_combine", "SELECT time, lat, lon, SSH - OBP AS steric FROM monthly WHERE OBP > 0.26", "steric")
def _(t):
    a, b = t.monthly.select(*_K, "SSH"), t.monthly.where("OBP > 0.26").select(*_K, "OBP")
    return combine(a, b, steric=F.col("SSH") - F.col("OBP"))


@query(
    "j6_times_in_store",
    """SELECT time, lat, lon, SWGNT, time IN (SELECT time FROM cube WHERE lat < 60) AS stored FROM cube""",
    "SWGNT",
)
def _(t):
    axis = t.cube.where("lat < 60").select("time")
    cube = t.cube.select(*_K, "SWGNT")
    found = stored_times(cube, axis).withColumn("stored", F.lit(True))
    return found.unionByName(stored_times(cube, axis, present=False).withColumn("stored", F.lit(False)))


_PIXELS = """SELECT gauge, g.lat, g.lon, arg_min(c.lat, (d, c.lat, c.lon)) AS pixel_lat,
  arg_min(c.lon, (d, c.lat, c.lon)) AS pixel_lon, min(d) AS distance
FROM gauges g, LATERAL (SELECT c.lat, c.lon, sqrt((c.lon - g.lon) * (c.lon - g.lon) + (c.lat - g.lat) * (c.lat - g.lat)) AS d
  FROM (SELECT lat, lon FROM monthly WHERE time = (SELECT min(time) FROM monthly) AND SSH IS NOT NULL) c) c
GROUP BY 1, 2, 3"""


@query("j7_nearest_pixels", _PIXELS, "lat distance")
def _(t):
    return gauge_pixels(t.monthly, t.gauges, "SSH")


@query(
    "j7_nearest_cell_of_each_user",
    """SELECT c_custkey, p.lat, p.lon, arg_min(c.lat, (d, c.lat, c.lon)) AS pixel_lat,
  arg_min(c.lon, (d, c.lat, c.lon)) AS pixel_lon, min(d) AS distance
FROM (SELECT c_custkey, 50 + c_nationkey * 1.3::DOUBLE AS lat, c_acctbal / 31.7::DOUBLE AS lon FROM customer) p,
  LATERAL (SELECT c.lat, c.lon, sqrt((c.lon - p.lon) * (c.lon - p.lon) + (c.lat - p.lat) * (c.lat - p.lat)) AS d
  FROM (SELECT DISTINCT lat, lon FROM cube) c) c GROUP BY 1, 2, 3""",
    "lat lon distance",
)
def _(t):
    users = t.customer.select(
        "c_custkey", F.expr("50 + c_nationkey * 1.3D").alias("lat"), (F.col("c_acctbal") / 31.7).alias("lon")
    )
    return nearest_pixels(t.cube, users, per_leaf=16)


@query(
    "j8_series_at_pixels",
    f"SELECT gauge, time, pixel_lat, pixel_lon, SSH FROM ({_PIXELS}) p JOIN monthly m ON m.lat = pixel_lat AND m.lon = pixel_lon",
    "SSH",
)
def _(t):
    pixels = gauge_pixels(t.monthly, t.gauges, "SSH").select("gauge", "pixel_lat", "pixel_lon")
    return series_at(t.monthly.drop("OBP"), pixels)


@query(
    "a11_decompose",
    f"""SELECT gauge, time, SSH AS total, OBP AS barystatic, SSH - OBP AS steric
FROM ({_PIXELS}) p JOIN monthly m ON m.lat = pixel_lat AND m.lon = pixel_lon""",
    "total barystatic steric",
)
def _(t):
    return gauge_components(t.monthly.drop("OBP"), t.monthly.drop("SSH"), t.gauges)


@query(
    "s15_series_long",
    f"""SELECT gauge, strftime(time, '%m/%Y') AS date, source, printf('%.6f', v) AS value
FROM ({_PIXELS}) p JOIN monthly m ON m.lat = pixel_lat AND m.lon = pixel_lon,
  LATERAL (VALUES ('Total', SSH), ('Barystatic', OBP), ('Steric', SSH - OBP)) AS s(source, v)""",
)
def _(t):
    return series_long(gauge_components(t.monthly.drop("OBP"), t.monthly.drop("SSH"), t.gauges), keys=("gauge",))
