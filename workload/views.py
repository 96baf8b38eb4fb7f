"""Cubes, detections and manifests over the test tables, for Spark and for DuckDB.

Every view keeps all rows of its table, and its cells or files grow with the table.
Divisors are such that means do not end exactly on a half, which two engines that add
in different orders would round differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import new_scratch

# name: (tables and views used, Spark text, DuckDB text)
_LAT = "CAST(50 + 2.5 * (user_id % 15) AS DOUBLE) + ((user_id DIV 307200) % 128) / 64D"
_LAT_DUCK = _LAT.replace("DIV", "//").replace("64D", "64::DOUBLE")
_VIEWS: dict[str, tuple[tuple[str, ...], str, str]] = {
    "cube_long": (
        ("events",),
        f"""SELECT event_id, CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS time, {_LAT} AS lat,
  CAST(36 * ((user_id DIV 15 + user_id % 15) % 10) AS DOUBLE) + ((user_id DIV 150) % 2048) / 64D AS lon,
  event_type AS var, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 0.97D END AS value
FROM {{events}}""",
        f"""SELECT event_id, date_trunc('hour', ts) AS time, {_LAT_DUCK} AS lat,
  CAST(36 * ((user_id // 15 + user_id % 15) % 10) AS DOUBLE) + ((user_id // 150) % 2048) / 64::DOUBLE AS lon,
  event_type AS var, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value / 0.97::DOUBLE END AS value
FROM events""",
    ),
    "cube": (
        ("events",),
        f"""SELECT time, lat, lon, CASE WHEN k > 97 THEN NULL ELSE 255D + k / 3.97D END AS TS, v AS SWGNT,
  200D + v / 2 AS LWGAB, n / 0.37D AS HFLUX, k / 9.7D AS EFLUX, -1.5D AS GHTSKIN, v / 3600 AS PRECTOT
FROM (SELECT CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS time, {_LAT} AS lat,
  CAST(36 * ((user_id DIV 15 + user_id % 15) % 10) AS DOUBLE) + ((user_id DIV 150) % 2048) / 64D AS lon,
  avg(value / 0.97D) AS v, CAST(count(*) AS DOUBLE) AS n, avg(CAST(get_json_object(props, '$.k') AS DOUBLE)) AS k
  FROM {{events}} GROUP BY 1, 2, 3)""",
        f"""SELECT time, lat, lon, CASE WHEN k > 97 THEN NULL ELSE 255::DOUBLE + k / 3.97::DOUBLE END AS TS, v AS SWGNT,
  200::DOUBLE + v / 2 AS LWGAB, n / 0.37::DOUBLE AS HFLUX, k / 9.7::DOUBLE AS EFLUX, -1.5::DOUBLE AS GHTSKIN,
  v / 3600 AS PRECTOT
FROM (SELECT date_trunc('hour', ts) AS time, {_LAT_DUCK} AS lat,
  CAST(36 * ((user_id // 15 + user_id % 15) % 10) AS DOUBLE) + ((user_id // 150) % 2048) / 64::DOUBLE AS lon,
  avg(value / 0.97::DOUBLE) AS v, CAST(count(*) AS DOUBLE) AS n, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS k
  FROM events GROUP BY 1, 2, 3)""",
    ),
    "monthly": (
        ("lineitem",),
        """SELECT CAST(date_trunc('MONTH', l_shipdate) AS TIMESTAMP_NTZ) AS time,
  10D + 5 * ((l_suppkey % 20) DIV 5) + ((l_suppkey DIV 20) % 256) / 64D AS lat,
  80D + 5 * (l_suppkey % 5) + ((l_suppkey DIV 5120) % 256) / 64D AS lon, avg(l_extendedprice) / 9973 AS SSH, avg(l_quantity) / 97 AS OBP
FROM {lineitem} GROUP BY 1, 2, 3""",
        """SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS time,
  10::DOUBLE + 5 * ((l_suppkey % 20) // 5) + ((l_suppkey // 20) % 256) / 64::DOUBLE AS lat,
  80::DOUBLE + 5 * (l_suppkey % 5) + ((l_suppkey // 5120) % 256) / 64::DOUBLE AS lon, avg(l_extendedprice) / 9973 AS SSH, avg(l_quantity) / 97 AS OBP
FROM lineitem GROUP BY 1, 2, 3""",
    ),
    # On some days a satellite is silent: its rows go to the next one.
    "det": (
        ("events",),
        """SELECT event_id, acq_date, acq_time, substr('AT1N', sat + 1, 1) AS satellite,
  CASE WHEN sat < 2 THEN 'MODIS' ELSE 'VIIRS' END AS instrument,
  CASE event_id % 3 WHEN 0 THEN 'n' WHEN 1 THEN 'h' ELSE 'l' END AS confidence,
  CASE WHEN event_type = 'error' THEN '2.0NRT' ELSE '6.1' END AS version,
  CAST((user_id * 7) % 180 - 90 AS DOUBLE) AS latitude, CAST((user_id * 13) % 360 - 180 AS DOUBLE) AS longitude,
  value AS frp, 300D + value AS brightness, 280D + value / 2 AS bright_t31,
  CASE WHEN acq_time BETWEEN '0600' AND '1759' THEN 'D' ELSE 'N' END AS daynight,
  CASE WHEN event_type = 'error' THEN NULL ELSE 0D END AS type
FROM (SELECT *, CAST(ts AS DATE) AS acq_date, date_format(ts, 'HHmm') AS acq_time,
  CAST(CASE WHEN day(ts) % 5 = user_id % 4 THEN (user_id + 1) % 4 ELSE user_id % 4 END AS INT) AS sat
  FROM {events})""",
        """SELECT event_id, acq_date, acq_time, substr('AT1N', sat + 1, 1) AS satellite,
  CASE WHEN sat < 2 THEN 'MODIS' ELSE 'VIIRS' END AS instrument,
  CASE event_id % 3 WHEN 0 THEN 'n' WHEN 1 THEN 'h' ELSE 'l' END AS confidence,
  CASE WHEN event_type = 'error' THEN '2.0NRT' ELSE '6.1' END AS version,
  CAST((user_id * 7) % 180 - 90 AS DOUBLE) AS latitude, CAST((user_id * 13) % 360 - 180 AS DOUBLE) AS longitude,
  value AS frp, 300::DOUBLE + value AS brightness, 280::DOUBLE + value / 2 AS bright_t31,
  CASE WHEN acq_time BETWEEN '0600' AND '1759' THEN 'D' ELSE 'N' END AS daynight,
  CASE WHEN event_type = 'error' THEN NULL ELSE 0::DOUBLE END AS type
FROM (SELECT *, CAST(ts AS DATE) AS acq_date, strftime(ts, '%H%M') AS acq_time,
  CAST(CASE WHEN day(ts) % 5 = user_id % 4 THEN (user_id + 1) % 4 ELSE user_id % 4 END AS INT) AS sat
  FROM events)""",
    ),
    "files": (
        ("events",),
        """SELECT concat('raw/', date_format(d, 'yyyy'), '/weather.daily.', date_format(d, 'yyyyMMdd'), '.nc') AS path,
  d AS date, n AS length
FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM {events} GROUP BY 1)""",
        """SELECT concat('raw/', strftime(d, '%Y'), '/weather.daily.', strftime(d, '%Y%m%d'), '.nc') AS path,
  d AS date, n AS length
FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)""",
    ),
    "granules": (
        ("orders",),
        """SELECT concat('raw/', date_format(o_orderdate, 'yyyy'), '/grid.', lpad(CAST(o_orderkey AS STRING), 12, '0'),
  '.', date_format(o_orderdate, 'yyyyMMdd'), '.nc') AS path, CAST(o_orderdate AS DATE) AS date,
  CAST(floor(o_totalprice) AS BIGINT) AS length, o_orderstatus AS state, o_orderpriority AS priority
FROM {orders}""",
        """SELECT concat('raw/', strftime(o_orderdate, '%Y'), '/grid.', lpad(CAST(o_orderkey AS VARCHAR), 12, '0'),
  '.', strftime(o_orderdate, '%Y%m%d'), '.nc') AS path, CAST(o_orderdate AS DATE) AS date,
  CAST(floor(o_totalprice) AS BIGINT) AS length, o_orderstatus AS state, o_orderpriority AS priority
FROM orders""",
    ),
    "gauges": (
        ("supplier",),
        """SELECT s_suppkey AS gauge, 10D + s_nationkey * 0.7D AS lat, 80D + (s_suppkey % 100) * 0.25D AS lon
FROM {supplier}""",
        """SELECT s_suppkey AS gauge, 10::DOUBLE + s_nationkey * 0.7::DOUBLE AS lat,
  80::DOUBLE + (s_suppkey % 100) * 0.25::DOUBLE AS lon
FROM supplier""",
    ),
}


def with_views(sql: str) -> str:
    """The DuckDB text with the views it names in front."""
    used = [name for name in _VIEWS if re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", sql)]
    if not used:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({_VIEWS[name][2]})" for name in used) + f"\n{sql}"


class Tables:
    """Access to the tables and views below one directory."""

    _written: dict[tuple[str, str, str], str] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in _VIEWS:
            tables, text, _ = _VIEWS[name]
            return self.spark.sql(text, **{t: getattr(self, t) for t in tables})
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return new_scratch(self.spark, name)

    def once(self, name: str, write) -> str:
        """A folder that ``write`` fills on first use."""
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in self._written:
            root = self.scratch(name)
            write(root)
            self._written[key] = root
        return self._written[key]

    def cube_files(self) -> str:
        """The cube written once as one folder of Parquet per day."""
        days = self.cube.withColumn("day", F.to_date("time")).hint("rebalance", "day")
        return self.once("cube_files", days.write.partitionBy("day").parquet)

    def det_csv(self) -> DataFrame:
        """Detections with the columns of the text files, in their order."""
        return self.det.select(
            "latitude", "longitude", "brightness", F.lit(1.0).alias("scan"), F.lit(1.0).alias("track"), "acq_date",
            "acq_time", "satellite", "instrument", "confidence", "version", "bright_t31", "frp", "daynight", "type",
        )
