"""Detections: text in, partitioned store, refresh, and completeness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.geo import point_wkb, wkb_xy
from gridlake.functions.labels import instrument_label, recode
from gridlake.functions.times import with_ymd
from gridlake import fixed
from gridlake.model import DETECTION_CSV, DETECTION_SCHEMA
from gridlake.operators.aggregate import count_by, count_of_counts, groups_with_count, latest
from gridlake.operators.axes import complete
from gridlake.operators.quality import absent_keys, missing_pairs
from gridlake.operators.select import on_date, since, time_between_open, where_label
from gridlake.operators.timeaxis import catch_up_dates, distinct_keys, union_detections
from gridlake.plans.detections import archive_to_store, refresh_detections, with_geometry, with_timestamps, wanted_files
from gridlake.sources.readers import read_detections, read_instrument, read_store
from gridlake.sources.sinks import write_daily_text, write_missing_years, write_store
from gridlake.sources.slots import read_rejects, read_slots
from workload.registry import query

_INSTRUMENT = (
    "CASE WHEN satellite IN ('A', 'T') THEN 'MODIS' WHEN satellite = 'N' THEN 'SUOMI-NPP-VIIRS' ELSE 'NOAA-20-VIIRS' END"
)
_LABEL = """CASE satellite WHEN 'A' THEN 'MODIS Aqua' WHEN 'T' THEN 'MODIS Terra'
  WHEN '1' THEN 'NOAA-20-VIIRS' ELSE 'SUOMI-NPP-VIIRS' END"""
_TEXT = """latitude, longitude, brightness, 1::DOUBLE AS scan, 1::DOUBLE AS track, acq_date, acq_time, satellite,
  confidence, version, bright_t31, frp, daynight, type"""


@query(
    "s1_read_detections",
    f"SELECT {_TEXT}, instrument, CASE WHEN type IS NULL THEN 'nrt' ELSE 'archive' END AS kind FROM det",
    "brightness bright_t31 frp",
)
def _(t):
    root = t.scratch("raw")
    rows = t.det_csv()
    rows.where("type IS NOT NULL").write.option("header", True).csv(f"{root}/fire_archive_1.csv")
    rows.where("type IS NULL").drop("type").write.option("header", True).csv(f"{root}/fire_nrt_1.csv")
    frames = [read_detections(t.spark, root, k).withColumn("kind", F.lit(k)) for k in ("archive", "nrt")]
    return union_detections(*frames)


def _landing(t) -> str:
    """Daily text files of the three instruments, one folder each."""
    root = t.scratch("landing")
    rows = t.det_csv().drop("instrument").withColumn("_name", F.expr(_INSTRUMENT))
    for name, template in fixed.DAILY_FILES.items():
        write_daily_text(rows.where(F.col("_name") == name).drop("_name"), f"{root}/{name}", template.split("%")[0])
    return root


@query("s2_read_instrument", f"SELECT {_TEXT}, {_INSTRUMENT} AS instrument FROM det", "brightness bright_t31 frp")
def _(t):
    root = _landing(t)
    frames = [read_instrument(t.spark, f"{root}/{name}/*", name) for name in fixed.DAILY_FILES]
    return union_detections(*frames)


@query(
    "s11_daily_text",
    "SELECT 'VJ_' || strftime(acq_date, '%Y%j') || '.txt' AS file_key, latitude, longitude, acq_time, frp FROM det",
    "frp",
)
def _(t):
    root = t.scratch("daily")
    write_daily_text(t.det_csv(), root, "VJ_")
    parts = T.StructType(DETECTION_CSV.fields + [T.StructField("file_key", T.StringType())])
    text = t.spark.read.schema(parts).options(header=True, enforceSchema=False).csv(root)
    return text.select("file_key", "latitude", "longitude", "acq_time", "frp")


def _store(t) -> str:
    root = t.scratch("store")
    write_store(t.det.transform(with_timestamps), root)
    return root


_STORED = """event_id, acq_date, acq_time, satellite, frp, version,
  acq_date + to_hours(CAST(acq_time[1:2] AS BIGINT)) + to_minutes(CAST(acq_time[3:4] AS BIGINT)) AS acq_timestamp,
  year(acq_date) AS year, month(acq_date) AS month, day(acq_date) AS mday"""
_COLUMNS = "event_id acq_date acq_time satellite frp version acq_timestamp year month mday".split()


@query("s5_read_partition", f"SELECT {_STORED} FROM det WHERE acq_date = DATE '2024-01-07' AND version = '6.1'", "frp")
def _(t):
    return read_store(t.spark, _store(t), year=2024, month=1, mday=7, version="6.1").select(*_COLUMNS)


@query(
    "s5_read_since",
    f"SELECT {_STORED} FROM det WHERE acq_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'",
    "frp",
)
def _(t):
    store = read_store(t.spark, _store(t), since=dt.date(2024, 1, 10), until=dt.date(2024, 1, 20))
    return store.select(*_COLUMNS)


@query(
    "s6_declared_schema",
    """SELECT brightness, NULL::DOUBLE AS scan, acq_date, acq_time, satellite, instrument, version, frp,
  year(acq_date) AS year FROM det""",
    "brightness frp",
)
def _(t):
    store = read_store(t.spark, _store(t), schema=DETECTION_SCHEMA)
    return store.select("brightness", "scan", "acq_date", "acq_time", "satellite", "instrument", "version", "frp", "year")


@query(
    "s9_partition_overwrite",
    """SELECT event_id, acq_date, version,
  CASE WHEN acq_date >= DATE '2024-01-20' AND version = '6.1' THEN frp * 2 ELSE frp END AS frp FROM det""",
    "frp",
)
def _(t):
    root = _store(t)
    later = t.det.where("acq_date >= DATE '2024-01-20' AND version = '6.1'").withColumn("frp", F.col("frp") * 2)
    write_store(later.transform(with_timestamps), root, force=False)
    return read_store(t.spark, root).select("event_id", "acq_date", "version", "frp")


@query(
    "s9_overwrite_by_date",
    """SELECT event_id, acq_date, version, frp FROM det WHERE acq_date < DATE '2024-01-20'
UNION ALL SELECT event_id, acq_date, version, frp * 2 FROM det WHERE acq_date >= DATE '2024-01-20' AND version = '6.1'""",
    "frp",
)
def _(t):
    # By date alone, a later write replaces every version of its dates.
    root, keys = t.scratch("store"), ("year", "month", "mday")
    write_store(t.det.transform(with_timestamps), root, keys)
    later = t.det.where("acq_date >= DATE '2024-01-20' AND version = '6.1'").withColumn("frp", F.col("frp") * 2)
    write_store(later.transform(with_timestamps), root, keys)
    return t.spark.read.parquet(root).select("event_id", "acq_date", "version", "frp")


@query(
    "s10_missing_years",
    "SELECT time, lat, lon, CASE WHEN year(time) <= 1997 THEN SSH ELSE SSH + 1 END AS SSH FROM monthly",
    "SSH",
)
def _(t):
    root = t.scratch("years")
    write_missing_years(t.monthly.where("time < '1998-01-01'"), root, "time")
    write_missing_years(t.monthly.withColumn("SSH", F.col("SSH") + 1), root, "time")
    return t.spark.read.parquet(root).select("time", "lat", "lon", "SSH")


@query(
    "archive_to_store",
    f"""SELECT acq_date, acq_time, satellite, instrument, version, longitude, latitude, frp, type,
  acq_date + to_hours(CAST(acq_time[1:2] AS BIGINT)) + to_minutes(CAST(acq_time[3:4] AS BIGINT)) AS acq_timestamp FROM det""",
    "frp",
)
def _(t):
    base = t.scratch("archive")
    rows = t.det_csv()
    rows.where("type IS NOT NULL").write.option("header", True).csv(f"{base}/raw/fire_archive_1.csv")
    rows.where("type IS NULL").drop("type").write.option("header", True).csv(f"{base}/raw/fire_nrt_1.csv")
    for _ in range(2):
        archive_to_store(t.spark, f"{base}/raw", f"{base}/yearly", f"{base}/store")
    xy = wkb_xy("geometry")
    return read_store(t.spark, f"{base}/store").select(
        "acq_date", "acq_time", "satellite", "instrument", "version",
        xy["lon"].alias("longitude"), xy["lat"].alias("latitude"), "frp", "type", "acq_timestamp",
    )


@query(
    "i4_refresh_detections",
    f"""SELECT acq_date, acq_time, satellite, {_INSTRUMENT} AS instrument, version, longitude, latitude, frp,
  CASE WHEN acq_date >= DATE '2024-01-25' THEN 'refreshed' ELSE 'kept' END AS state FROM det""",
    "frp",
)
def _(t):
    root = t.scratch("store")
    rows = t.det_csv().withColumn("instrument", F.expr(_INSTRUMENT)).withColumn("daynight", F.lit("kept"))
    stored = rows.where("acq_date <= DATE '2024-01-25'").transform(with_timestamps).transform(with_geometry)
    write_store(stored, root)
    refresh_detections(t.spark, root, f"{_landing(t)}/{{instrument}}/file_key={{name}}", dt.date(2024, 1, 30))
    xy = wkb_xy("geometry")
    state = F.when(F.col("daynight") == "kept", "kept").otherwise("refreshed")
    return read_store(t.spark, root).select(
        "acq_date", "acq_time", "satellite", "instrument", "version",
        xy["lon"].alias("longitude"), xy["lat"].alias("latitude"), "frp", state.alias("state"),
    )


_WAVE = """CASE WHEN acq_date < DATE '2024-01-10' THEN 0
  WHEN satellite = '1' AND acq_date <= DATE '2024-01-15' AND day(acq_date) % 2 = 0 THEN 3
  WHEN satellite = 'N' AND acq_date = DATE '2024-01-18' THEN 3
  WHEN acq_date <= DATE '2024-01-15' THEN 1 WHEN acq_date <= DATE '2024-01-22' THEN 2 ELSE 3 END"""


def _in_waves(t) -> str:
    """A store up to January 9, then files in three waves: some come one or two runs late, and in some lines
    the brightness is no number."""
    return t.once("waves", lambda root: _waves_below(t, root)) + "/store"


def _waves_below(t, root: str) -> None:
    rows = t.det_csv().withColumns({"instrument": F.expr(_INSTRUMENT), "wave": F.expr(_WAVE)})
    write_store(rows.where("wave = 0").drop("wave").transform(with_timestamps).transform(with_geometry), f"{root}/store")
    text = rows.withColumn("brightness", F.when(F.round("frp") % 5 == 0, F.lit("saturated")).otherwise(F.col("brightness").cast("string")))
    for wave, today in ((1, 15), (2, 22), (3, 31)):
        for name, template in fixed.DAILY_FILES.items():
            part = text.where((F.col("wave") == wave) & (F.col("instrument") == name)).drop("instrument", "wave")
            write_daily_text(part, f"{root}/in/{name}", template.split("%")[0])
        refresh_detections(
            t.spark, f"{root}/store", f"{root}/in/{{instrument}}/file_key={{name}}", dt.date(2024, 1, today),
            start=dt.date(2024, 1, 10),
        )


@query(
    "i4_late_files",
    f"""SELECT acq_date, acq_time, satellite, {_INSTRUMENT} AS instrument, version, latitude, longitude, frp FROM det
WHERE acq_date < DATE '2024-01-10' OR round(frp) % 5 <> 0""",
    "frp",
)
def _(t):
    xy = wkb_xy("geometry")
    return read_store(t.spark, _in_waves(t)).select(
        "acq_date", "acq_time", "satellite", "instrument", "version",
        xy["lat"].alias("latitude"), xy["lon"].alias("longitude"), "frp",
    )


@query(
    "i4_slot_states",
    f"""SELECT acq_date AS date, {_INSTRUMENT} AS instrument, 'stored' AS state, max({_WAVE})::BIGINT AS wave,
  count(*) FILTER (WHERE round(frp) % 5 <> 0) AS rows, count(*) FILTER (WHERE round(frp) % 5 = 0) AS rejected
FROM det WHERE acq_date >= DATE '2024-01-10' GROUP BY 1, 2""",
)
def _(t):
    found = read_slots(t.spark, _in_waves(t))
    # The first run of the ledger says where slots begin.
    return found.select("date", "instrument", "state", (F.col("run") - 1).alias("wave"), "rows", "rejected")


@query(
    "q8_rejected_lines",
    f"""SELECT acq_date AS date, {_INSTRUMENT} AS instrument, acq_time, satellite, count(*) AS n FROM det
WHERE acq_date >= DATE '2024-01-10' AND round(frp) % 5 = 0 GROUP BY ALL""",
)
def _(t):
    fields = F.split("line", ",")
    rejects = read_rejects(t.spark, _in_waves(t))
    return rejects.groupBy("date", "instrument", fields[6].alias("acq_time"), fields[7].alias("satellite")).agg(F.count("*").alias("n"))


@query(
    "s8_wanted_files",
    """SELECT CAST(d AS DATE) AS date, instrument, prefix || strftime(d, '%Y%j') || '.txt' AS path
FROM (SELECT unnest(generate_series((SELECT max(acq_date) FROM det)::TIMESTAMP, TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS d),
  (VALUES ('MODIS', 'MODIS_C6_1_Global_MCD14DL_NRT_'), ('SUOMI-NPP-VIIRS', 'SUOMI_VIIRS_C2_Global_VNP14IMGTDL_NRT_'),
    ('NOAA-20-VIIRS', 'J1_VIIRS_C2_Global_VJ114IMGTDL_NRT_')) AS v(instrument, prefix)""",
)
def _(t):
    return wanted_files(catch_up_dates(t.det, dt.date(2024, 2, 3)))


@query(
    "t9_catch_up_dates",
    """SELECT CAST(unnest(generate_series((SELECT max(acq_date) FROM det)::TIMESTAMP, TIMESTAMP '2024-02-10',
  INTERVAL 1 DAY)) AS DATE) AS date""",
)
def _(t):
    return catch_up_dates(t.det, dt.date(2024, 2, 10))


@query(
    "t3_union_detections",
    """SELECT event_id, frp, bright_t31, NULL::DOUBLE AS type FROM det WHERE instrument = 'VIIRS'
UNION ALL SELECT event_id, frp, NULL::DOUBLE, type FROM det WHERE instrument = 'MODIS'""",
    "frp bright_t31",
)
def _(t):
    viirs = t.det.where("instrument = 'VIIRS'").select("event_id", "frp", "bright_t31")
    modis = t.det.where("instrument = 'MODIS'").select("event_id", "frp", "type")
    return union_detections(viirs, modis)


@query("q1_complete", "SELECT * FROM (SELECT DISTINCT acq_date FROM det), (SELECT DISTINCT satellite FROM det)")
def _(t):
    return complete(t.det, "acq_date", "satellite")


@query(
    "j9_complete_users",
    "SELECT * FROM (SELECT DISTINCT c_custkey // 10 AS grp FROM customer), (SELECT DISTINCT c_nationkey::BIGINT AS c_nationkey FROM customer)",
)
def _(t):
    return complete(t.customer.withColumn("grp", F.expr("c_custkey DIV 10")), "grp", "c_nationkey")


_PAIRS = f"""(SELECT * FROM (SELECT DISTINCT acq_date FROM det), (SELECT DISTINCT {_LABEL} AS label FROM det)
  EXCEPT SELECT acq_date, {_LABEL} FROM det)"""


@query("q2_missing_pairs", f"SELECT acq_date, label FROM {_PAIRS}")
def _(t):
    return missing_pairs(instrument_label(t.det), "acq_date", "label")


@query("q2_missing_viirs", f"SELECT acq_date, label FROM {_PAIRS} WHERE label LIKE '%VIIRS%'")
def _(t):
    missing = missing_pairs(instrument_label(t.det), "acq_date", "label")
    return missing.transform(where_label, "label", "VIIRS").orderBy(F.desc("acq_date"))


@query("q2_missing_since", f"SELECT acq_date, label FROM {_PAIRS} WHERE acq_date >= DATE '2024-01-15'")
def _(t):
    missing = missing_pairs(instrument_label(t.det), "acq_date", "label")
    return missing.transform(since, dt.date(2024, 1, 15)).orderBy(F.desc("acq_date"))


@query(
    "j4_anti_join",
    """SELECT DISTINCT c_nationkey::BIGINT AS c_nationkey, c_mktsegment FROM customer
EXCEPT SELECT c_nationkey, c_mktsegment FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""",
)
def _(t):
    filled = t.customer.join(t.orders.where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return absent_keys(t.customer, filled, "c_nationkey", "c_mktsegment")


@query("p7_open_interval", "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09 12:00:00'")
def _(t):
    picked = time_between_open(t.events, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 9, 12), "ts")
    return picked.select("event_id", "ts")


@query("p8_on_date", "SELECT event_id, acq_date FROM det WHERE acq_date = DATE '2024-01-12'")
def _(t):
    return on_date(t.det, dt.date(2024, 1, 12)).select("event_id", "acq_date")


@query("p9_regex_filter", f"SELECT event_id, {_LABEL} AS label FROM det WHERE instrument = 'VIIRS'")
def _(t):
    return where_label(instrument_label(t.det), "label", "VIIRS").select("event_id", "label")


@query("a17_count_by", "SELECT satellite, instrument, count(*) AS n FROM det GROUP BY 1, 2")
def _(t):
    return count_by(t.det, "satellite", "instrument")


@query("a18_count_of_counts", "SELECT n, count(*) AS nn FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def _(t):
    return count_of_counts(t.orders, "o_custkey")


@query(
    "a19_groups_of_three",
    """SELECT acq_date FROM (SELECT DISTINCT acq_date, satellite FROM det) GROUP BY 1 HAVING count(*) = 3""",
)
def _(t):
    return groups_with_count(distinct_keys(t.det, "acq_date", "satellite"), 3, "acq_date")


@query("a20_latest", "SELECT max(acq_date) AS latest, min(acq_date) AS earliest FROM det")
def _(t):
    return latest(t.det, "acq_date")


@query("t5_distinct", "SELECT DISTINCT acq_date, satellite, instrument, version FROM det")
def _(t):
    return distinct_keys(t.det, "acq_date", "satellite", "instrument", "version")


@query(
    "o3_sort_by_count",
    "SELECT acq_date, count(*) AS n FROM det GROUP BY 1 ORDER BY n DESC, acq_date",
)
def _(t):
    return count_by(t.det, "acq_date").orderBy(F.desc("n"), "acq_date")


@query("f4_calendar_parts", "SELECT event_id, year(acq_date) AS year, month(acq_date) AS month, day(acq_date) AS mday FROM det")
def _(t):
    return with_ymd(t.det).select("event_id", "year", "month", "mday")


@query(
    "f7_recode",
    """SELECT event_id, CASE satellite WHEN 'A' THEN 'Aqua' WHEN 'T' THEN 'Terra' WHEN '1' THEN 'NOAA-20' ELSE satellite END AS satellite,
  CASE confidence WHEN 'n' THEN 'nominal' WHEN 'h' THEN 'high' ELSE 'low' END AS confidence FROM det""",
)
def _(t):
    known = {k: v for k, v in fixed.SATELLITES.items() if k != "N"}
    return t.det.select(
        "event_id",
        recode("satellite", known).alias("satellite"),
        recode("confidence", fixed.CONFIDENCE).alias("confidence"),
    )


@query("f8_instrument_label", f"SELECT event_id, {_LABEL} AS label FROM det")
def _(t):
    return instrument_label(t.det).select("event_id", "label")


@query("f16_point_geometry", "SELECT event_id, longitude AS lon, latitude AS lat, 21::BIGINT AS n_bytes FROM det")
def _(t):
    points = t.det.select("event_id", point_wkb("longitude", "latitude").alias("geometry"))
    return points.select("event_id", wkb_xy("geometry").alias("xy"), F.length("geometry").alias("n_bytes")).select(
        "event_id", "xy.lon", "xy.lat", "n_bytes"
    )
