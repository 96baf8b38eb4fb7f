"""Manifests, links and cube readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.paths import base_name, date_from_offset, date_from_path
from gridlake.operators.select import rename_dims, suffix_variables
from gridlake.sources.manifests import (
    expected_files,
    file_manifest,
    file_status,
    granule_links,
    new_files,
    pending_files,
    read_ledger,
    record_failures,
)
from gridlake.sources.readers import read_cube
from workload.registry import query


@query(
    "s3_read_many_files",
    "SELECT *, strftime(time, '%Y-%m-%d') AS file_day FROM cube",
    "TS SWGNT LWGAB HFLUX EFLUX GHTSKIN PRECTOT",
)
def _(t):
    cube = read_cube(t.spark, f"{t.cube_files()}/day=*", with_path=True)
    return cube.withColumn("file_day", F.regexp_extract("path", r"day=([0-9-]+)", 1)).drop("path")


@query(
    "s4_read_subset",
    "SELECT time, lat, lon, TS, SWGNT FROM cube WHERE lat BETWEEN 55 AND 70 AND lon BETWEEN 0 AND 150",
    "TS SWGNT",
)
def _(t):
    return read_cube(t.spark, f"{t.cube_files()}/day=*", bbox=(55.0, 70.0, 0.0, 150.0), variables=["TS", "SWGNT"])


@query(
    "u1_preprocess_hook",
    "SELECT time, lat AS northing, lon AS easting, TS AS TS_pm, PRECTOT AS PRECTOT_pm FROM cube",
    "TS_pm PRECTOT_pm",
)
def _(t):
    def prepare(df):
        df = suffix_variables(df.drop("day"), "_pm")
        return rename_dims(df, {"lat": "northing", "lon": "easting"})

    return read_cube(
        t.spark,
        t.cube_files(),
        variables=["TS_pm", "PRECTOT_pm"],
        keys=("time", "northing", "easting"),
        preprocess=prepare,
    )


@query("s7_file_manifest", "SELECT DISTINCT strftime(time, '%Y-%m-%d') AS day, true AS has_bytes FROM cube")
def _(t):
    files = file_manifest(t.spark, t.cube_files(), "*.parquet")
    day = F.regexp_extract("path", r"day=([0-9-]+)", 1).alias("day")
    return files.groupBy(day).agg((F.sum("length") > 0).alias("has_bytes"))


@query(
    "s8_expected_files",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
  strftime(o_orderdate, 'in/Y%Y/M%m/inst.%Y%m%d.nc4') AS path FROM orders
UNION ALL SELECT DISTINCT CAST(o_orderdate AS DATE),
  strftime(o_orderdate, 'MODIS_C6_1_Global_MCD14DL_NRT_%Y%j.txt') FROM orders""",
)
def _(t):
    dates = t.orders.select(F.to_date("o_orderdate").alias("date"))
    hourly = expected_files(dates, "in/Y{yyyy}/M{mm}/inst.{yyyy}{mm}{dd}.nc4")
    return hourly.unionByName(expected_files(dates, fixed.DAILY_FILES["MODIS"]))


@query(
    "s16_granule_links",
    """SELECT page, filename, href FROM (
  SELECT page_id // 50 AS page, list_extract(string_split(url, '/'), -1) AS filename, url AS href,
    row_number() OVER (PARTITION BY page_id // 50, list_extract(string_split(url, '/'), -1) ORDER BY page_id) AS rn
  FROM pages WHERE page_id % 5 <> 0 AND (page_id % 3 <> 1) AND page_id % 7 <> 0)
WHERE rn = 1""",
)
def _(t):
    link = F.expr(
        """named_struct('href', url, 'inherited', page_id % 5 = 0,
        'rel', CASE page_id % 3 WHEN 0 THEN 'http://example.org/1.1/metadata#' WHEN 1 THEN 'http://example.org/1.1/browse#' END,
        'title', CASE WHEN page_id % 7 = 0 THEN 'OPeNDAP request' ELSE 'Download' END)"""
    )
    entries = t.pages.select(
        F.expr("page_id DIV 50").alias("page"), "page_id", F.struct(F.array(link).alias("links")).alias("entry")
    )
    # Fifty pages make one response.
    responses = entries.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("page_id", "entry"))).getField("entry").alias("entry")
    )
    return granule_links(responses.select("page", F.to_json(F.expr("struct(struct(entry) AS feed)")).alias("json")))


@query(
    "s17_pending_files",
    """SELECT list_extract(string_split(path, '/'), -1) AS filename, length FROM granules
WHERE state <> 'F' OR priority = '1-URGENT'""",
)
def _(t):
    wanted = t.granules.select(base_name("path").alias("filename"), "length")
    short = F.when(F.col("priority") == "1-URGENT", 1).otherwise(0)
    present = t.granules.where("state = 'F'").select(base_name("path").alias("filename"), (F.col("length") - short).alias("length"))
    return pending_files(wanted, present)


@query(
    "s17_pending_files_forced",
    "SELECT list_extract(string_split(path, '/'), -1) AS filename, length FROM granules",
)
def _(t):
    wanted = t.granules.select(base_name("path").alias("filename"), "length")
    return pending_files(wanted, wanted, force=True)


@query("j5_new_files", "SELECT path, date, length FROM granules WHERE state <> 'F'")
def _(t):
    return new_files(t.granules, t.granules.where("state = 'F'")).select("path", "date", "length")


@query("j5_new_files_text_ledger", "SELECT path, date, length FROM granules WHERE state <> 'F'")
def _(t):
    root = t.scratch("ledger")
    blank = F.explode(F.array(F.col("path"), F.lit("")))
    t.granules.where("state = 'F'").select(blank.alias("value")).write.text(root)
    return new_files(t.granules, read_ledger(t.spark, root)).select("path", "date", "length")


@query("t4_set_difference", "SELECT path FROM granules EXCEPT SELECT path FROM granules WHERE priority = '5-LOW'")
def _(t):
    return new_files(t.granules, t.granules.where("priority = '5-LOW'")).select("path")


@query("o5_first_new_files", "SELECT path FROM granules WHERE state <> 'F' ORDER BY path LIMIT 6")
def _(t):
    return new_files(t.granules, t.granules.where("state = 'F'"), limit=6).select("path")


@query(
    "q8_record_failures",
    "SELECT path, CASE WHEN priority = '1-URGENT' THEN 'failed' ELSE 'read' END AS status FROM granules",
)
def _(t):
    root = t.scratch("failed")
    status = F.when(F.col("priority") == "1-URGENT", "failed").otherwise("read")
    kept = record_failures(t.granules.withColumn("status", status), root)
    return kept.select("path", "status").unionByName(t.spark.read.parquet(root).select("path", "status"))


@query("q8_file_status", "SELECT DISTINCT strftime(time, '%Y-%m-%d') AS day, 'read' AS status FROM cube")
def _(t):
    files = file_manifest(t.spark, t.cube_files(), "*.parquet")
    day = F.regexp_extract("path", r"day=([0-9-]+)", 1).alias("day")
    return file_status(t.spark, files, t.cube.schema).select(day, "status").distinct()


@query(
    "f1_date_from_path",
    "SELECT path, date AS from_nc, date AS from_tag, date AS from_offset FROM granules",
)
def _(t):
    tagged = t.granules.withColumn("tagged", F.concat(F.lit("x/SOIL_SM_P_"), F.date_format("date", "yyyyMMdd"), F.lit("_R1.h5")))
    return tagged.select(
        "path",
        date_from_path("path").alias("from_nc"),
        date_from_path("tagged", fixed.DATE_AFTER_SM_P).alias("from_tag"),
        date_from_offset("path", 18).alias("from_offset"),
    )
