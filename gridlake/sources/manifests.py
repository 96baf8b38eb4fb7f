"""Which files exist, which are expected, which are new."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.paths import base_name
from gridlake.operators.timeaxis import first_per

_PIECES = {"yyyy": "yyyy", "mm": "MM", "dd": "dd", "doy": "DDD"}


def file_manifest(spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """Path, modification time and length of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(root).select("path", "modificationTime", "length")


def expected_files(dates: DataFrame, template: str, column: str = "date") -> DataFrame:
    """One expected path per date.

    The template holds ``{yyyy}``, ``{mm}``, ``{dd}`` and ``{doy}`` (three digits), or the
    printf pair ``%d%03d`` for year and day of year.
    """
    template = template.replace("%d%03d", "{yyyy}{doy}")
    pieces = []
    for text in re.split(r"(\{\w+\})", template):
        if text.startswith("{"):
            pieces.append(F.date_format("date", _PIECES[text[1:-1]]))
        elif text:
            pieces.append(F.lit(text))
    days = dates.select(F.to_date(column).alias("date")).distinct()
    return days.withColumn("path", F.concat(*pieces))


def date_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every date from ``start`` to ``end``."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Processed paths from a text ledger; blank lines are ignored."""
    lines = spark.read.text(path).select(F.trim("value").alias("path"))
    return lines.where(F.col("path") != "").distinct()


def new_files(manifest: DataFrame, ledger: DataFrame, limit: int | None = None) -> DataFrame:
    """Files not in the ledger; with ``limit`` that many of them, the first in path order."""
    done = ledger.select("path").where(F.trim("path") != "")
    rest = [c for c in manifest.columns if c != "path"]
    # Copies of a path are merged before the shuffle, which the join then uses as well.
    files = first_per(manifest, ["path"], rest) if rest else manifest.distinct()
    fresh = files.join(done, "path", "left_anti")
    return fresh if limit is None else fresh.orderBy("path").limit(limit)


def pending_files(wanted: DataFrame, present: DataFrame, force: bool = False) -> DataFrame:
    """Files to transfer: those not present with the same length; all with ``force``."""
    if force:
        return wanted
    return wanted.join(present.select("filename", "length"), ["filename", "length"], "left_anti")


def file_status(spark: SparkSession, manifest: DataFrame, schema: T.StructType) -> DataFrame:
    """Add ``status``: ``failed`` for Parquet files that cannot be read or hold no row."""
    # The list of files of a scan is on the driver anyway; their content is not.
    paths = [r["path"] for r in manifest.select("path").distinct().collect()]
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", True).parquet(*paths)
    readable = rows.select(F.col("_metadata.file_path").alias("path")).distinct()
    marked = manifest.join(readable.withColumn("_read", F.lit(True)), "path", "left")
    status = F.when(F.col("_read"), F.lit("read")).otherwise(F.lit("failed"))
    return marked.withColumn("status", status).drop("_read")


def record_failures(sources: DataFrame, path: str, status: str = "status") -> DataFrame:
    """Append failed sources to a table and return the others, so that the run goes on."""
    failed = F.col(status) == "failed"
    sources.where(failed).write.mode("append").parquet(path)
    return sources.where(~F.coalesce(failed, F.lit(False)))


_LINKS = (
    "struct<feed:struct<entry:array<struct<links:array<"
    "struct<href:string,inherited:boolean,rel:string,title:string>>>>>>"
)


def granule_links(pages: DataFrame, json: str = "json", page: str = "page") -> DataFrame:
    """Data links of JSON search responses, the first per page and file name.

    Dropped are links without target, inherited ones, those with a ``rel`` that lacks
    ``data#``, and those with ``opendap`` in the title.
    """
    parsed = pages.select(page, F.from_json(json, _LINKS).alias("r"))
    entries = parsed.select(page, F.posexplode("r.feed.entry").alias("entry_pos", "entry"))
    links = entries.select(page, "entry_pos", F.posexplode("entry.links").alias("link_pos", "link"))
    link = links.select(page, "entry_pos", "link_pos", "link.*")
    wanted = link.where(
        F.col("href").isNotNull()
        & ~F.coalesce("inherited", F.lit(False))
        & F.coalesce(F.col("rel").contains("data#"), F.lit(True))
        & ~F.coalesce(F.lower("title").contains("opendap"), F.lit(False))
    )
    place = F.struct("entry_pos", "link_pos", "href")
    return (
        wanted.groupBy(page, base_name("href").alias("filename"))
        .agg(F.min(place).alias("_first"))
        .select(page, "filename", F.col("_first.href").alias("href"))
    )
