"""Keeping the detection store up to date."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.geo import point_wkb
from gridlake.functions.times import acquisition_timestamp, clock_digits, normalise_hhmm, with_ymd
from gridlake.model import DETECTION_CSV, STORE_KEYS
from gridlake.operators.select import cast_matching
from gridlake.operators.timeaxis import union_detections
from gridlake.session import path_exists, path_state
from gridlake.sources import slots
from gridlake.sources.manifests import date_range, expected_files, record_failures
from gridlake.sources.readers import first_lines, read_detections, read_instrument, read_store
from gridlake.sources.sinks import write_missing_years, write_partitions, write_store


def with_timestamps(df: DataFrame) -> DataFrame:
    """Normalised ``acq_time``, the timestamp it gives, and the partition keys."""
    df = df.withColumn("acq_timestamp", acquisition_timestamp("acq_date", "acq_time"))
    df = df.withColumn("acq_time", normalise_hhmm("acq_time"))
    return with_ymd(df.withColumn("acq_timestr", clock_digits("acq_timestamp")))


def with_geometry(df: DataFrame) -> DataFrame:
    """A WKB point instead of longitude and latitude."""
    return df.withColumn("geometry", point_wkb("longitude", "latitude")).drop("longitude", "latitude")


def archive_to_store(spark: SparkSession, raw: str, yearly: str, root: str, open_years: tuple[int, ...] = ()) -> None:
    """Archive and near-real-time text to yearly tables with geometry, then both in one write to the store.

    Years that an earlier run finished are not read into the yearly tables again; ``open_years`` are
    not finished by this run.
    """
    tables = [f"{yearly}/{kind}" for kind in ("archive", "nrt")]
    for kind, table in zip(("archive", "nrt"), tables, strict=True):
        write_missing_years(read_detections(spark, raw, kind).transform(with_geometry), table, open_years=open_years)
    rows = union_detections(*[spark.read.parquet(table).drop("year") for table in tables])
    write_store(rows.transform(with_timestamps), root)


def wanted_files(dates: DataFrame) -> DataFrame:
    """Expected daily files of every instrument."""
    frames = [
        expected_files(dates, template).withColumn("instrument", F.lit(instrument))
        for instrument, template in fixed.DAILY_FILES.items()
    ]
    return union_detections(*frames)


def refresh_detections(
    spark: SparkSession,
    root: str,
    landing: str,
    today: dt.date,
    schema=DETECTION_CSV,
    failures: str | None = None,
    start: dt.date | None = None,
) -> None:
    """Read the daily files of all open slots up to ``today`` and put them into the store.

    ``landing`` is a path with ``{instrument}`` and ``{name}``. A slot is one date of one instrument (see
    ``sources.slots``). Slots begin at ``start``, or at the last date that is stored when the first run begins; they
    stay open until their file came, however late. Files from the last stored date on are read again where
    they changed. All slots of a run are one job.

    In the partitions a file falls into, the rows of its instrument are replaced and those of all others stay.
    A file whose header does not fit leaves its slot open; single lines that cannot be read, or that
    have no date, go to the rejects. Slots from the last stored date on that are still open are appended to the
    table ``failures``; the ledger knows the older ones. A lost run is finished by the next one, or begun anew.
    """

    def write(data: str) -> None:
        write_store(read_store(spark, data), root)

    slots.recover(spark, root, write)
    latest = _last_stored_date(spark, root)
    first = slots.start_date(spark, root)
    if first is None:
        first = start or latest
        if first is None or first >= today:
            return
        slots.begin(spark, root, first)
    window = max(first, latest) if latest else first

    found, absent = _landed(spark, root, landing, first, window, today)
    names = [f.name for f in schema.fields if f.name != "instrument"]
    usable = _with_header(spark, found, ",".join(names)) if found else set()
    failed = [f for f in found if f["path"] not in usable]
    if failures and window < today:
        open_ = [(f["date"], f["path"], f["instrument"], "failed") for f in absent + failed if f["date"] >= window]
        if open_:
            sources = spark.createDataFrame(open_, "date date, path string, instrument string, status string")
            record_failures(sources, failures)
    if found:
        run = slots.next_run(spark, root)
        _stage(spark, root, run, [f for f in found if f["path"] in usable], failed, schema)
        slots.publish(spark, root, run, write)


def _landed(spark: SparkSession, root: str, landing: str, first: dt.date, window: dt.date, today: dt.date):
    """Files of open slots, and of those in the window whose file is another than the one that was stored; and open
    slots without a file."""
    wanted = wanted_files(date_range(spark, first, today))
    open_ = slots.open_slots(spark, root, wanted).withColumns({"length": F.lit(None), "modified": F.lit(None)})
    known = slots.read_slots(spark, root).where((F.col("state") == slots.STORED) & (F.col("date") >= F.lit(window)))
    again = wanted.join(known.select("date", "instrument", "length", "modified"), ["date", "instrument"])
    found, absent = [], []
    # A few names per day since the oldest open slot.
    for slot in open_.unionByName(again).collect():
        path = landing.format(instrument=slot["instrument"], name=slot["path"])
        state = path_state(spark, path)
        file = {"date": slot["date"], "instrument": slot["instrument"], "path": path}
        if state is None:
            if slot["length"] is None:
                absent.append(file)
        elif state != (slot["length"], slot["modified"]):
            found.append(file | {"length": state[0], "modified": state[1]})
    return found, absent


def _with_header(spark: SparkSession, files: list[dict], header: str) -> set[str]:
    """Paths of the files (or of folders of files) whose first lines are the header."""
    lines = first_lines(spark, [f["path"] for f in files])
    # One line of each file that the scan would list anyway.
    found = [(unquote(r["path"]), r["line"] == header) for r in lines.collect()]
    good: dict[str, bool] = {}
    for f in files:
        for path, fits in found:
            if f"{path}/".find(f"{f['path']}/") >= 0:
                good[f["path"]] = good.get(f["path"], True) and fits
    return {path for path, fits in good.items() if fits}


def _stage(spark: SparkSession, root: str, run: int, files: list[dict], failed: list[dict], schema) -> None:
    """Whole new partitions, rejected lines and, when these are complete, the slots they belong to."""
    rows, ledger = "date date, instrument string, path string, length long, modified long", []
    for state, found in ((slots.STORED, files), (slots.FAILED, failed)):
        values = [tuple(f[c] for c in ("date", "instrument", "path", "length", "modified")) for f in found]
        ledger.append(spark.createDataFrame(values, rows).withColumn("state", F.lit(state)))
    ledger = ledger[0].unionByName(ledger[1])
    counts = None
    rejects = spark.createDataFrame([], "date date, instrument string, path string, line string")
    if files:
        read = slots.stage(root, run, "new")
        by_name = {name: [f["path"] for f in files if f["instrument"] == name] for name in {f["instrument"] for f in files}}
        frames = [_file_rows(spark, paths, name, schema) for name, paths in by_name.items()]
        union_detections(*frames).write.mode("overwrite").parquet(read)
        lines = spark.read.parquet(read)
        bad = F.col("_line").isNotNull() | F.col("acq_date").isNull()
        counts = lines.groupBy(F.col("_date").alias("date"), "instrument").agg(
            F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected")
        )
        rejects = lines.where(bad).select(F.col("_date").alias("date"), "instrument", F.col("_path").alias("path"), F.col("_line").alias("line"))
        new = lines.where(~bad).drop("_line", "_path", "_date").transform(cast_matching, "^bright_", "double")
        new = new.transform(with_timestamps).transform(with_geometry)
        write_partitions(_merged(spark, root, new), slots.stage(root, run, "data"), STORE_KEYS)
    rejects.write.mode("overwrite").parquet(slots.stage(root, run, "rejects"))
    if counts is not None:
        ledger = ledger.join(counts, ["date", "instrument"], "left").fillna(0, ["rows", "rejected"])
    ledger.write.mode("overwrite").parquet(slots.stage(root, run, "slots"))


def _file_rows(spark: SparkSession, paths: list[str], instrument: str, schema) -> DataFrame:
    """Rows with their file, the date in its name, and the line where it could not be read."""
    rows = read_instrument(spark, paths, instrument, schema, malformed="_line").withColumn("_path", F.col("_metadata.file_path"))
    day = F.regexp_extract("_path", re.escape(fixed.DAILY_FILES[instrument].split("%")[0]) + r"(\d{7})", 1)
    return rows.withColumn("_date", F.to_date(day, "yyyyDDD"))


def _merged(spark: SparkSession, root: str, new: DataFrame) -> DataFrame:
    """The partitions that ``new`` touches, with its rows in place of the stored ones of its instruments."""
    if not path_exists(spark, root):
        return new
    keys = list(STORE_KEYS)
    touched = new.select(*keys, "instrument").distinct()
    # Days of this run, which the scan of the store is pruned to.
    days = [r["acq_date"] for r in new.select("acq_date").distinct().collect()]
    stored = read_store(spark, root).where(F.make_date("year", "month", "mday").isin(days))
    stored = stored.join(touched.select(*keys).distinct(), keys, "left_semi")
    kept = stored.join(touched, [*keys, "instrument"], "left_anti")
    return new.unionByName(kept, allowMissingColumns=True)


def _last_stored_date(spark: SparkSession, root: str) -> dt.date | None:
    if not path_exists(spark, root):
        return None
    store = read_store(spark, root)
    newest = store.agg(F.max("year")).first()[0]
    return store.where(F.col("year") == newest).agg(F.max("acq_date")).first()[0]
