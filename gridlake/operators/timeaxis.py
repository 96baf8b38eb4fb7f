"""Concatenation, padding, catch-up dates and repair of the time axis."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.positions import broadcast_if_small, ordered_position, spread_out
from gridlake.functions.times import to_ntz
from gridlake.model import KEYS


def concat_time(*cubes: DataFrame) -> DataFrame:
    """Cubes with the same variables, one after the other."""
    return reduce(lambda a, b: a.unionByName(b), cubes)


def lead_index(manifest: DataFrame) -> DataFrame:
    """Forecast lead of each file of a date: the analysis is 0, sorted forecasts follow."""
    return ordered_position(manifest, ["is_forecast", "path"], keys=("date",), name="forecast")


def concat_forecast(manifest: DataFrame, cube: DataFrame) -> DataFrame:
    """Give the cells read from each file (``path``) their forecast lead and date."""
    leads = lead_index(manifest).select("path", "forecast", to_ntz(F.col("date")).alias("time"))
    return cube.drop("time").join(leads, "path").drop("path")


def union_detections(*frames: DataFrame) -> DataFrame:
    """Rows of differing point tables; columns a table lacks are missing."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def pad_time(cube: DataFrame, chunk: int, step_seconds: int, dense: bool = False) -> DataFrame:
    """Append missing steps until the number of times is a multiple of ``chunk``.

    A whole chunk is added when it is one already. By default a new step is a single
    row without coordinates; with ``dense`` every cell of the cube gets one.
    """
    n, last = cube.agg(F.count_distinct("time"), F.max("time").cast("string")).first()
    if n == 0:
        return cube
    missing = chunk - n % chunk
    offsets = F.sequence(F.lit(1), F.lit(missing))
    cells = [k for k in KEYS[1:] + ("forecast",) if k in cube.columns]
    spark = cube.sparkSession
    rows = spread_out(cube.select(*cells).distinct(), *cells) if dense else spark.range(1).select()
    ahead = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_n") * step_seconds).cast("decimal(18,6)"))
    start = F.lit(last).cast("timestamp_ntz")
    new = rows.withColumn("_n", F.explode(offsets)).withColumn("time", start + ahead).drop("_n")
    return cube.unionByName(new, allowMissingColumns=True)


def catch_up_dates(store: DataFrame, today: dt.date, column: str = "acq_date") -> DataFrame:
    """Dates from the latest stored one to ``today``, both included; none when equal."""
    now = F.lit(today)
    last = store.agg(F.max(column).alias("_last")).where(F.col("_last") < now)
    return last.select(F.explode(F.sequence("_last", now, F.expr("interval 1 day"))).alias("date"))


def first_per(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
        .select(*keys, *[F.col("_first").getField(c).alias(c) for c in rest])
        .select(*df.columns)
    )


def dedupe_time(cube: DataFrame, seq: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Drop repeated steps; the one written first (lowest ``seq``) stays."""
    return first_per(cube, [k for k in keys if k in cube.columns], [seq])


def relabel_time(cube: DataFrame, bad: dt.datetime, good: dt.datetime) -> DataFrame:
    """Overwrite one wrong time label."""
    bad_time, good_time = (F.lit(t.isoformat()).cast("timestamp_ntz") for t in (bad, good))
    return cube.withColumn("time", F.when(F.col("time") == bad_time, good_time).otherwise(F.col("time")))


def stored_times(new: DataFrame, axis: DataFrame, present: bool = True) -> DataFrame:
    """Rows whose time is on a stored axis, or those whose time is not."""
    times = broadcast_if_small(axis.select("time").distinct())
    return new.join(times, "time", "left_semi" if present else "left_anti")


def classify_dates(base: DataFrame, forecasts: DataFrame, mode: str = "blank") -> DataFrame:
    """Status of each base date by its readable forecast files.

    A date without any is ``blank``, to be filled with missing steps; with
    ``mode="skip"`` it is left out.
    """
    readable = F.col("readable") if "readable" in forecasts.columns else F.lit(True)
    files = forecasts.groupBy("date").agg(
        F.count("*").alias("n_forecasts"), F.bool_and(readable).alias("readable")
    )
    joined = base.join(files, "date", "left")
    usable = F.coalesce(F.col("readable"), F.lit(False))
    status = F.when(usable, F.lit("complete")).otherwise(F.lit("blank"))
    out = joined.withColumns({"status": status, "n_forecasts": F.coalesce("n_forecasts", F.lit(0))})
    out = out.drop("readable")
    if mode == "skip":
        return out.where(F.col("status") == "complete")
    if mode != "blank":
        raise ValueError(f"unknown mode {mode!r}")
    return out
