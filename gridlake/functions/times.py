"""Dates, clock times and labels. Timestamps carry no zone; the session runs in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def normalise_hhmm(text: Column | str) -> Column:
    """``HHMM`` from ``HMM``, ``HHMM``, ``HH:MM`` or ``HH:MM:SS`` text."""
    text = _col(text).cast("string")
    parts = F.split(text, ":")
    clock = F.concat(F.lpad(parts[0], 2, "0"), F.lpad(F.get(parts, F.lit(1)), 2, "0"))
    return F.when(text.contains(":"), clock).otherwise(F.lpad(text, 4, "0"))


def hhmm_timestamp(date: Column | str, hhmm: Column | str) -> Column:
    """Date plus the hours and minutes of an ``HHMM`` text; missing where it is no number."""
    text = _col(hhmm)
    hours = F.substring(text, 1, 2).try_cast("int")
    minutes = F.substring(text, 3, 2).try_cast("int")
    return to_ntz(_col(date)) + F.make_dt_interval(F.lit(0), hours, minutes)


def clock_timestamp(date: Column | str, clock: Column | str) -> Column:
    """Date plus an ``HH:MM`` or ``HH:MM:SS`` clock text."""
    parts = F.split(_col(clock), ":")
    seconds = F.coalesce(F.get(parts, F.lit(2)).try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    return to_ntz(_col(date)) + F.make_dt_interval(
        F.lit(0), parts[0].try_cast("int"), F.get(parts, F.lit(1)).try_cast("int"), seconds
    )


def acquisition_timestamp(date: Column | str, time: Column | str) -> Column:
    """Date plus a time given as ``HMM``, ``HHMM`` or clock text, to the second if it is there."""
    text = _col(time).cast("string")
    by_clock, by_digits = clock_timestamp(date, text), hhmm_timestamp(date, normalise_hhmm(text))
    return F.when(text.contains(":"), by_clock).otherwise(by_digits)


def clock_digits(timestamp: Column | str) -> Column:
    return F.date_format(_col(timestamp), "HHmmss")


def clock_text(hhmm: Column | str) -> Column:
    """``HHMM`` as ``HH:MM``."""
    text = _col(hhmm)
    return F.concat(F.substring(text, 1, 2), F.lit(":"), F.substring(text, 3, 2))


def with_ymd(df: DataFrame, date: str = "acq_date") -> DataFrame:
    """Add the calendar parts used as partition keys."""
    return df.withColumns({"year": F.year(date), "month": F.month(date), "mday": F.dayofmonth(date)})


def day_of_year(date: Column | str) -> Column:
    """Day of the year as three digits."""
    return F.date_format(_col(date), "DDD")


def hour_axis(df: DataFrame, date: str = "date", hour: str = "hour", out: str = "time") -> DataFrame:
    """Source hours 1..24 of a date become the hours 0..23 of that date."""
    start = to_ntz(F.col(date)) + F.make_dt_interval(F.lit(0), F.col(hour).cast("int") - 1)
    return df.withColumn(out, start).drop(date, hour)


def time_label(time: Column | str, unit: str) -> Column:
    """Label of a time step: ``D`` and ``M`` for timestamps, ``month`` (two digits) and
    ``day`` (three digits) for numeric axes."""
    time = _col(time)
    if unit == "D":
        return F.date_format(time, "yyyy-MM-dd")
    if unit == "M":
        return F.date_format(time, "yyyy-MM")
    if unit == "month":
        return F.format_string("%02d", F.rint(time.cast("double")).cast("long"))
    if unit == "day":
        return F.format_string("%03d", F.rint(time.cast("double")).cast("long"))
    raise ValueError(f"unknown label unit {unit!r}")


def month_index(time: Column | str, first_year: int | Column, first_month: int | Column = 1) -> Column:
    """Months since the start of a series."""
    time = _col(time)
    return (F.year(time) - first_year) * 12 + F.month(time) - first_month


def step_number(time: Column | str, origin: Column, step_seconds: int) -> Column:
    """Whole steps from ``origin`` to ``time``; negative before it."""
    seconds = F.timestamp_diff("SECOND", origin, _col(time))
    return F.floor(seconds / F.lit(step_seconds)).cast("long")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
