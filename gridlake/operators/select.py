"""Choosing variables, regions, times and cells; columns and constants; order and limits."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.geo import wrap_lon
from gridlake.functions.positions import axis_index
from gridlake.model import KEYS, attrs, set_attrs, variables


def select_variables(
    df: DataFrame, names: list[str] | None = None, prefix: str | None = None, keys: tuple[str, ...] = KEYS
) -> DataFrame:
    """Keys plus the named variables, or those starting with ``prefix``."""
    if names is None:
        names = [v for v in variables(df) if v.startswith(prefix or "")]
    return df.select(*[k for k in keys if k in df.columns], *names)


def rename_dims(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def suffix_variables(df: DataFrame, suffix: str) -> DataFrame:
    """Add a suffix to every variable, e.g. ``_pm`` for the afternoon pass."""
    return df.withColumnsRenamed({v: v + suffix for v in variables(df)})


def reorder_first(df: DataFrame, *first: str) -> DataFrame:
    return df.select(*first, *[c for c in df.columns if c not in first])


def cast_matching(df: DataFrame, pattern: str, to: str) -> DataFrame:
    """Cast the columns whose names match a regular expression."""
    return df.withColumns({c: F.col(c).cast(to) for c in df.columns if re.search(pattern, c)})


def bbox(df: DataFrame, region: str | tuple[float, float, float, float]) -> DataFrame:
    """Cells inside a box, ends included: a region name or (lat0, lat1, lon0, lon1)."""
    lat0, lat1, lon0, lon1 = fixed.REGIONS[region] if isinstance(region, str) else region
    return df.where(F.col("lat").between(lat0, lat1) & F.col("lon").between(lon0, lon1))


def wrapped_bbox(df: DataFrame, region: str | tuple[float, float, float, float]) -> DataFrame:
    """A box in longitudes -180..180 on a cube in longitudes 0..360, which is wrapped.

    The box is stated in the cube's own longitudes first, a little wide, so that it
    reaches the scan; after wrapping it is applied exactly.
    """
    lat0, lat1, lon0, lon1 = fixed.REGIONS[region] if isinstance(region, str) else region
    east = F.col("lon").between(lon0 - 1e-6, lon1 + 1e-6)
    west = F.col("lon").between(lon0 + 360 - 1e-6, lon1 + 360 + 1e-6)
    near = df.where(F.col("lat").between(lat0, lat1) & (east | west))
    return near.transform(wrap_lon).transform(bbox, region)


def time_slice(df: DataFrame, first: dt.date, last: dt.date, time: str = "time") -> DataFrame:
    """Times from the start of ``first`` to the end of ``last``."""
    after = last + dt.timedelta(days=1)
    return df.where((F.col(time) >= _ntz(first)) & (F.col(time) < _ntz(after)))


def time_between_open(df: DataFrame, after: dt.datetime, before: dt.datetime, time: str = "time") -> DataFrame:
    return df.where((F.col(time) > _ntz(after)) & (F.col(time) < _ntz(before)))


def on_date(df: DataFrame, date: dt.date, column: str = "acq_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(date))


def since(df: DataFrame, date: dt.date, column: str = "acq_date") -> DataFrame:
    return df.where(F.col(column) >= F.lit(date))


def where_label(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).rlike(pattern))


def isel(
    df: DataFrame, dim: str, start: int = 0, stop: int | None = None, step: int = 1, axis: DataFrame | None = None
) -> DataFrame:
    """Positions ``start:stop:step`` of a dimension. ``axis`` (from ``axis_index``) saves a scan."""
    axis = axis_index(df, dim) if axis is None else axis
    place = F.col("index")
    chosen = (place >= start) & ((place - start) % step == 0)
    if stop is not None:
        chosen = chosen & (place < stop)
    return df.join(axis.where(chosen).select(dim), dim, "left_semi")


def sel(df: DataFrame, **labels) -> DataFrame:
    """Rows at the given coordinate labels."""
    for column, value in labels.items():
        value = _ntz(value) if isinstance(value, (dt.datetime, dt.date)) else F.lit(value)
        df = df.where(F.col(column) == value)
    return df


def sel_nearest(df: DataFrame, axes: dict[str, DataFrame] | None = None, **targets: float) -> DataFrame:
    """Rows at the label nearest to each target, axis by axis; the larger label wins a tie.

    The labels reach the scan as filters. ``axes`` (from ``axis_index``) saves the scan
    that finds them.
    """

    def nearest(dim: str, target: float) -> Column:
        return F.min_by(dim, F.struct(F.abs(F.col(dim) - target), -F.col(dim))).alias(dim)

    given = {d: axes[d].agg(nearest(d, v)).first()[0] for d, v in targets.items() if d in (axes or {})}
    others = [nearest(d, v) for d, v in targets.items() if d not in given]
    if others:
        given.update(df.agg(*others).first().asDict())
    return sel(df, **given)


def add_dim(df: DataFrame, name: str, value, type_name: str) -> DataFrame:
    """A constant column or dimension; ``None`` gives a typed missing value."""
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(name, value.cast(type_name))


def rescale(df: DataFrame, name: str, factor: float, offset: float = 0.0, units: str | None = None, out: str | None = None) -> DataFrame:
    """A variable times ``factor`` plus ``offset``, in place or as ``out``; its attributes stay but for the new ``units``."""
    out = out or name
    kept = attrs(df, name) | ({"units": units} if units else {})
    return set_attrs(df.withColumn(out, F.col(name) * factor + offset), out, kept)


def difference(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``a`` less ``b``, missing where either is, with the attributes of ``a``."""
    return set_attrs(df.withColumn(out, F.col(a) - F.col(b)), out, attrs(df, a))


def fill_nodata(df: DataFrame, columns: list[str], nodata: float) -> DataFrame:
    """Missing values, NULL or NaN, as a number."""
    return df.withColumns(
        {c: F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(nodata)) for c in columns}
    )


def mask_nodata(df: DataFrame, columns: list[str], nodata: float) -> DataFrame:
    """A number as missing."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(nodata)) for c in columns})


def sort_by_time(df: DataFrame, *more: str) -> DataFrame:
    """Total order for display; writers sort inside partitions instead."""
    return df.orderBy("time", *more)


def raster_order(df: DataFrame) -> DataFrame:
    """Rows from the top, columns from the left."""
    return df.orderBy(F.desc("lat"), F.asc("lon"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def _ntz(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("timestamp_ntz")
