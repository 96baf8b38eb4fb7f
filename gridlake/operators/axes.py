"""Products of axes, chunk ids, and blank cubes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.positions import MAX_LOCAL_ROWS, array_of, axis_index, local_table, spread_out

SLOTS = 256


def spread_over(df: DataFrame, axis: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """Every row of ``df`` at every coordinate of a one-column ``axis``.

    An axis of bounded size becomes an array that each row unfolds. A longer one is
    dealt into slots: each row visits every slot and meets there only that slot's part
    of the axis, so neither side has to fit in one task.
    """
    (name,) = axis.columns
    table = local_table(axis, max_rows)
    if table is not None:
        coordinates = array_of(table.column(0).to_pylist(), axis.schema[name].dataType)
        return spread_out(df, *df.columns).withColumn(name, F.explode(coordinates))
    slot = F.pmod(F.xxhash64(name), F.lit(SLOTS)).cast("int")
    visits = df.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    return visits.join(axis.withColumn("_slot", slot), "_slot").drop("_slot")


def complete(df: DataFrame, a: str, b: str, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """All observed values of ``a`` with all observed values of ``b``."""
    return spread_over(df.select(a).distinct(), df.select(b).distinct(), max_rows)


def chunk_ids(cube: DataFrame, chunks: dict[str, int], axes: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add ``{dim}_chunk``, the position on the axis divided by the chunk size.

    ``axes`` may give stored axes (``axis_index``), which saves a scan for each.
    """
    columns = cube.columns + [f"{dim}_chunk" for dim in chunks]
    for dim, size in chunks.items():
        axis = (axes or {}).get(dim)
        axis = axis_index(cube, dim) if axis is None else axis
        chunk = F.floor(F.col("index") / size).cast("int").alias(f"{dim}_chunk")
        cube = cube.join(axis.select(dim, chunk), dim, "left")
    return cube.select(*columns)


def blank_cube(times: DataFrame, axes: list[DataFrame], names: list[str]) -> DataFrame:
    """All times at all coordinates of the axes, with missing variables."""
    cube = times
    for axis in axes:
        cube = spread_over(cube, axis)
    return cube.withColumns({v: F.lit(None).cast("double") for v in names})


def blank_steps(dates: DataFrame, axes: list[DataFrame], names: list[str], hours: int = 1) -> DataFrame:
    """Blank steps for the given dates: one a day, or ``hours`` of them."""
    offsets = F.sequence(F.lit(0), F.lit(hours - 1))
    times = dates.select(F.col("date").cast("timestamp_ntz").alias("_day"), F.explode(offsets).alias("_hour"))
    times = times.select((F.col("_day") + F.make_dt_interval(F.lit(0), F.col("_hour"))).alias("time"))
    return blank_cube(times, axes, names)
