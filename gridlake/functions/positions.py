"""Positions in an order, and tables small enough to broadcast.

A position over a whole group would sort that group in one task. Here the order
is cut into ranges of about ``ROWS_PER_SPLIT`` rows first, as many as it takes, each range is
numbered on its own, and the number of rows before a range is added from a table with one row for each
range and each group in it: a million rows for 10^12.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.session import stored

MAX_LOCAL_ROWS = 100_000
ROWS_PER_SPLIT = 1_000_000


def local_table(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> pa.Table | None:
    """The rows of ``df`` on the driver, or None when there are more than ``max_rows``."""
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows else None


def array_of(values: list, kind: T.DataType) -> Column:
    """A constant array. One literal however many values there are; it is folded once."""
    texts = json.dumps([None if v is None else str(v) for v in values])
    return F.from_json(F.lit(texts), "array<string>").cast(T.ArrayType(kind))


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """``df`` marked for broadcast once its size is known to be bounded; otherwise as it is."""
    table = local_table(df, max_rows)
    if table is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))


def spread_out(df: DataFrame, *columns: str) -> DataFrame:
    """Rows over all shuffle partitions, for rows that are few but unfold to many.

    The fixed number keeps adaptive execution from merging partitions by their present size.
    """
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(slots, *columns)


def axis_index(
    df: DataFrame,
    dim: str,
    descending: bool = False,
    name: str = "index",
    max_rows: int = MAX_LOCAL_ROWS,
) -> DataFrame:
    """Distinct coordinates of a dimension with their 0-based position."""
    values = df.select(dim).where(F.col(dim).isNotNull()).distinct()
    table = local_table(values, max_rows)
    if table is None:
        return ordered_position(values, [dim], name=name, descending=descending)
    table = table.sort_by([(dim, "descending" if descending else "ascending")])
    table = table.append_column(name, pa.array(range(table.num_rows), pa.int64()))
    schema = T.StructType([values.schema[dim], T.StructField(name, T.LongType())])
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=schema))


def ordered_position(
    df: DataFrame,
    order: list[str],
    keys: tuple[str, ...] = (),
    name: str = "position",
    descending: bool = False,
    weight: str | None = None,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Add the number of rows before each row (or their summed ``weight``) within ``keys``.

    Rows with equal ``order`` fall into one range; give an order that tells rows apart.
    """
    ranges = df.count() // rows_per_split
    amount = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    direction = [F.desc(c) if descending else F.asc(c) for c in order]
    parts = df.withColumn("_amount", amount)
    if ranges < 2:
        parts = parts.withColumn("_part", F.lit(0))
    else:  # stored, so that a range keeps its number when a task is run again
        ordered = parts.repartitionByRange(ranges, *[F.asc(k) for k in keys], *direction)
        parts = stored(ordered.withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(*keys, "_part").orderBy(*direction)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = parts.withColumn(name, F.coalesce(F.sum("_amount").over(before), F.lit(0)))
    if ranges < 2:
        return numbered.drop("_part", "_amount")

    totals = parts.groupBy(*keys, "_part").agg(F.sum("_amount").alias("_amount"))
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_part").alias("_offset_part"),
        F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = F.col("_part") == F.col("_offset_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (
        numbered.join(offsets, same)
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_part", "_amount", "_offset_part", "_offset", *[f"_k_{k}" for k in keys])
    )
