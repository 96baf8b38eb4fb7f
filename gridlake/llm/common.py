"""Shared helpers: stored tables, running totals, groups that span Arrow batches, connected components."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake.session import path_exists, scratch_dir, stored

__all__ = ["components", "free_name", "gives_memory_back", "joined_by_key", "null_to_empty", "running_total", "small_batches", "stored", "stored_once", "whole_groups"]

HOT_SHARE = 1000  # a key is hot when it has more than one of so many rows


def null_to_empty(text):
    """The texts of a batch as a list, null as the empty text."""
    return ["" if t is None else t for t in text]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Tables written inside hand whole texts to Python at most ``rows`` at a time, which bounds its memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def gives_memory_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``function`` of a task's batches; behind the last one, what the worker freed goes back to the system.

    A worker goes on to other stages, and what its allocators keep of one would lie beside what the next one needs.
    """

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return run


def stored_once(spark: SparkSession, made: Callable[[], DataFrame], name: str) -> DataFrame:
    """The table of this name in scratch space, made and written only where it is not there whole."""
    path = scratch_dir(spark, name)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        made().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores until no column of ``taken`` has it in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def joined_by_key(rows: DataFrame, table: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row and the number ``n`` of rows for each key.

    Keys with at least a thousandth of all rows are at most a thousand: those are broadcast, so
    that no task of the shuffle for the others gets a hot key. Null keys match nothing.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * HOT_SHARE >= total
    often = F.broadcast(table.where(hot))
    rest = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(table.where(~hot), key)
    return rows.join(often, key).unionByName(rest)


def running_total(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows before, within ``by`` and in ``order``.

    The order is cut into ranges; each range sums its own rows and adds the total of the ranges
    before it, so a ``by`` with a third of all rows is spread over many tasks. Rows that tie in
    ``order`` should be merged by the caller.
    """
    cut = stored(
        df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "ranges"
    )
    parts = cut.groupBy(*by, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*by, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "_part"]]
    return cut.alias("a").join(parts.alias("b"), same).select(
        *[F.col(f"a.{c}") for c in df.columns], (F.col("_base") + F.col("_in")).alias(out)
    )


def whole_groups(frames: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames in which every run of ``key`` is complete; the input has equal keys side by side."""
    rest = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = (frame[key].to_numpy() != frame[key].iloc[-1]).nonzero()[0]
        end = last[-1] + 1 if len(last) else 0
        if end:
            yield frame.iloc[:end].reset_index(drop=True)
        rest = frame.iloc[end:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node reachable from each node of ``edges`` ``(a, b)``.

    Alternating large and small stars; each round is written to shared storage, which cuts the
    lineage. Minima are aggregated before the shuffle, so the hub of a large star is no hot group.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(ends.where("a != b").distinct(), "edges")
    size = _weight(now)
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        near = large.join(low, F.col("a") == F.col("u"))
        small = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        then = stored(small.where("a != b").distinct(), "edges")
        after = _weight(then)
        if after == size:
            return then.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                then.select("b", "b").distinct()
            )
        now, size = then, after


def _weight(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: their number and two sums of hashes."""
    hashed = [F.sum(F.xxhash64("a", "b", F.lit(i)) % 1_000_000_007) for i in (1, 2)]
    return tuple(edges.agg(F.count("*"), *hashed).first())
