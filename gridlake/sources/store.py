"""The chunked cube store: create, upsert, ledger, rechunk.

Layout under the root: ``cells`` (cube rows partitioned by ``time_chunk``), ``axis``
(every time step of every chunk, so that padding needs no rows of missing cells),
``about`` (origin, step and chunk sizes), ``batches`` (the ledger) and ``staged`` (what a
running or lost update has prepared; it goes when the batch is in the ledger).

A time belongs to the chunk ``floor(steps since origin / chunk)``, so a batch knows the
chunks it touches without reading the store, and only those are rewritten.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.positions import array_of, broadcast_if_small, local_table
from gridlake.functions.times import step_number
from gridlake.model import HORIZONTAL
from gridlake.operators.axes import chunk_ids
from gridlake.operators.quality import assert_unique_time
from gridlake.operators.timeaxis import stored_times
from gridlake.session import (
    delete_path,
    list_names,
    partition_values,
    path_exists,
    path_state,
    read_text,
    write_text,
)
from gridlake.sources.sinks import write_partitions

AXIS = "time timestamp_ntz, time_chunk int"
BATCHES = "path string, processed_at timestamp, batch string"
ABOUT = "origin timestamp_ntz, step_seconds int, chunk int"
MIN_PIECE = 8 * 1024 * 1024  # bytes of a file
_SIZES = "_chunks.json"  # a name that scans pass over


def write_cube(df: DataFrame, root: str, chunks: dict[str, int]) -> None:
    """Replace a cube on disk, partitioned by time chunk and clustered by cell chunk; it remembers its chunk sizes."""
    chunked = chunk_ids(df, chunks)
    clusters = [f"{d}_chunk" for d in chunks if d != "time"]
    ordered = chunked.hint("rebalance", "time_chunk").sortWithinPartitions("time_chunk", *clusters, "time", *_horizontal(df))
    _write_chunks(ordered.drop(*clusters), root, mode="static")
    write_text(df.sparkSession, f"{root}/{_SIZES}", json.dumps(chunks))


@dataclass(frozen=True)
class RechunkPlan:
    """How a cube gets other time chunks.

    ``kind`` is ``merge`` where whole old chunks make up the new ones, ``split`` where old chunks are cut, and
    ``shuffle`` where cutting would leave files below ``MIN_PIECE`` or a task would read more than the cap.
    """

    kind: str
    pieces: int
    piece_bytes: int
    partitions: int


def plan_rechunk(steps: int, n_bytes: int, source: int, target: int, cap_bytes: int, task_bytes: int) -> RechunkPlan:
    """The plan for ``steps`` time steps of ``n_bytes`` in all; a task that reads files reads ``task_bytes`` at most.

    A piece is what an old and a new chunk have in common. Without a shuffle every piece becomes a file.
    """
    ends = {min(steps, k * n) for n in (source, target) for k in range(1, -(-steps // n) + 1)}
    pieces = len(ends)
    size = n_bytes // max(1, pieces)
    partitions = max(1, -(-n_bytes // cap_bytes))
    if task_bytes > cap_bytes:
        kind = "shuffle"
    elif target % source == 0:
        kind = "merge"
    else:
        kind = "split" if size >= MIN_PIECE or pieces <= 2 * -(-steps // target) else "shuffle"
    return RechunkPlan(kind, pieces, size, partitions)


def rechunk(
    spark: SparkSession, source: str, target: str, chunks: dict[str, int], cap_bytes: int = 1 << 30
) -> RechunkPlan | None:
    """Write a cube again with other chunk sizes, with tasks of at most ``cap_bytes`` of input.

    Chunks that fit into the new ones are copied by the tasks that read them; chunks that are cut are
    written in pieces by the same tasks. Rows are shuffled only where the plan says so, or where the source does not know
    its chunk sizes (None is returned then); a shuffle spills beyond memory.
    """
    cube = spark.read.parquet(source)
    if not path_exists(spark, f"{source}/{_SIZES}") or "time" not in chunks:
        write_cube(cube.drop("time_chunk"), target, chunks)
        return None
    old = json.loads(read_text(spark, f"{source}/{_SIZES}"))["time"]
    plan = plan_rechunk(
        cube.select("time").distinct().count(), path_state(spark, source)[0], old, chunks["time"], cap_bytes,
        int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))),
    )
    _write_chunks(rechunked(cube, old, chunks, plan), target, mode="static")
    write_text(spark, f"{target}/{_SIZES}", json.dumps(chunks))
    return plan


def rechunked(cube: DataFrame, old: int, chunks: dict[str, int], plan: RechunkPlan) -> DataFrame:
    """``cube`` with new time chunks and in the order of its cell chunks within each task.

    A row of an old chunk that lies in one new chunk needs no look at its time. For the others, times are
    numbered chunk by chunk: every chunk but the last has ``old`` of them.
    """
    new = chunks["time"]
    first, last = (F.floor((F.col("time_chunk") * old + end) / new).cast("int") for end in (0, old - 1))
    whole = cube.where(first == last).withColumn("time_chunk", first)
    if plan.kind == "merge":
        return _clustered(whole, cube, chunks)
    cut = cube.where(first != last)
    times = cut.select("time_chunk", "time").distinct()
    place = F.row_number().over(Window.partitionBy("time_chunk").orderBy("time")) - 1 + F.col("time_chunk") * old
    times = broadcast_if_small(times.select("time_chunk", "time", F.floor(place / new).cast("int").alias("_new")))
    moved = cut.join(times, ["time_chunk", "time"]).withColumn("time_chunk", F.col("_new")).select(*cube.columns)
    if plan.kind == "shuffle":  # by ranges, so that a task writes few chunks: hardly more files than tasks and chunks
        moved = moved.repartitionByRange(plan.partitions, "time_chunk", *(_horizontal(cube) or ["time"]))
    return _clustered(whole.unionByName(moved), cube, chunks)


def _clustered(rows: DataFrame, cube: DataFrame, chunks: dict[str, int]) -> DataFrame:
    """Rows in the order of time chunk and cell chunk; a cell chunk is found among the first labels of all."""
    order = []
    for dim in (d for d in chunks if d in _horizontal(cube)):
        labels = local_table(cube.select(dim).where(F.col(dim).isNotNull()).distinct())
        if labels is not None:
            starts = sorted(labels.column(0).to_pylist())[:: chunks[dim]]
            order.append(_up_to(starts, cube.schema[dim].dataType, F.col(dim)))
    return rows.sortWithinPartitions("time_chunk", *order, "time", *_horizontal(cube))


def _up_to(labels: list, kind: T.DataType, value: Column) -> Column:
    """How many of the sorted ``labels`` are at most ``value``, by halving."""
    halves = array_of([1 << bit for bit in reversed(range(len(labels).bit_length()))], T.IntegerType())
    table = array_of(labels, kind)
    return F.aggregate(halves, F.lit(0), lambda low, half: F.when(F.get(table, low + half - 1) <= value, low + half).otherwise(low))


def _by_cell(df: DataFrame) -> DataFrame:
    """Neighbouring cells together, so that row groups have narrow bounds."""
    return df.sortWithinPartitions("time_chunk", *_horizontal(df), "time")


def _horizontal(df: DataFrame) -> list[str]:
    return [c for c in HORIZONTAL if c in df.columns]


def _write_chunks(df: DataFrame, root: str, mode: str) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy("time_chunk").parquet(root)


def create_store(df: DataFrame, root: str, chunk: int, step_seconds: int) -> None:
    """Create or replace a store, its ledger included. Its axis starts at the first time of
    ``df`` and is padded to whole chunks, a full one more when it was whole already. Rows
    without a time are an error, found before anything is replaced."""
    spark = df.sparkSession
    missing = F.count_if(F.col("time").isNull())
    first, last, missing = df.agg(F.min("time").cast("string"), F.max("time").cast("string"), missing).first()
    if missing:
        raise ValueError(f"{missing} rows have no time")
    for part in ("staged", "batches"):
        delete_path(spark, f"{root}/{part}")
    about = spark.range(1).select(
        F.lit(first).cast("timestamp_ntz").alias("origin"),
        F.lit(step_seconds).alias("step_seconds"),
        F.lit(chunk).alias("chunk"),
    )
    about.write.mode("overwrite").parquet(f"{root}/about")
    meta = about.first()
    steps = spark.range(1).select(step_number(F.lit(last).cast("timestamp_ntz"), _origin(meta), step_seconds))
    last_chunk = (steps.first()[0] + 1) // chunk
    _axis_chunks(spark, meta, 0, last_chunk).write.mode("overwrite").partitionBy("time_chunk").parquet(f"{root}/axis")
    cells = _with_chunk(df, meta).hint("rebalance", "time_chunk")
    _write_chunks(_by_cell(cells), f"{root}/cells", mode="static")


def read_cells(
    spark: SparkSession, root: str, since: dt.datetime | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """The cells of a store, at the times from ``since`` to ``until``, both included.

    The bounds prune the directories of time chunks, which a filter on ``time`` would not.
    """
    cells = spark.read.parquet(f"{root}/cells")
    if since is None and until is None:
        return cells
    meta = spark.read.schema(ABOUT).parquet(f"{root}/about").first()
    if since is not None:
        cells = cells.where((F.col("time_chunk") >= _chunk_of(since, meta)) & (F.col("time") >= _ntz(since)))
    if until is not None:
        cells = cells.where((F.col("time_chunk") <= _chunk_of(until, meta)) & (F.col("time") <= _ntz(until)))
    return cells


def _chunk_of(time: dt.datetime, meta: Row) -> int:
    steps = (time - meta["origin"]) // dt.timedelta(seconds=meta["step_seconds"])
    return steps // meta["chunk"]


def _ntz(time: dt.datetime) -> Column:
    return F.lit(time.isoformat()).cast("timestamp_ntz")


def read_axis(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AXIS).parquet(f"{root}/axis")


def upsert_timesteps(
    root: str,
    new: DataFrame,
    keys: tuple[str, ...] = ("time",),
    extend: bool = True,
    batch: str | None = None,
    paths: DataFrame | None = None,
    by_cell: bool = False,
) -> None:
    """Put the steps of ``new`` into the store.

    A stored step with the same ``keys`` is replaced as a whole, or ``by_cell`` only its
    cells that ``new`` has, for batches that may hold parts of steps; a step beyond the axis
    extends it by as many chunks as needed, and an earlier one is inserted. With
    ``extend=False`` only steps on the axis are taken. Steps stored twice are an error, and
    so are rows without a time or with one between two steps: the batch is refused whole
    before it changes anything.

    The rows and then the merged chunks are staged below the root, published, entered in the
    ledger and removed from staging. What a lost job staged is published before anything else,
    and a ``batch`` that is in the ledger is not taken again. A store has one writer at a time.
    """
    spark = new.sparkSession
    batch = batch or uuid.uuid4().hex
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch name has letters, digits, dots and dashes, not {batch!r}")
    recover(spark, root)
    if _committed(spark, root, batch):
        return
    meta = spark.read.schema(ABOUT).parquet(f"{root}/about").first()
    on_axis = _axis_summary(spark, root)
    if not extend:
        new = stored_times(new, read_axis(spark, root))
    if by_cell:
        keys = (*keys, *[c for c in (*HORIZONTAL, "forecast") if c in new.columns and c not in keys])

    staged = f"{root}/staged/{batch}"
    _with_chunk(new, meta).write.mode("overwrite").parquet(f"{staged}/new")
    new = spark.read.parquet(f"{staged}/new")
    _refuse_off_axis(new, meta, staged)
    merged = _merged(read_cells(spark, root), new, keys)
    if paths is not None:
        paths.select("path").write.mode("overwrite").parquet(f"{staged}/paths")
    _write_chunks(_by_cell(merged.hint("rebalance", "time_chunk")), f"{staged}/cells", mode="static")
    _publish(spark, root, meta, on_axis, batch, extend)


def _refuse_off_axis(new: DataFrame, meta: Row, staged: str) -> None:
    """Fail, and forget what was staged, where a time is missing or between two steps."""
    seconds = F.timestamp_diff("MICROSECOND", _origin(meta), F.col("time"))
    between = F.pmod(seconds, F.lit(meta["step_seconds"] * 1_000_000)) != 0
    wrong = new.agg(F.count_if(F.col("time").isNull()).alias("missing"), F.count_if(between).alias("between")).first()
    if wrong["missing"] or wrong["between"]:
        delete_path(new.sparkSession, staged)
        raise ValueError(f"{wrong['missing']} rows have no time, {wrong['between']} one that is not on the axis")


def _merged(stored: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The chunks that ``new`` touches, with its steps in place of the stored ones."""
    # Numbers of the directories to rewrite, which the scan of the stored cells is pruned to.
    chunks = [r["time_chunk"] for r in new.select("time_chunk").distinct().collect()]
    steps = new.select("time_chunk", *keys).distinct()
    kept = stored.where(F.col("time_chunk").isin(chunks)).join(steps, ["time_chunk", *keys], "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def recover(spark: SparkSession, root: str) -> None:
    """Publish what a lost job staged but did not enter in the ledger."""
    for batch in list_names(spark, f"{root}/staged"):
        if _committed(spark, root, batch) or not path_exists(spark, f"{root}/staged/{batch}/cells/_SUCCESS"):
            delete_path(spark, f"{root}/staged/{batch}")
        else:
            meta = spark.read.schema(ABOUT).parquet(f"{root}/about").first()
            _publish(spark, root, meta, _axis_summary(spark, root), batch, extend=True)


def _publish(spark: SparkSession, root: str, meta: Row, on_axis: Row, batch: str, extend: bool) -> None:
    staged = f"{root}/staged/{batch}"
    chunks = [int(c) for c in partition_values(spark, f"{staged}/cells", "time_chunk")]
    if chunks:
        if extend:
            _extend_axis(spark, root, meta, on_axis, min(chunks), max(chunks))
        _write_chunks(_by_cell(spark.read.parquet(f"{staged}/cells")), f"{root}/cells", mode="dynamic")
    paths = f"{staged}/paths"
    commit_ledger(spark, root, batch, spark.read.schema("path string").parquet(paths) if path_exists(spark, paths) else None)
    delete_path(spark, staged)


def _origin(meta: Row) -> Column:
    return _ntz(meta["origin"])


def _with_chunk(df: DataFrame, meta: Row) -> DataFrame:
    steps = step_number("time", _origin(meta), meta["step_seconds"])
    return df.withColumn("time_chunk", F.floor(steps / meta["chunk"]).cast("int"))


def _axis_chunks(spark: SparkSession, meta: Row, first: int, last: int) -> DataFrame:
    """Every step of the chunks ``first`` to ``last``."""
    steps = spark.range(first * meta["chunk"], (last + 1) * meta["chunk"])
    seconds = (F.col("id") * meta["step_seconds"]).cast("decimal(18,6)")
    return steps.select(
        (_origin(meta) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("time"),
        F.floor(F.col("id") / meta["chunk"]).cast("int").alias("time_chunk"),
    )


def _axis_summary(spark: SparkSession, root: str) -> Row:
    """First and last chunk; an error when a time is on the axis twice."""
    axis = read_axis(spark, root)
    n, times = F.count("*").alias("n"), F.count_distinct("time").alias("times")
    summary = axis.agg(n, times, F.min("time_chunk").alias("low"), F.max("time_chunk").alias("high")).first()
    if summary["n"] != summary["times"]:
        assert_unique_time(axis)
    return summary


def _extend_axis(spark: SparkSession, root: str, meta: Row, on_axis: Row, first: int, last: int) -> None:
    for a, b in ((on_axis["high"] + 1, last), (first, on_axis["low"] - 1)):
        if a <= b:
            write_partitions(_axis_chunks(spark, meta, a, b), f"{root}/axis", ("time_chunk",))


def commit_ledger(spark: SparkSession, root: str, batch: str, paths: DataFrame | None = None) -> None:
    """Record a batch and the files it processed. Recording it again replaces the record."""
    if paths is None:
        paths = spark.range(1).select(F.lit(None).cast("string").alias("path"))
    rows = paths.select("path", F.current_timestamp().alias("processed_at"), F.lit(batch).alias("batch"))
    write_partitions(rows, f"{root}/batches", ("batch",))


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """Processed files by batch; none before the first batch."""
    if not path_exists(spark, f"{root}/batches"):
        return spark.createDataFrame([], BATCHES)
    return spark.read.option("basePath", f"{root}/batches").parquet(f"{root}/batches")


def processed_files(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, root).select("path").where(F.col("path").isNotNull()).distinct()


def _committed(spark: SparkSession, root: str, batch: str) -> bool:
    return path_exists(spark, f"{root}/batches/batch={batch}")
