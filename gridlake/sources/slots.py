"""The slot ledger of the detection store: one slot for the file of each date and instrument.

A slot is open until its file was stored, so a file that comes late, or that was delivered with
a wrong header, is read by whichever run finds it in order; other slots neither wait for it nor lose
rows by it. Beside the store lie ``{root}_slots`` (what each run found, the ledger),
``{root}_rejects`` (lines that could not be read) and ``{root}_staged`` (what a running or lost run prepared).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.model import STORE_KEYS
from gridlake.session import delete_path, list_names, partition_values, path_exists
from gridlake.sources.sinks import write_partitions

STORED, FAILED, GIVEN_UP, START = "stored", "failed", "given up", "start"

SLOTS = (
    "date date, instrument string, state string, path string, length long, modified long, rows long, "
    "rejected long, run long"
)
REJECTS = "date date, instrument string, path string, line string, run long"


def read_slots(spark: SparkSession, root: str) -> DataFrame:
    """The last state of every slot that a run found something for. Open slots without a file have no row."""
    latest = _history(spark, root).where(F.col("state") != START).groupBy("date", "instrument")
    rest = [c.split()[0] for c in SLOTS.split(", ")[2:]]
    return latest.agg(F.max_by(F.struct(*rest), "run").alias("last")).select("date", "instrument", "last.*")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Lines that no run could read, with their slot. A slot that was read again has the lines of its last run."""
    if not path_exists(spark, f"{root}_rejects"):
        return spark.createDataFrame([], REJECTS)
    rejects = spark.read.schema(REJECTS).parquet(f"{root}_rejects")
    return rejects.join(read_slots(spark, root).select("date", "instrument", "run"), ["date", "instrument", "run"], "left_semi")


def open_slots(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``wanted`` (``date``, ``instrument``, ``path``) that are neither stored nor given up."""
    closed = read_slots(spark, root).where(F.col("state").isin(STORED, GIVEN_UP))
    return wanted.join(closed, ["date", "instrument"], "left_anti")


def give_up(spark: SparkSession, root: str, slots: DataFrame) -> None:
    """Close the open slots ``date, instrument`` for good, say of an instrument that is no longer flown."""
    rows = slots.select("date", "instrument", F.lit(GIVEN_UP).alias("state"))
    _append(rows, root, next_run(spark, root))


def start_date(spark: SparkSession, root: str) -> dt.date | None:
    """The date of the first slots; None before the first run."""
    return _history(spark, root).where(F.col("state") == START).agg(F.min("date")).first()[0]


def begin(spark: SparkSession, root: str, date: dt.date) -> None:
    row = spark.range(1).select(F.lit(date).alias("date"), F.lit(START).alias("state"))
    _append(row, root, next_run(spark, root))


def next_run(spark: SparkSession, root: str) -> int:
    """A number after those of all runs, the staged ones included."""
    names = [n for t in ("slots", "staged") for n in list_names(spark, f"{root}_{t}")]
    return 1 + max((int(n.split("=")[1]) for n in names if n.startswith("run=")), default=0)


def _history(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}_slots"):
        return spark.createDataFrame([], SLOTS)
    return spark.read.schema(SLOTS).parquet(f"{root}_slots")


def _append(rows: DataFrame, root: str, run: int) -> None:
    """Record rows as ``run``. Recording a run again replaces it."""
    types = dict(c.split() for c in SLOTS.split(", "))
    columns = [F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in types.items() if c != "run"]
    write_partitions(rows.select(*columns, F.lit(run).cast("long").alias("run")), f"{root}_slots", ("run",))


def stage(root: str, run: int, part: str) -> str:
    return f"{root}_staged/run={run}/{part}"


def publish(spark: SparkSession, root: str, run: int, write) -> None:
    """Put a staged run into the store by ``write(rows, root)``, then into the ledger. Doing it again changes nothing."""
    data = stage(root, run, "data")
    if partition_values(spark, data, STORE_KEYS[0]):
        write(data)
    rejects = spark.read.parquet(stage(root, run, "rejects"))
    if not rejects.isEmpty():
        write_partitions(rejects.withColumn("run", F.lit(run).cast("long")), f"{root}_rejects", ("run",))
    _append(spark.read.schema(SLOTS).parquet(stage(root, run, "slots")), root, run)
    delete_path(spark, f"{root}_staged/run={run}")


def recover(spark: SparkSession, root: str, write) -> None:
    """Publish what a lost run staged whole, in order, and drop what it did not."""
    runs = sorted(int(n.split("=")[1]) for n in list_names(spark, f"{root}_staged"))
    for run in runs:
        # The slots are staged last, so they say that everything else is there.
        if path_exists(spark, f"{stage(root, run, 'slots')}/_SUCCESS"):
            publish(spark, root, run, write)
        else:
            delete_path(spark, f"{root}_staged/run={run}")
