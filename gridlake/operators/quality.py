"""Completeness and consistency checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.positions import MAX_LOCAL_ROWS, array_of, local_table
from gridlake.functions.times import to_ntz
from gridlake.model import KEYS
from gridlake.operators.axes import complete


def missing_pairs(df: DataFrame, a: str, b: str, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame:
    """Pairs of an observed ``a`` and an observed ``b`` that never occur together.

    With a bounded number of ``b`` values, the set seen with each ``a`` is subtracted
    from all of them, so only missing pairs are produced. Otherwise all pairs are
    formed in slots and the observed ones removed.
    """
    table = local_table(df.select(b).where(F.col(b).isNotNull()).distinct(), max_rows)
    if table is None:
        return complete(df, a, b, max_rows).join(df.select(a, b).distinct(), [a, b], "left_anti")
    every = array_of(table.column(0).to_pylist(), df.schema[b].dataType)
    seen = df.groupBy(a).agg(F.collect_set(b).alias("_seen"))
    return seen.select(a, F.explode(F.array_except(every, "_seen")).alias(b))


def absent_keys(wanted: DataFrame, present: DataFrame, *keys: str) -> DataFrame:
    """Distinct ``keys`` of ``wanted`` that no row of ``present`` has; a missing key equals a missing key."""
    return wanted.select(*keys).subtract(present.select(*keys).distinct())


def check_ledger(store: DataFrame, ledger: DataFrame, chunk: int, steps_per_day: int = 24) -> DataFrame:
    """One row of checks of a store's time axis against its ledger of dates.

    The axis must be whole chunks, exceed the ledger by less than one chunk, and hold
    every step of every ledger date.
    """
    axis = store.select("time").distinct()
    dates = ledger.select("date").distinct()
    offsets = F.sequence(F.lit(0), F.lit(steps_per_day - 1))
    seconds = (F.col("_step") * (86400 // steps_per_day)).cast("decimal(18,6)")
    expected = dates.withColumn("_step", F.explode(offsets)).select(
        (to_ntz(F.col("date")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("time")
    )
    marks = reduce(
        DataFrame.unionByName,
        [
            axis.select(F.lit("axis").alias("kind")),
            expected.select(F.lit("expected").alias("kind")),
            expected.join(axis, "time", "left_anti").select(F.lit("absent").alias("kind")),
        ],
    )

    def n(kind: str):
        return F.count(F.when(F.col("kind") == kind, 1))

    spare = n("axis") - n("expected")
    return marks.agg(
        n("axis").alias("n_steps"),
        n("expected").alias("n_expected"),
        n("absent").alias("n_absent"),
        (n("axis") % chunk == 0).alias("whole_chunks"),
        (spare < chunk).alias("spare_below_chunk"),
        (F.floor(n("axis") / steps_per_day) == F.floor((n("expected") + spare) / steps_per_day)).alias("days_agree"),
        (n("absent") == 0).alias("all_present"),
    )


def compare_cubes(
    a: DataFrame, b: DataFrame, names: list[str], keys: tuple[str, ...] = KEYS, tolerance: float | None = None
) -> DataFrame:
    """Per variable, the number of compared and of differing cells of two cubes.

    Values are equal when they agree as integers or, with ``tolerance``, differ by no
    more than that; missing equals missing. Both cubes are stacked and aggregated by key.
    """
    sides = [
        side.select(*keys, *[F.col(v).alias(f"{tag}_{v}") for v in names])
        for tag, side in (("a", a), ("b", b))
    ]
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    cells = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])

    def same(v: str):
        x, y = F.col(f"a_{v}"), F.col(f"b_{v}")
        if tolerance is None:
            return _truncated(x).eqNullSafe(_truncated(y))
        return F.coalesce(F.abs(x - y) <= tolerance, x.isNull() & y.isNull())

    counts = [F.count(F.when(~same(v), 1)).alias(v) for v in names]
    return (
        cells.agg(F.count("*").alias("n_cells"), *counts)
        .unpivot(["n_cells"], names, "variable", "n_different")
        .select("variable", "n_cells", "n_different")
    )


def _truncated(value: Column) -> Column:
    return F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))


def duplicate_times(df: DataFrame, keys: tuple[str, ...] = ("time",)) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def assert_unique_time(df: DataFrame, keys: tuple[str, ...] = ("time",)) -> DataFrame:
    """``df`` itself, or an error when a key occurs more than once."""
    worst = duplicate_times(df, keys).orderBy(F.desc("n")).limit(1).collect()
    if worst:
        raise ValueError(f"{worst[0]['n']} rows match {worst[0].asDict()}")
    return df


def rebuild_ledger(store: DataFrame, manifest: DataFrame) -> DataFrame:
    """The file of each stored date; an error where there is not exactly one."""
    dates = store.select(F.to_date("time").alias("date")).distinct()
    files = manifest.groupBy("date").agg(F.count("*").alias("_n"), F.min("path").alias("path"))
    n = F.coalesce("_n", F.lit(0))
    message = F.concat(F.lit("files for "), F.col("date").cast("string"), F.lit(": "), n.cast("string"))
    path = F.when(n == 1, F.col("path")).otherwise(F.raise_error(message))
    return dates.join(files, "date", "left").select("date", path.alias("path"))


def count_files_and_steps(files: DataFrame, cube: DataFrame) -> DataFrame:
    """Number of files, number of time steps, and whether they agree."""
    marks = files.select(F.lit(1).alias("f"), F.lit(0).alias("t")).unionAll(
        cube.select("time").distinct().select(F.lit(0).alias("f"), F.lit(1).alias("t"))
    )
    n_files, n_steps = (F.coalesce(F.sum(c), F.lit(0)) for c in ("f", "t"))
    return marks.agg(n_files.alias("n_files"), n_steps.alias("n_steps"), (n_files == n_steps).alias("agree"))


def assert_counts(files: DataFrame, cube: DataFrame) -> None:
    row = count_files_and_steps(files, cube).first()
    if not row["agree"]:
        raise ValueError(f"{row['n_files']} files but {row['n_steps']} time steps")
