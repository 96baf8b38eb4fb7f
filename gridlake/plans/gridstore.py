"""Creating a cube store from files and updating it with the files that are new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.paths import date_from_path
from gridlake.functions.times import hour_axis, to_ntz
from gridlake.operators.timeaxis import classify_dates, concat_forecast, concat_time
from gridlake.operators.axes import blank_steps
from gridlake.sources.manifests import file_manifest, new_files
from gridlake.sources.readers import read_cube
from gridlake.sources.store import commit_ledger, create_store, processed_files, upsert_timesteps

Preprocess = Callable[[DataFrame], DataFrame]


def time_from_name(pattern: str) -> Preprocess:
    """Daily files: the date in the file name replaces the time coordinate."""

    def prepare(df: DataFrame) -> DataFrame:
        return df.withColumn("time", to_ntz(date_from_path("path", pattern)))

    return prepare


def hours_from_name(pattern: str, hour: str = "hour") -> Preprocess:
    """Hourly files: the date in the file name and source hours 1..24 give the time."""

    def prepare(df: DataFrame) -> DataFrame:
        return hour_axis(df.withColumn("_date", date_from_path("path", pattern)), "_date", hour)

    return prepare


def create_from_files(
    spark: SparkSession,
    landing: str,
    root: str,
    chunk: int,
    step_seconds: int,
    preprocess: Preprocess,
    pattern: str = "*.parquet",
) -> None:
    """A store with every file of ``landing``, and its ledger."""
    files = file_manifest(spark, landing, pattern).select("path")
    cube = _read(spark, files, preprocess)
    create_store(cube, root, chunk, step_seconds)
    commit_ledger(spark, root, "create", files)


def update_from_files(
    spark: SparkSession,
    landing: str,
    root: str,
    preprocess: Preprocess,
    pattern: str = "*.parquet",
    limit: int | None = None,
    batch: str | None = None,
) -> bool:
    """Upsert the files that the ledger lacks, at most ``limit`` of them; False if there are none.

    A step may lie in several files that come in different runs, so cells are replaced one by
    one: what an earlier file brought for other cells of the step stays.
    """
    manifest = file_manifest(spark, landing, pattern).select("path")
    files = new_files(manifest, processed_files(spark, root), limit)
    if files.isEmpty():
        return False
    upsert_timesteps(root, _read(spark, files, preprocess), batch=batch, paths=files, by_cell=True)
    return True


def _read(spark: SparkSession, files: DataFrame, preprocess: Preprocess) -> DataFrame:
    # The driver holds the list of files of any scan; no content passes through it.
    paths = [r["path"] for r in files.collect()]
    return read_cube(spark, paths, preprocess=preprocess, with_path=True).drop("path")


def forecast_cube(
    base: DataFrame, forecasts: DataFrame, cells: DataFrame, axes: list[DataFrame], names: list[str]
) -> DataFrame:
    """Analysis and forecast files as one cube with a ``forecast`` dimension.

    ``base`` and ``forecasts`` are manifests (``date``, ``path``), ``cells`` the rows read
    from the files with their ``path``. Dates without usable forecasts become blank steps
    over ``axes``, which include the forecast axis.
    """
    dates = classify_dates(base, forecasts)
    complete = dates.where("status = 'complete'").select("date")
    files = base.select("date", "path", F.lit(False).alias("is_forecast")).unionByName(
        forecasts.select("date", "path", F.lit(True).alias("is_forecast"))
    )
    filled = concat_forecast(files.join(complete, "date", "left_semi"), cells)
    blank = blank_steps(dates.where("status = 'blank'").select("date").distinct(), axes, names)
    return concat_time(filled, blank.select(*filled.columns))
