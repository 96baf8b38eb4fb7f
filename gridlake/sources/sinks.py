"""Writers of detections, daily text, and time series.

Every writer spreads its rows with a rebalance hint: small partitions are merged, and
a partition that holds much of the data is cut into several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.times import day_of_year, to_ntz
from gridlake.model import KEYS, STORE_KEYS
from gridlake.session import partition_values, path_exists
from gridlake.sources.readers import read_store


class IncompletePartition(ValueError):
    """A write would drop instruments that a stored partition has."""


def write_partitions(df: DataFrame, root: str, keys: tuple[str, ...]) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(root)
    )


def write_store(df: DataFrame, root: str, keys: tuple[str, ...] = STORE_KEYS, force: bool = True) -> None:
    """Write detections by (year, month, mday, version), replacing the partitions present.

    Timestamps are kept to the millisecond. Without ``force``, a partition that would
    lose an instrument it has in the store is refused.
    """
    if "acq_timestamp" in df.columns:
        ms = to_ntz(F.date_trunc("MILLISECOND", "acq_timestamp"))
        df = df.withColumn("acq_timestamp", ms)
    if not force and path_exists(df.sparkSession, root):
        _refuse_loss(df, root, keys)
    write_partitions(df, root, keys)


def _refuse_loss(df: DataFrame, root: str, keys: tuple[str, ...]) -> None:
    incoming = df.select(*keys, "instrument").distinct()
    stored = read_store(df.sparkSession, root).select(*keys, "instrument").distinct()
    lost = (
        stored.join(incoming.select(*keys).distinct(), list(keys), "left_semi")
        .join(incoming, [*keys, "instrument"], "left_anti")
        .limit(1)
        .collect()
    )
    if lost:
        raise IncompletePartition(f"would drop {lost[0].asDict()}")


def finished_years(spark: SparkSession, root: str) -> list[int]:
    """Years that ``write_missing_years`` completed."""
    done = f"{root}_years"
    if not path_exists(spark, done):
        return []
    return sorted(r["year"] for r in spark.read.schema("year int").parquet(done).distinct().collect())


def write_missing_years(df: DataFrame, root: str, date: str = "acq_date", open_years: tuple[int, ...] = ()) -> None:
    """Write one partition per year, leaving out years that were finished before.

    Finished years are listed in ``{root}_years`` after their data, so a year that a
    lost job left half written is written again. Rows that come later for a finished
    year are left out; ``open_years`` are not finished by this call and are written again by the next.
    """
    spark = df.sparkSession
    done = finished_years(spark, root)
    pending = F.coalesce(~F.col("year").isin(done), F.lit(True))
    dated = df.withColumn("year", F.year(date)).where(pending)
    before = set(_years_on_disk(spark, root))
    write_partitions(dated, root, ("year",))
    written = set(_years_on_disk(spark, root)) - before
    # Left by a lost job and, if the input still has them, written again just now.
    leftover = sorted(before - set(done))
    if leftover:
        again = dated.where(F.col("year").isin(leftover)).select("year").distinct()
        written |= {r["year"] for r in again.collect()}
    written -= set(open_years)
    if written:
        years = spark.createDataFrame([(y,) for y in sorted(written)], "year int")
        years.write.mode("append").parquet(f"{root}_years")


def _years_on_disk(spark: SparkSession, root: str) -> list[int]:
    return [int(v) for v in partition_values(spark, root, "year") if v.isdigit()]


def write_daily_text(df: DataFrame, root: str, prefix: str, date: str = "acq_date") -> None:
    """Comma-separated text with a header, one directory ``{prefix}YYYYDDD.txt`` per date."""
    name = F.concat(F.lit(prefix), F.date_format(date, "yyyy"), day_of_year(date), F.lit(".txt"))
    (
        df.withColumn("file_key", name)
        .hint("rebalance", "file_key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy("file_key")
        .csv(root)
    )


def series_long(series: DataFrame, keys: tuple[str, ...] = KEYS[1:]) -> DataFrame:
    """Rows of month, source and value text, three sources per month and location."""
    sources = F.array(
        *[
            F.struct(F.lit(i).alias("rank"), F.lit(name).alias("source"), F.col(name.lower()).alias("v"))
            for i, name in enumerate(("Total", "Barystatic", "Steric"))
        ]
    )
    long = series.select(*keys, "time", F.inline(sources))
    return long.orderBy(*keys, "time", "rank").select(
        *keys, F.date_format("time", "MM/yyyy").alias("date"), "source", F.format_string("%f", "v").alias("value")
    )


def write_series_csv(
    series: DataFrame, path: str, keys: tuple[str, ...] = KEYS[1:], value_name: str = "SSH (m)"
) -> None:
    """The long series as text in its order, with a header."""
    long = series_long(series, keys).withColumnRenamed("value", value_name)
    long.write.mode("overwrite").option("header", True).csv(path)
