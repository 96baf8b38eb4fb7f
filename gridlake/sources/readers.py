"""Readers of point tables and cubes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.model import DETECTION_CSV, KEYS, nan_to_null
from gridlake.operators.select import bbox as within


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, malformed: str | None = None
) -> DataFrame:
    """Text with a header. A header that does not fit the schema is an error.

    Values that cannot be read become missing; ``malformed`` names a column for the whole text of such
    lines, which is missing where the line is in order.
    """
    reader = spark.read.options(header=True, enforceSchema=False)
    if malformed is not None:
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", malformed)
    return reader.schema(schema).csv(paths)


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, line``: the first line of every file that has one."""
    lines = spark.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
    # Numbers grow along a file, so the least one of its first block is that of its first line.
    numbered = lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("n"))
    return numbered.groupBy("path").agg(F.min_by("value", "n").alias("line"))


def read_detections(
    spark: SparkSession, root: str, kind: str, schema: T.StructType = DETECTION_CSV
) -> DataFrame:
    """Detection files whose name carries ``_archive_`` or ``_nrt_``.

    Near-real-time files have no ``type``; it is added as missing.
    """
    if kind == "nrt":
        schema = T.StructType([f for f in schema.fields if f.name != "type"])
    df = read_csv(spark, f"{root}/*_{kind}_*", schema)
    return df if "type" in df.columns else df.withColumn("type", F.lit(None).cast("double"))


def read_instrument(
    spark: SparkSession,
    paths: str | list[str],
    instrument: str,
    schema: T.StructType = DETECTION_CSV,
    malformed: str | None = None,
) -> DataFrame:
    """Daily files of one instrument, tagged with its name."""
    schema = T.StructType([f for f in schema.fields if f.name != "instrument"])
    return read_csv(spark, paths, schema, malformed).withColumn("instrument", F.lit(instrument))


def read_cube(
    spark: SparkSession,
    paths: str | list[str],
    bbox: str | tuple[float, float, float, float] | None = None,
    variables: list[str] | None = None,
    keys: tuple[str, ...] = KEYS,
    schema: T.StructType | None = None,
    preprocess: Callable[[DataFrame], DataFrame] | None = None,
    with_path: bool = False,
) -> DataFrame:
    """Many files as one cube. Box and variables reach the scan; NaN becomes NULL.

    ``preprocess`` is a DataFrame function applied to what was read, and ``with_path``
    keeps the file each row came from.
    """
    paths = [paths] if isinstance(paths, str) else paths
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(*paths)
    if with_path:
        df = df.withColumn("path", F.col("_metadata.file_path"))
    if preprocess is not None:
        df = df.transform(preprocess)
    if bbox is not None:
        df = within(df, bbox)
    if variables is not None:
        df = df.select(*keys, *variables, *(["path"] if with_path else []))
    return nan_to_null(df)


def read_store(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    month: int | None = None,
    mday: int | None = None,
    version: str | None = None,
    since=None,
    until=None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The partitioned detection store, pruned to any level of its directories.

    ``since`` and ``until`` bound ``acq_date``; the years they span prune directories,
    which a filter on ``acq_date`` alone would not do. With a declared ``schema``, columns
    a file lacks are missing.
    """
    reader = spark.read.option("basePath", root)
    # Without a type, the version "6.1" in a directory name would be read as a number.
    parts = [T.StructField(k, T.IntegerType()) for k in ("year", "month", "mday")]
    parts.append(T.StructField("version", T.StringType()))
    names = {f.name for f in parts}
    fields = [f for f in (schema or reader.parquet(root).schema).fields if f.name not in names]
    df = reader.schema(T.StructType(fields + parts)).parquet(root)
    for name, value in {"year": year, "month": month, "mday": mday}.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    if version is not None:
        df = df.where(F.col("version") == version)
    if since is not None:
        df = df.where((F.col("year") >= since.year) & (F.col("acq_date") >= F.lit(since)))
    if until is not None:
        df = df.where((F.col("year") <= until.year) & (F.col("acq_date") <= F.lit(until)))
    return df
