"""Keys, schemas, missing values and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ("time", "lat", "lon")
HORIZONTAL = ("lat", "lon", "northing_m", "easting_m")  # those that a cube has name its cells
COORDINATES = (
    "time",
    "lat",
    "lon",
    "forecast",
    "northing_m",
    "easting_m",
    "row",
    "col",
    "time_chunk",
    "lat_chunk",
    "lon_chunk",
    "path",
)

DETECTION_SCHEMA = T.StructType(
    [
        T.StructField("brightness", T.DoubleType()),
        T.StructField("scan", T.DoubleType()),
        T.StructField("track", T.DoubleType()),
        T.StructField("acq_date", T.DateType()),
        T.StructField("acq_time", T.StringType()),
        T.StructField("satellite", T.StringType()),
        T.StructField("instrument", T.StringType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("bright_t31", T.DoubleType()),
        T.StructField("frp", T.DoubleType()),
        T.StructField("daynight", T.StringType()),
        T.StructField("type", T.DoubleType()),
        T.StructField("geometry", T.BinaryType()),
    ]
)

# The same detections as delivered in text: coordinates instead of a geometry.
DETECTION_CSV = T.StructType(
    [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())]
    + [f for f in DETECTION_SCHEMA.fields if f.name != "geometry"]
)

STORE_KEYS = ("year", "month", "mday", "version")


def variables(df: DataFrame) -> list[str]:
    """Numeric columns that are not coordinates."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in COORDINATES
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing cells as NULL, so that aggregates skip them. Keys are left alone."""
    fractional = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in COORDINATES
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fractional})


def attrs(df: DataFrame, column: str) -> dict:
    return dict(df.schema[column].metadata)


def set_attrs(df: DataFrame, column: str, values: dict) -> DataFrame:
    """Attach attributes such as units to a variable."""
    return df.withMetadata(column, {**attrs(df, column), **values})


def copy_attrs(source: DataFrame, target: DataFrame) -> DataFrame:
    """Give the columns of ``target`` the attributes they have in ``source``."""
    for column in target.columns:
        if column in source.columns and attrs(source, column):
            target = target.withMetadata(column, attrs(source, column))
    return target


def set_crs(df: DataFrame, epsg: int, x: str = "lon", y: str = "lat") -> DataFrame:
    """Record the reference system and which columns are x and y."""
    crs = f"EPSG:{epsg}"
    return df.withMetadata(x, {**attrs(df, x), "axis": "x", "crs": crs}).withMetadata(
        y, {**attrs(df, y), "axis": "y", "crs": crs}
    )


def crs_of(df: DataFrame, default: str = "EPSG:3413") -> str:
    for field in df.schema.fields:
        if "crs" in field.metadata:
            return field.metadata["crs"]
    return default
