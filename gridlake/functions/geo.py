"""Coordinates and point geometries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import fixed


def wrap_lon(df: DataFrame, lon: str = "lon") -> DataFrame:
    """Longitudes 0..360 as -180..180; 180 itself stays."""
    return df.withColumn(lon, F.when(F.col(lon) > 180, F.col(lon) - 360).otherwise(F.col(lon)))


def ease_coordinates(df: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """Cell centres of the equal-area grid; rows run down from the top."""
    half = 0.5 * fixed.EASE_CELL
    return df.withColumns(
        {
            "easting_m": F.lit(fixed.EASE_LEFT + half) + F.col(col) * F.lit(fixed.EASE_CELL),
            "northing_m": F.lit(fixed.EASE_TOP - half) - F.col(row) * F.lit(fixed.EASE_CELL),
        }
    )


def latlon_from_attrs(
    df: DataFrame,
    attrs: dict,
    sizes: tuple[int, int],
    row: str = "north_south",
    col: str = "east_west",
) -> DataFrame:
    """Latitude and longitude from the grid description of a dataset.

    ``attrs`` holds the south-west corner and the steps, ``sizes`` the number of
    rows and columns. Existing ``lat`` and ``lon`` columns are kept as ``orig_*``.
    """
    df = df.withColumnsRenamed({c: f"orig_{c}" for c in ("lat", "lon") if c in df.columns})

    def axis(index: str, corner: str, step: str, size: int) -> Column:
        start = round(float(attrs[corner]), 3)
        end = start + round(float(attrs[step]), 3) * size
        return (F.col(index) * F.lit((end - start) / size) + F.lit(start)).cast("float")

    return df.withColumns(
        {
            "lat": axis(row, "SOUTH_WEST_CORNER_LAT", "DY", sizes[0]),
            "lon": axis(col, "SOUTH_WEST_CORNER_LON", "DX", sizes[1]),
        }
    )


def point_wkb(lon: Column | str, lat: Column | str) -> Column:
    """Little-endian well-known binary of a point; NULL where a coordinate is missing."""

    @F.pandas_udf("binary")
    def encode(x: pd.Series, y: pd.Series) -> pd.Series:
        points = np.zeros(len(x), dtype=[("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
        points["order"], points["kind"], points["x"], points["y"] = 1, 1, x, y
        encoded = pd.Series(points.view(f"V{points.dtype.itemsize}").tolist(), dtype=object)
        return encoded.where((x.notna() & y.notna()).to_numpy(), None)

    return encode(lon, lat)


def wkb_xy(geometry: Column | str) -> Column:
    """A struct of ``lon`` and ``lat`` from well-known binary points."""

    @F.pandas_udf("lon double, lat double")
    def decode(geometry: pd.Series) -> pd.DataFrame:
        empty = bytes(21)
        raw = b"".join(bytes(g) if g is not None else empty for g in geometry)
        points = np.frombuffer(raw, dtype=[("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
        missing = points["order"] == 0
        return pd.DataFrame(
            {"lon": np.where(missing, np.nan, points["x"]), "lat": np.where(missing, np.nan, points["y"])}
        )

    return decode(geometry)
