"""Rasters of every time step."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridlake.functions.geo import wrap_lon
from gridlake.sources.raster import raster_tiles


def monthly_rasters(cube: DataFrame, prefix: str, tile: int = 256, existing: DataFrame | None = None) -> DataFrame:
    """Monthly tiles of a cube whose longitudes run from 0 to 360, cut at the date line."""
    return raster_tiles(
        cube.transform(wrap_lon), tile=tile, prefix=prefix, unit="M", crs="EPSG:4326", existing=existing
    )
