"""Sea level at tide gauges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators.aggregate import decompose, year_change
from gridlake.operators.joins import nearest_pixels, series_at
from gridlake.operators.select import sel
from gridlake.session import stored
from gridlake.sources.raster import raster_tiles


def gauge_pixels(height: DataFrame, gauges: DataFrame, variable: str) -> DataFrame:
    """The nearest pixel of each gauge among those valid in the first month."""
    first = height.agg(F.min("time")).first()[0]
    valid = height.transform(sel, time=first).where(F.col(variable).isNotNull())
    return nearest_pixels(valid, gauges)


def height_change_tiles(height: DataFrame, first: int, second: int, tile: int = 256) -> DataFrame:
    """Raster tiles of the change of sea-surface height between two years."""
    change = year_change(height, first, second, "SSH")
    return raster_tiles(change, tile=tile, time=None, prefix=f"SSH_{second}_minus_{first}", crs="EPSG:4326")


def gauge_components(height: DataFrame, pressure: DataFrame, gauges: DataFrame) -> DataFrame:
    """Monthly total, barystatic and steric sea level at each gauge."""
    keys = ("gauge", "time")
    pixels = gauge_pixels(height, gauges, "SSH").select("gauge", "pixel_lat", "pixel_lon")
    pixels = stored(pixels, "pixels")
    total = series_at(height, pixels).select(*keys, F.col("SSH").alias("total"))
    barystatic = series_at(pressure, pixels).select(*keys, F.col("OBP").alias("barystatic"))
    return decompose(total, barystatic, keys)
