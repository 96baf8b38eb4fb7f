"""Soil moisture: two passes a day on the equal-area grid as one cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.geo import ease_coordinates
from gridlake.functions.paths import base_name, date_from_path
from gridlake.functions.times import to_ntz
from gridlake.operators.joins import merge_cubes

SOIL_KEYS = ("time", "northing_m", "easting_m")


def soil_pass(df: DataFrame, suffix: str = "") -> DataFrame:
    """Rows of one pass (``path``, ``row``, ``col``, variables) as a cube.

    The day comes from the file name. ``suffix`` is that of the pass's variables, such
    as ``_pm``; of the known variables those present are kept.
    """
    names = [v + suffix for v in fixed.SOIL_VARIABLES if v + suffix in df.columns]
    day = to_ntz(date_from_path(base_name("path"), fixed.DATE_AFTER_SM_P))
    return df.withColumn("time", day).transform(ease_coordinates).select(*SOIL_KEYS, *[F.col(v) for v in names])


def soil_cube(am: DataFrame, pm: DataFrame) -> DataFrame:
    """Morning and afternoon passes on all their cells."""
    return merge_cubes(soil_pass(am), soil_pass(pm, "_pm"), on=SOIL_KEYS)
