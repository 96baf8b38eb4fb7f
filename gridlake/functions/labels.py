"""Category labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import fixed


def recode(column: Column | str, mapping: dict[str, str]) -> Column:
    """Replace the values that the mapping knows and keep the others."""
    column = F.col(column) if isinstance(column, str) else column
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, column), column)


def instrument_label(df: DataFrame, out: str = "label") -> DataFrame:
    """Labels such as "MODIS Aqua" and "NOAA-20-VIIRS"; other instruments keep their name."""
    satellite = recode("satellite", fixed.SATELLITES)
    instrument = F.col("instrument")
    label = (
        F.when(instrument == "MODIS", F.concat_ws(" ", instrument, satellite))
        .when(instrument == "VIIRS", F.concat_ws("-", satellite, instrument))
        .otherwise(instrument)
    )
    return df.withColumn(out, label)
