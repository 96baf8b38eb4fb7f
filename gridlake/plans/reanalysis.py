"""Daily products from hourly reanalysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.model import KEYS, copy_attrs, set_attrs, variables
from gridlake.operators.aggregate import resample_daily, spatial_mean
from gridlake.functions.times import to_ntz
from gridlake.operators.energy import day_before, energy_flux, melt_rate, previous_value, surface_temperature
from gridlake.operators.joins import attach
from gridlake.operators.select import bbox, wrapped_bbox
from gridlake.sources.readers import read_cube
from gridlake.sources.sinks import finished_years, write_missing_years


def regional_daily_mean(cube: DataFrame, region: str) -> DataFrame:
    """Daily means over a region, cells weighted equally."""
    return cube.transform(wrapped_bbox, region).transform(resample_daily, "mean").transform(spatial_mean)


def hourly_melt(rad: DataFrame, flx: DataFrame) -> DataFrame:
    """Radiation cells with ``TScalc`` and ``SMELT``."""
    needed = flx.select(*KEYS, "HFLUX", "EFLUX", "GHTSKIN")
    melted = (
        attach(rad, needed)
        .transform(energy_flux)
        .transform(previous_value, "TS", "TS_before")
        .transform(surface_temperature)
        .transform(melt_rate)
    )
    return melted.select(*rad.columns, "TScalc", "SMELT")


def daily_melt(rad: DataFrame, int_: DataFrame, flx: DataFrame, slv: DataFrame, region) -> DataFrame:
    """Daily means of four products over a region, with surface temperature and melt.

    The products are stacked with their own variables and dealt by cell and day once. Each day of a cell
    also gets the last temperature of the day before as a row of its own, so the previous value, the
    fluxes of the same hour, the melt and the means all come from the same sorted rows. Means over the
    stack equal four daily means merged on cell and day.
    """
    rad, int_, flx, slv = (product.transform(bbox, region) for product in (rad, int_, flx, slv))
    names = [v for p in (rad, int_, flx, slv) for v in variables(p)]
    names[len(variables(rad)) : len(variables(rad))] = ["TScalc", "SMELT"]
    day = to_ntz(F.to_date("time"))
    parts = [rad.withColumn("_rad", F.lit(True)), int_, flx, slv]
    stacked = [p.withColumn("_day", day) for p in parts] + [day_before(rad.withColumn("_day", day), "TS")]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)

    # The row of the day before has no time and comes first.
    earlier = Window.partitionBy("lat", "lon", "_day").orderBy("time").rowsBetween(Window.unboundedPreceding, -1)
    known = F.coalesce("_halo", F.when(F.col("_rad"), F.struct(F.col("TS").alias("v"))))
    before = F.last(known, ignorenulls=True).over(earlier)
    hour = Window.partitionBy("lat", "lon", "_day", "time")
    melted = (
        rows.withColumn("_before", before)
        .withColumns({f"_{v}": F.max(v).over(hour) for v in ("HFLUX", "EFLUX", "GHTSKIN")})
        .where(F.col("_halo").isNull())
        .withColumn("TS_before", F.when(F.col("_before").isNull(), F.col("TS")).otherwise(F.col("_before.v")))
        .transform(energy_flux, prefix="_")
        .transform(surface_temperature)
        .transform(melt_rate)
        .withColumns({v: F.when(F.col("_rad"), F.col(v)) for v in ("TScalc", "SMELT")})
    )
    daily = melted.groupBy(F.col("_day").alias("time"), "lat", "lon").agg(*[F.avg(v).alias(v) for v in names])
    for part in (rad, int_, flx, slv):
        daily = copy_attrs(part, daily)
    daily = set_attrs(daily, "SMELT", fixed.MELT_ATTRS)
    return set_attrs(daily, "TScalc", dict(rad.schema["TS"].metadata))


def melt_from_files(
    spark: SparkSession, products: dict[str, str | list[str]], root: str, region: str
) -> None:
    """Daily melt product from the hourly files of the products ``rad``, ``int``, ``flx`` and ``slv``.

    Box and variable lists reach the scans. The result is partitioned by year. Years
    finished by an earlier run are left out before anything is computed; no value depends
    on another year.
    """
    done = finished_years(spark, root)
    lists = {
        "rad": fixed.RADIATION,
        "int": fixed.PRECIPITATION,
        "flx": fixed.FLUXES,
        "slv": fixed.NEAR_SURFACE,
    }
    cubes = [
        read_cube(spark, products[name], bbox=region, variables=list(names)).where(~F.year("time").isin(done))
        for name, names in lists.items()
    ]
    write_missing_years(daily_melt(*cubes, region), root, "time")


def daily_mass(
    smb: DataFrame, temperature: DataFrame, runoff: DataFrame | None = None, step_seconds: int = 3600
) -> DataFrame:
    """Daily mean temperatures with daily sums of hourly mass rates and 3-hourly runoff."""
    daily = resample_daily(temperature, "mean")
    daily = attach(daily, resample_daily(smb, "sum", step_seconds))
    if runoff is not None:
        daily = attach(daily, resample_daily(runoff, "sum", 3 * step_seconds))
    return daily
