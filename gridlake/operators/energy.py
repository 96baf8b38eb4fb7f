"""Surface temperature and melt from the energy balance of the top layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake import fixed

NEWTON_STEPS = 6


def energy_flux(cube: DataFrame, out: str = "flux", prefix: str = "") -> DataFrame:
    """Net flux into the surface; ``prefix`` is that of the names of the surface fluxes."""
    hflux, eflux, ghtskin = (F.col(prefix + v) for v in ("HFLUX", "EFLUX", "GHTSKIN"))
    return cube.withColumn(out, F.col("SWGNT") + F.col("LWGAB") - hflux - eflux + ghtskin)


def day_before(cube: DataFrame, variable: str, day: str = "_day", out: str = "_halo", cell: tuple[str, ...] = ("lat", "lon")) -> DataFrame:
    """For each cell and day, the last value of the day before it that the cell has in the same year.

    One row for each border between days: the day that needs it, and the value in a struct, as it may be missing.
    """
    value = F.struct(F.col(variable).alias("v"))
    last = cube.groupBy(*cell, day).agg(F.max_by(value, "time").alias(out))
    next_day = F.lead(day).over(Window.partitionBy(*cell, F.year(day)).orderBy(day))
    return last.select(*cell, out, next_day.alias(day)).where(F.col(day).isNotNull())


def previous_value(
    cube: DataFrame, variable: str, out: str, cell: tuple[str, ...] = ("lat", "lon"), unit: str = "DAY"
) -> DataFrame:
    """Value of the previous step of the same cell and year; its own value at the first step.

    A missing previous value stays missing. The lag runs inside each ``unit`` of time,
    and the last value of a unit is carried over through a small per-unit table, so a
    cell with a long history is not sorted in one task.
    """
    unit_start = F.date_trunc(unit, "time").cast("timestamp_ntz")
    parts = cube.withColumn("_unit", unit_start)
    inside = Window.partitionBy(*cell, "_unit").orderBy("time")
    lagged = parts.withColumn("_lag", F.lag(F.struct(F.col(variable).alias("v"))).over(inside))

    across = Window.partitionBy(*cell, F.year("_unit")).orderBy("_unit")
    last = parts.groupBy(*cell, "_unit").agg(F.max_by(variable, "time").alias("v"))
    carried = last.select(*cell, "_unit", F.lag(F.struct("v")).over(across).alias("_carried"))

    before = F.coalesce("_lag", "_carried")
    previous = F.when(before.isNull(), F.col(variable)).otherwise(before.getField("v"))
    return (
        lagged.join(carried, [*cell, "_unit"], "left")
        .withColumn(out, previous)
        .select(*cube.columns, out)
    )


def surface_temperature(
    cube: DataFrame, flux: str = "flux", before: str = "TS_before", out: str = "TScalc"
) -> DataFrame:
    """The positive root T of a T^4 + T = k flux + T before, by Newton's method.

    The left side grows and is convex for T > 0, so the iteration falls to the one
    root from the right-hand side. Chained columns stay in generated code.
    """
    k = fixed.STEP_SECONDS / (fixed.ICE_HEAT_CAPACITY * fixed.LAYER_MASS)
    a = fixed.STEFAN_BOLTZMANN * k
    target = F.col(flux) * F.lit(k) + F.col(before)
    df = cube.withColumn("_c", F.when(target > 0, target)).withColumn("_t", F.col("_c"))
    for _ in range(NEWTON_STEPS):
        t, c = F.col("_t"), F.col("_c")
        cubed = t * t * t
        df = df.withColumn("_t", (cubed * t * (3 * a) + c) / (cubed * (4 * a) + 1))
    return df.withColumn(out, F.col("_t")).drop("_c", "_t")


def melt_rate(cube: DataFrame, flux: str = "flux", temperature: str = "TScalc", out: str = "SMELT") -> DataFrame:
    """Cap the temperature at the melting point; what the flux exceeds there melts ice.

    Where the layer does not reach the melting point, or the temperature is missing,
    the rate is 0. It is in kg m-2 s-1 and negative when the layer started out warmer.
    """
    melts = F.col(temperature) >= fixed.MELTING_POINT
    emitted = fixed.STEFAN_BOLTZMANN * fixed.MELTING_POINT**4
    rate = (F.col(flux) - emitted) / fixed.LATENT_HEAT
    return cube.withColumns(
        {
            out: F.when(melts, rate).otherwise(F.lit(0.0)),
            temperature: F.when(melts, F.lit(fixed.MELTING_POINT)).otherwise(F.col(temperature)),
        }
    ).withMetadata(out, fixed.MELT_ATTRS)
