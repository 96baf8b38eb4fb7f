"""Means, sums, changes, trends, counts and summaries. Missing cells are skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake import fixed
from gridlake.functions.positions import ordered_position, spread_out
from gridlake.functions.times import to_ntz
from gridlake.model import COORDINATES, KEYS, copy_attrs, variables
from gridlake.operators.joins import combine


def resample_daily(
    cube: DataFrame,
    how: str = "mean",
    factor: float = 1.0,
    names: list[str] | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """Daily mean, or daily sum times ``factor``, of every variable.

    A mean over no value is missing and a sum over no value is 0. ``factor`` is the
    seconds of a step where rates per second are summed. With ``fill_gaps``, every cell
    has every day between the first and the last of the cube: days without rows are
    missing, or 0 for a sum.
    """
    names = names or variables(cube)
    if how == "mean":
        daily = {v: F.avg(v) for v in names}
    elif how == "sum":
        daily = {v: F.coalesce(F.sum(v), F.lit(0.0)) * F.lit(float(factor)) for v in names}
    else:
        raise ValueError(f"unknown resampling {how!r}")
    day = to_ntz(F.to_date("time")).alias("time")
    keys = [k for k in cube.columns if k in COORDINATES[1:6]]
    out = cube.groupBy(day, *keys).agg(*[e.alias(v) for v, e in daily.items()])
    out = copy_attrs(cube, out)
    if not fill_gaps:
        return out
    filled = _fill_days(cube, out, keys)
    return filled.fillna(0.0, names) if how == "sum" else filled


def _fill_days(cube: DataFrame, daily: DataFrame, keys: list[str]) -> DataFrame:
    first, last = cube.agg(F.to_date(F.min("time")), F.to_date(F.max("time"))).first()
    if first is None:
        return daily
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    cells = spread_out(cube.select(*keys).distinct(), *keys)
    spine = cells.select(*keys, F.explode(days).alias("time")).withColumn("time", to_ntz(F.col("time")))
    return spine.join(daily, ["time", *keys], "left").select(*daily.columns)


def spatial_mean(cube: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Unweighted mean over all cells at each time."""
    return cube.groupBy("time").agg(*[F.avg(v).alias(v) for v in names or variables(cube)])


def annual_mean(cube: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Mean over all cells and times of each year."""
    return cube.groupBy(F.year("time").alias("year")).agg(
        *[F.avg(v).alias(v) for v in names or variables(cube)]
    )


def mean_over(cube: DataFrame, dims: list[str], names: list[str] | None = None) -> DataFrame:
    """Mean over the given dimensions."""
    rest = [k for k in (*KEYS, "forecast") if k in cube.columns and k not in dims]
    return cube.groupBy(*rest).agg(*[F.avg(v).alias(v) for v in names or variables(cube)])


def year_mean(cube: DataFrame, year: int, variable: str, path: str | None = None) -> DataFrame:
    """Sum of the twelve monthly fields over 12; missing unless all twelve are there.

    Where a month has several files, ``path`` names the column that tells them apart
    and the first one counts.
    """
    months = cube.where(_in_year(year))
    if path:
        months = months.groupBy("lat", "lon", F.month("time").alias("month")).agg(
            F.min_by(variable, path).alias(variable)
        )
    return months.groupBy("lat", "lon").agg(_twelve_months(F.col(variable)).alias(variable))


def year_change(cube: DataFrame, first: int, second: int, variable: str) -> DataFrame:
    """Second year's mean minus the first year's, in one pass over both."""
    means = {y: _twelve_months(F.when(_in_year(y), F.col(variable))) for y in (first, second)}
    return (
        cube.where(_in_year(first) | _in_year(second))
        .groupBy("lat", "lon")
        .agg(means[first].alias("_first"), means[second].alias("_second"))
        .select("lat", "lon", (F.col("_second") - F.col("_first")).alias("change"))
    )


def _in_year(year: int) -> Column:
    """A range on the time itself, which the scan can use; ``year(time)`` it could not."""
    start, end = (F.lit(f"{y:04d}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return (F.col("time") >= start) & (F.col("time") < end)


def _twelve_months(value: Column) -> Column:
    return F.when(F.count(value) == 12, F.sum(value) / 12)


def yearly_mean(series: DataFrame, keys: list[str], variable: str, months: int = 12) -> DataFrame:
    """Yearly mean of a monthly series over its first ``months`` months."""
    value = F.when(F.month("time") <= months, F.col(variable))
    return series.groupBy(*keys, F.year("time").alias("year")).agg(F.avg(value).alias(variable))


def linear_trend(
    series: DataFrame, keys: list[str], variable: str, index: str = "month_index", expected: int | None = None
) -> DataFrame:
    """Least-squares line of each series against its month index.

    ``mm_per_year`` is the slope of monthly metres. The fit is missing where a value is,
    or where fewer than ``expected`` months exist.
    """
    complete = F.count(variable) == F.count("*")
    if expected is not None:
        complete = complete & (F.count(variable) == expected)
    return (
        series.groupBy(*keys)
        .agg(
            F.when(complete, F.regr_slope(variable, index)).alias("slope"),
            F.when(complete, F.regr_intercept(variable, index)).alias("intercept"),
        )
        .withColumn("mm_per_year", F.col("slope") * 1000 * 12)
    )


def trend_line(
    series: DataFrame, keys: list[str], variable: str, index: str = "month_index", expected: int | None = None
) -> DataFrame:
    """The series with its fitted line. The fit is aggregated and joined back."""
    fit = linear_trend(series, keys, variable, index, expected).drop("mm_per_year")
    fitted = F.col("intercept") + F.col("slope") * F.col(index)
    return series.join(fit, keys).withColumn("trend", fitted).drop("slope", "intercept")


def decompose(total: DataFrame, barystatic: DataFrame, on: tuple[str, ...] = KEYS) -> DataFrame:
    """Total, barystatic and steric (total minus barystatic) components."""
    return combine(
        total,
        barystatic,
        on,
        total=F.col("total"),
        barystatic=F.col("barystatic"),
        steric=F.col("total") - F.col("barystatic"),
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def count_of_counts(df: DataFrame, *keys: str) -> DataFrame:
    """How many keys occur how often."""
    return count_by(df, *keys).groupBy("n").agg(F.count("*").alias("nn"))


def groups_with_count(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return count_by(df, *keys).where(F.col("n") == n).select(*keys)


def latest(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("latest"), F.min(column).alias("earliest"))


def extent(cube: DataFrame) -> DataFrame:
    """Bounds in space and time, as text."""

    def clock(value: Column) -> Column:
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")

    return cube.agg(
        F.min("lat").cast("string").alias("southernmost"),
        F.max("lat").cast("string").alias("northernmost"),
        F.min("lon").cast("string").alias("westernmost"),
        F.max("lon").cast("string").alias("easternmost"),
        clock(F.min("time")).alias("range_beginning"),
        clock(F.max("time")).alias("range_ending"),
    )


def dataset_attributes(cube: DataFrame, **more: str) -> DataFrame:
    """One row with the attributes of a cube as a map: its extent and what is given."""
    bounds = extent(cube)
    pairs = [(name, F.col(column)) for name, column in zip(fixed.EXTENT_ATTRS, bounds.columns)]
    pairs += [(name, F.lit(value)) for name, value in more.items()]
    return bounds.select(F.create_map(*[c for name, value in pairs for c in (F.lit(name), value)]).alias("attrs"))


def size_summary(manifest: DataFrame, column: str = "length") -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of file sizes in MB.

    Quartiles interpolate between neighbours. Equal sizes are counted first, and the
    two neighbours of a quartile are found by position, so no task sees all sizes.
    """
    mb = F.col(column) / 1e6
    sizes = manifest.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    placed = ordered_position(sizes, [column], name="_first", weight="_n")
    n = F.sum("_n")
    total = sizes.agg(
        n.alias("count"),
        (F.sum(mb * F.col("_n")) / n).alias("mean"),
        F.min(mb).alias("min"),
        F.max(mb).alias("max"),
    ).first()
    names = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    count = total["count"] or 0

    def at(place: int) -> Column:
        here = (F.col("_first") <= place) & (F.col("_first") + F.col("_n") > place)
        return F.max(F.when(here, mb))

    def quartile(share: float) -> Column:
        place = share * max(count - 1, 0)
        low = int(place)
        return at(low) + (at(min(low + 1, max(count - 1, 0))) - at(low)) * (place - low)

    off = mb - F.lit(total["mean"])
    spread = F.sqrt(F.sum(off * off * F.col("_n")) / F.nullif(F.lit(count - 1), F.lit(0)))
    return placed.agg(
        F.lit(count).cast("long").alias("count"),
        F.lit(total["mean"]).alias("mean"),
        spread.alias("std"),
        F.lit(total["min"]).alias("min"),
        *[quartile(share).alias(name) for name, share in names.items()],
        F.lit(total["max"]).alias("max"),
    )


def valid_count(cube: DataFrame, variable: str) -> DataFrame:
    return cube.agg(F.count(variable).alias("n"))


def chunk_plan(manifest: DataFrame, per_chunk: int, path: str = "path") -> DataFrame:
    """Files in path order cut into chunks: number of files, first and last of each.

    Copies of a path are counted first and dealt to chunks by arithmetic.
    """
    counted = manifest.groupBy(path).agg(F.count("*").alias("_n"))
    placed = ordered_position(counted, [path], name="_first", weight="_n")
    end = F.col("_first") + F.col("_n")
    chunks = F.sequence(F.floor(F.col("_first") / per_chunk), F.floor((end - 1) / per_chunk))
    dealt = placed.withColumn("chunk", F.explode(chunks))
    here = F.least(end, (F.col("chunk") + 1) * per_chunk) - F.greatest(F.col("_first"), F.col("chunk") * per_chunk)
    return dealt.groupBy("chunk").agg(
        F.sum(here).alias("n_files"), F.min(path).alias("first_path"), F.max(path).alias("last_path")
    )
