"""Overview levels of tiled rasters: each level has half the rows and columns of the one below.

A level is made tile by tile: a tile is shrunk to a quarter before anything is shuffled, and at most four
quarters meet in a tile of the next level. Tiles carry the sum and number of the full-resolution cells below each
pixel, so any level equals what full resolution gives directly, and cells without a value never weigh in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import list_names, path_exists

RASTER = ("var", "label", "name", "nodata", "crs")
LEVEL = (
    "var string, label string, name string, nodata double, crs string, tile_row int, tile_col int, "
    "transform array<double>, sums array<double>, counts array<bigint>"
)
METHODS = ("mean", "nearest")


def build_overviews(tiles: DataFrame, root: str, tile: int, method: str = "mean") -> DataFrame:
    """Write all levels of ``tiles`` (of ``raster_tiles``) below ``root`` until a raster fits in one tile; return them.

    A pixel is the mean of the cells below it that have a value (``"mean"``), or the upper left one of them
    (``"nearest"``), whether it has a value or not. ``tile`` must be even. Rasters of one call share a grid. A raster
    that a level already holds, by its name, is left as it is: a run again after a loss, or with more
    rasters, makes only what is missing. Without tiles there are no levels.
    """
    if tile % 2 or tile < 2:
        raise ValueError("overviews need tiles of even size")
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    spark = tiles.sparkSession
    furthest = tiles.agg(F.max(F.greatest("tile_row", "tile_col"))).first()[0] or 0
    below = _counted(tiles)
    for level in range(1, int(furthest).bit_length() + 1):
        path = f"{root}/level={level}"
        done = _written(spark, path)
        new = below if done is None else below.join(done.select("name").distinct(), "name", "left_anti")
        if not new.isEmpty():
            _coarser(new, tile, method).write.parquet(f"{path}/run={uuid.uuid4().hex}")
            done = _written(spark, path)
        below = done
    return read_overviews(spark, root)


def read_overviews(spark: SparkSession, root: str) -> DataFrame:
    """Tiles of all written levels, with ``level`` from 1 on, ``pixels`` like those of ``raster_tiles``, and the
    ``sums`` and ``counts`` of the cells below each pixel."""
    out = spark.createDataFrame([], LEVEL).withColumn("level", F.lit(0))
    for name in list_names(spark, root):
        level = _written(spark, f"{root}/{name}")
        if name.startswith("level=") and level is not None:
            out = out.unionByName(level.withColumn("level", F.lit(int(name.split("=")[1]))))
    return out.withColumn("pixels", F.zip_with("sums", "counts", lambda s, n: _mean(s, n, F.col("nodata")).cast("float")))


def overview_cells(levels: DataFrame, tile: int) -> DataFrame:
    """Tiles of ``read_overviews`` as (level, var, label, row, col, value, n); pixels without a value are dropped."""
    both = F.arrays_zip("sums", "counts")
    cells = levels.select("level", "var", "label", "tile_row", "tile_col", F.posexplode(both).alias("pos", "cell"))
    return cells.where("cell.counts > 0").select(
        "level",
        "var",
        "label",
        (F.col("tile_row") * tile + F.floor(F.col("pos") / tile)).alias("row"),
        (F.col("tile_col") * tile + F.col("pos") % tile).alias("col"),
        (F.col("cell.sums") / F.col("cell.counts")).alias("value"),
        F.col("cell.counts").alias("n"),
    )


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    """What finished runs left of a level; folders of lost ones do not count."""
    runs = [f"{path}/{r}" for r in list_names(spark, path) if path_exists(spark, f"{path}/{r}/_SUCCESS")]
    return spark.read.schema(LEVEL).parquet(*runs) if runs else None


def _mean(total: Column, n: Column, nodata: Column) -> Column:
    return F.when(n > 0, total / n).otherwise(nodata)


def _counted(tiles: DataFrame) -> DataFrame:
    """Full resolution with a sum and a number for each pixel."""
    missing = F.col("nodata").cast("float")
    return tiles.select(
        *RASTER,
        "tile_row",
        "tile_col",
        "transform",
        F.transform("pixels", lambda p: F.when(p == missing, 0.0).otherwise(p.cast("double"))).alias("sums"),
        F.transform("pixels", lambda p: F.when(p == missing, 0).otherwise(1).cast("bigint")).alias("counts"),
    )


def _coarser(tiles: DataFrame, tile: int, method: str) -> DataFrame:
    """The next level of all rasters."""
    half = tile // 2
    corners = F.sequence(F.lit(0), F.lit(half * half - 1))

    def shrunk(name: str) -> Column:
        def pixel(i: Column) -> Column:
            first = (F.floor(i / half) * 2 * tile + i % half * 2).cast("int")
            if method == "nearest":
                return F.get(name, first)
            return sum((F.get(name, first + k) for k in (1, tile, tile + 1)), F.get(name, first))

        return F.transform(corners, pixel)

    quarter = F.col("tile_row") % 2 * 2 + F.col("tile_col") % 2
    small = tiles.select(
        *RASTER,
        F.floor(F.col("tile_row") / 2).cast("int").alias("tile_row"),
        F.floor(F.col("tile_col") / 2).cast("int").alias("tile_col"),
        quarter.alias("quarter"),
        _transform_above(tile).alias("transform"),
        shrunk("sums").alias("sums"),
        shrunk("counts").alias("counts"),
    )
    # At most four rows meet in a group.
    pieces = {f"{c}{q}": F.any_value(F.when(F.col("quarter") == q, F.col(c)), True) for c in ("sums", "counts") for q in range(4)}
    met = small.groupBy(*RASTER, "tile_row", "tile_col").agg(
        F.min("transform").alias("transform"), *[c.alias(name) for name, c in pieces.items()]
    )
    return met.select(
        *RASTER,
        "tile_row",
        "tile_col",
        "transform",
        _joined("sums", tile, F.lit(0.0)).alias("sums"),
        _joined("counts", tile, F.lit(0).cast("bigint")).alias("counts"),
    )


def _transform_above(tile: int) -> Column:
    """The transform of the tile that a tile becomes a quarter of."""
    left, x_step, top, y_step = (F.col("transform")[i] for i in (0, 1, 3, 5))
    return F.array(
        left - F.col("tile_col") % 2 * tile * x_step,
        x_step * 2,
        F.lit(0.0),
        top - F.col("tile_row") % 2 * tile * y_step,
        F.lit(0.0),
        y_step * 2,
    )


def _joined(name: str, tile: int, gap: Column) -> Column:
    """Four quarters as one tile; absent ones hold ``gap``."""
    half = tile // 2

    def pixel(p: Column) -> Column:
        at = (F.floor(p / tile) % half * half + p % half).cast("int")
        left, upper = p % tile < half, p < tile * half
        above = F.when(left, F.get(f"{name}0", at)).otherwise(F.get(f"{name}1", at))
        beneath = F.when(left, F.get(f"{name}2", at)).otherwise(F.get(f"{name}3", at))
        return F.coalesce(F.when(upper, above).otherwise(beneath), gap)

    return F.transform(F.sequence(F.lit(0), F.lit(tile * tile - 1)), pixel)
