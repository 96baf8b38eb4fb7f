"""Rasters as tables of bounded tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.positions import axis_index
from gridlake.functions.times import time_label
from gridlake.model import crs_of, variables


def geotransform(df: DataFrame) -> DataFrame:
    """One row: left, x step, top and (negative) y step of the cell edges, width, height.

    The half cell around the outer centres is half the first step of each axis.
    """
    grid = _grid(axis_index(df, "lat"), axis_index(df, "lon"))
    return df.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in grid.items()])


def _grid(lat: DataFrame, lon: DataFrame) -> dict:
    def edges(axis: DataFrame, dim: str):
        value = F.col(dim).cast("double")
        n, low, high = axis.agg(F.count(dim), F.min(value), F.max(value)).first()
        second = axis.where(value > low).agg(F.min(value)).first()[0]
        if second is None:
            raise ValueError(f"a raster needs two coordinates of {dim}")
        half = (second - low) / 2
        return low - half, high + half, n

    left, right, width = edges(lon, "lon")
    bottom, top, height = edges(lat, "lat")
    return {
        "left": left,
        "x_step": (right - left) / width,
        "top": top,
        "y_step": (bottom - top) / height,
        "width": width,
        "height": height,
    }


def raster_tiles(
    df: DataFrame,
    names: list[str] | None = None,
    tile: int = 256,
    nodata: float = -9999.0,
    prefix: str = "raster",
    unit: str = "D",
    time: str | None = "time",
    crs: str | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One raster per variable and time, cut into tiles of ``tile`` x ``tile`` cells.

    Rows run from the top and columns from the left, missing, NaN and absent cells hold
    ``nodata``. Rasters named in ``existing`` are left out. ``time=None`` exports
    variables without time. Keys of the cube must be unique.
    """
    names = sorted(names or variables(df))
    label = time_label(time, unit) if time else F.lit(None).cast("string")
    long = (
        df.withColumn("label", label)
        .unpivot(["lat", "lon", "label"], names, "var", "value")
        .withColumn("name", F.concat_ws("-", F.lit(prefix), "var", "label"))
    )
    if existing is not None:
        long = long.join(existing.select("name").distinct(), "name", "left_anti")

    rows = axis_index(df, "lat", descending=True, name="row")
    cols = axis_index(df, "lon", name="col")
    row, col = F.col("row"), F.col("col")
    absent = F.lit(nodata).cast("float")
    placed = (
        long.join(rows, "lat")
        .join(cols, "lon")
        .select(
            "var",
            "label",
            "name",
            F.floor(row / tile).cast("int").alias("tile_row"),
            F.floor(col / tile).cast("int").alias("tile_col"),
            ((row % tile) * tile + col % tile).cast("int").alias("pos"),
            F.coalesce(F.nanvl(F.col("value").cast("float"), absent), absent).alias("value"),
        )
    )
    # At most tile * tile cells per group.
    tiles = placed.groupBy("var", "label", "name", "tile_row", "tile_col").agg(
        F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("cells")
    )
    g = _grid(rows, cols)
    transform = F.array(
        F.lit(g["left"]) + F.col("tile_col") * tile * g["x_step"],
        F.lit(g["x_step"]),
        F.lit(0.0),
        F.lit(g["top"]) + F.col("tile_row") * tile * g["y_step"],
        F.lit(0.0),
        F.lit(g["y_step"]),
    )
    return tiles.select(
        "var",
        "label",
        "name",
        "tile_row",
        "tile_col",
        transform.alias("transform"),
        F.lit(float(nodata)).alias("nodata"),
        F.lit(crs or crs_of(df)).alias("crs"),
        _dense(F.col("cells"), tile * tile, nodata).alias("pixels"),
    )


def _dense(cells: Column, size: int, nodata: float) -> Column:
    """Sorted (pos, value) pairs as an array with the gaps filled, in linear time."""
    gap = F.lit(nodata).cast("float")

    def piece(cell: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(cells, i - 1).getField("pos"))
        return F.concat(F.array_repeat(gap, cell["pos"] - before - 1), F.array(cell["value"]))

    tail = F.array_repeat(gap, size - 1 - F.element_at(cells, -1).getField("pos"))
    return F.concat(F.flatten(F.transform(cells, piece)), tail)


def tile_cells(tiles: DataFrame, tile: int) -> DataFrame:
    """Tiles back to (var, label, row, col, value); nodata cells are dropped."""
    pixels = tiles.select("var", "label", "tile_row", "tile_col", "nodata", F.posexplode("pixels").alias("pos", "value"))
    return pixels.where(F.col("value") != F.col("nodata")).select(
        "var",
        "label",
        (F.col("tile_row") * tile + F.floor(F.col("pos") / tile)).alias("row"),
        (F.col("tile_col") * tile + F.col("pos") % tile).alias("col"),
        "value",
    )
