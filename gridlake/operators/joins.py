"""Combining cubes, and matching cells to locations."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.positions import broadcast_if_small, spread_out
from gridlake.model import KEYS, copy_attrs
from gridlake.session import stored

FANOUT = 4
MAX_DEPTH = 25
CELLS_PER_LEAF = 64


def merge_cubes(*cubes: DataFrame, on: tuple[str, ...] = KEYS) -> DataFrame:
    """All cells of all cubes with the variables of each; shared variables are an error.

    A union with one aggregation: a single shuffle for any number of cubes, combined
    before it, so that a hot key is no large group.
    """
    names = _refuse_shared(cubes, on)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cubes)
    merged = stacked.groupBy(*on).agg(*[F.max(n).alias(n) for n in names])
    for cube in cubes:
        merged = copy_attrs(cube, merged)
    return merged


def _refuse_shared(cubes, on: tuple[str, ...]) -> list[str]:
    names = [c for cube in cubes for c in cube.columns if c not in on]
    shared = sorted({n for n in names if names.count(n) > 1})
    if shared:
        raise ValueError(f"variables present in more than one cube: {shared}")
    return names


def attach(cube: DataFrame, other: DataFrame, on: tuple[str, ...] = KEYS) -> DataFrame:
    """Add the variables of ``other`` to the cells of ``cube``; shared ones are an error."""
    _refuse_shared([cube, other], on)
    return cube.join(other, list(on), "left")


def combine(a: DataFrame, b: DataFrame, on: tuple[str, ...] = KEYS, **expressions: Column) -> DataFrame:
    """Expressions over the cells both cubes have; their variables need different names."""
    _refuse_shared([a, b], on)
    joined = a.join(b, list(on), "inner")
    return joined.select(*on, *[e.alias(name) for name, e in expressions.items()])


def nearest_pixels(cells: DataFrame, locations: DataFrame, per_leaf: int = CELLS_PER_LEAF) -> DataFrame:
    """Add the nearest cell (``pixel_lat``, ``pixel_lon``, ``distance`` in degrees) to each location.

    ``cells`` holds the valid cells. Of equally near cells the first in row-major order
    is taken. The result is exact without comparing all pairs: boxes are refined level
    by level, and a box is dropped for a location once some other box is sure to hold a
    nearer cell, so only the cells of the few boxes left are compared. A box is refined
    until it holds at most ``per_leaf`` cells; where all cells are that few, there is one.
    """
    cells = stored(cells.select("lat", "lon").distinct(), "cells")
    boxes = _Boxes(cells)
    depth = boxes.depth(per_leaf)
    y, x = F.col("_y"), F.col("_x")

    points = locations.select(F.col("lat").alias("_y"), F.col("lon").alias("_x"))
    found = spread_out(points, "_y", "_x").distinct()
    found = found.withColumns({"_within": F.lit(float("inf")), "r": _long(0), "c": _long(0)})
    for level in range(1, depth + 1):
        found = _drop_far_boxes(_visit(found, boxes.children(level), "boxes", root=level == 1))

    # At most per_leaf cells in an array.
    leaves = cells.groupBy(*boxes.place(depth)).agg(F.collect_list(F.struct("lat", "lon")).alias("cells"))

    def measured(cell: Column) -> Column:
        dy, dx = cell["lat"] - y, cell["lon"] - x
        return F.struct(F.sqrt(dx * dx + dy * dy).alias("distance"), cell["lat"].alias("lat"), cell["lon"].alias("lon"))

    nearest = (
        _visit(found, leaves, "cells", root=depth == 0)
        .select("_y", "_x", F.array_min(F.transform("cells", measured)).alias("best"))
        .groupBy("_y", "_x")
        .agg(F.min("best").alias("best"))
        .select(
            y.alias("lat"),
            x.alias("lon"),
            F.col("best.lat").alias("pixel_lat"),
            F.col("best.lon").alias("pixel_lon"),
            F.col("best.distance").alias("distance"),
        )
    )
    return locations.join(nearest, ["lat", "lon"], "left")


def _visit(found: DataFrame, groups: DataFrame, name: str, root: bool) -> DataFrame:
    """Give each location the members of the boxes it visits.

    All locations visit the root, so its few members are a constant instead of a join.
    """
    if not root:
        return found.join(groups, ["r", "c"])
    members = groups.select(F.to_json(name)).first()
    text = F.lit(members[0] if members else None).cast("string")
    return found.withColumn(name, F.from_json(text, groups.schema[name].dataType)).where(F.col(name).isNotNull())


class _Boxes:
    """Nested boxes over the cells: each level cuts a box into FANOUT x FANOUT."""

    def __init__(self, cells: DataFrame):
        self.cells = cells
        self.bounds = cells.agg(
            F.count("*").alias("n"),
            *[f(c).alias(f"{c}_{f.__name__}") for c in ("lat", "lon") for f in (F.min, F.max)],
        ).first()

    def place(self, level: int) -> list[Column]:
        """Row and column of the box a cell is in."""

        def along(dim: str) -> Column:
            low, high = self.bounds[f"{dim}_min"], self.bounds[f"{dim}_max"]
            if level == 0 or low is None or low == high:
                return _long(0)
            count = FANOUT**level
            step = F.floor((F.col(dim) - low) / F.lit(high - low) * count).cast("long")
            return F.least(step, _long(count - 1))

        return [along("lat").alias("r"), along("lon").alias("c")]

    def depth(self, per_leaf: int) -> int:
        """Levels needed until no box holds more than ``per_leaf`` cells."""
        n = self.bounds["n"]
        if n <= per_leaf:
            return 0
        level = max(1, math.ceil(math.log(n / per_leaf, FANOUT**2)))
        while level < MAX_DEPTH:
            fullest = self.cells.groupBy(*self.place(level)).count().agg(F.max("count")).first()[0]
            if fullest <= per_leaf:
                break
            level += 1
        return level

    def children(self, level: int) -> DataFrame:
        """The boxes of a level, with their true bounds, in an array for each parent."""
        boxes = self.cells.groupBy(*self.place(level)).agg(
            *[F.min(d).alias(f"{d}0") for d in ("lat", "lon")], *[F.max(d).alias(f"{d}1") for d in ("lat", "lon")]
        )
        parent = [F.floor(F.col(i) / FANOUT).alias(i) for i in ("r", "c")]
        box = F.struct("r", "c", "lat0", "lat1", "lon0", "lon1")
        # At most FANOUT * FANOUT boxes in an array.
        return boxes.groupBy(*parent).agg(F.collect_list(box).alias("boxes"))


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _drop_far_boxes(found: DataFrame) -> DataFrame:
    """Keep the boxes that may hold the nearest cell of a location."""
    y, x = F.col("_y"), F.col("_x")

    def nearest(b: Column) -> Column:
        dy = F.greatest(b["lat0"] - y, y - b["lat1"], F.lit(0.0))
        dx = F.greatest(b["lon0"] - x, x - b["lon1"], F.lit(0.0))
        return F.sqrt(dx * dx + dy * dy)

    def farthest(b: Column) -> Column:
        dy = F.greatest(F.abs(y - b["lat0"]), F.abs(y - b["lat1"]))
        dx = F.greatest(F.abs(x - b["lon0"]), F.abs(x - b["lon1"]))
        return F.sqrt(dx * dx + dy * dy)

    bound = F.least("_within", F.array_min(F.transform("boxes", farthest)))
    # The slack covers rounding in the distances to box edges.
    near = F.filter("boxes", lambda b: nearest(b) <= F.col("_within") * (1 + 1e-9) + 1e-9)
    return (
        found.withColumn("_within", bound)
        .select("_y", "_x", "_within", F.explode(near).alias("b"))
        .select("_y", "_x", "_within", "b.r", "b.c")
    )


def series_at(cube: DataFrame, pixels: DataFrame) -> DataFrame:
    """The series of the cube at matched pixels, one for each location.

    ``pixels`` comes from ``nearest_pixels``; the cube is read once, within their bounds.
    """
    pixels = broadcast_if_small(pixels)
    names = {"lat": "pixel_lat", "lon": "pixel_lon"}
    b = pixels.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in names.values() for f in (F.min, F.max)]).first()
    for dim, pixel in names.items():
        cube = cube.where(F.col(dim).between(b[f"{pixel}_min"], b[f"{pixel}_max"]))
    return cube.withColumnsRenamed(names).join(pixels, list(names.values()))
