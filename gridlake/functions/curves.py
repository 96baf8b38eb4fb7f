"""A space-filling curve over a box, so that cells close on the curve are close in space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.positions import array_of

BITS = 6
SIDE = 1 << BITS


def hilbert_places(bits: int = BITS) -> list[int]:
    """Place on the Hilbert curve of each square of a grid of ``2**bits`` by ``2**bits``, row by row.

    A curve of one more bit is four copies of the smaller one: the first mirrored along the diagonal, the
    second and third as they are, the last mirrored along the other diagonal.
    """
    side, place = 1, [[0]]
    for _ in range(bits):
        n = side * side
        low = [[place[y][x] for y in range(side)] + [n + place[x][y] for y in range(side)] for x in range(side)]
        last = side - 1
        high = [[3 * n + place[last - y][last - x] for y in range(side)] + [2 * n + place[x][y] for y in range(side)] for x in range(side)]
        side, place = 2 * side, low + high
    return [p for row in place for p in row]


def square(x: Column, y: Column, extent: list[float]) -> Column:
    """Number of the grid square of a point; points beyond ``extent`` (x0, x1, y0, y1) fall into those at its edge."""

    def step(value: Column, low: float, high: float) -> Column:
        share = (value.cast("double") - low) / (high - low) if high > low else F.lit(0.0)
        return F.least(F.greatest(F.coalesce(F.floor(share * SIDE), F.lit(0)), F.lit(0)), F.lit(SIDE - 1)).cast("int")

    x0, x1, y0, y1 = extent
    return step(x, x0, x1) * SIDE + step(y, y0, y1)


def looked_up(table: list[int], index: Column) -> Column:
    """``table[index]`` for a table that fits in the plan."""
    return F.get(array_of(table, T.IntegerType()), index)
