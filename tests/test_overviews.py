"""Overview levels against full resolution, and runs that make only what is missing."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.session import delete_path, list_names, new_scratch
from gridlake.sources.overviews import build_overviews, overview_cells, read_overviews
from gridlake.sources.raster import raster_tiles

ROWS, COLS, TILE = 21, 11, 4


@pytest.fixture(scope="module")
def fields():
    rng = np.random.default_rng(3)
    out = {t: np.where(rng.random((ROWS, COLS)) < 0.3, np.nan, rng.normal(size=(ROWS, COLS)).round(3)) for t in ("01", "02")}
    out["02"][:8, :8] = np.nan  # a whole pixel of level 3 without a value
    return out


@pytest.fixture(scope="module")
def tiles(spark, fields):
    rows = [
        (f"2024-01-{t}", float(ROWS - r), float(c), float(v), 1.0)
        for t, field in fields.items()
        for (r, c), v in np.ndenumerate(field)
    ]
    cube = spark.createDataFrame(rows, "time string, lat double, lon double, TS double, one double")
    cube = cube.withColumn("time", F.col("time").cast("timestamp_ntz"))
    return raster_tiles(cube, tile=TILE, nodata=-1.0, crs="EPSG:4326").cache()


def expected(field: np.ndarray, level: int, method: str) -> dict:
    step, out = 2**level, {}
    for r in range(0, ROWS, step):
        for c in range(0, COLS, step):
            block = field[r : r + step, c : c + step] if method == "mean" else field[r : r + 1, c : c + 1]
            n = int((~np.isnan(block)).sum())
            if n:
                out[r // step, c // step] = (np.nansum(block) / n, n)
    return out


@pytest.mark.parametrize("method", ["mean", "nearest"])
def test_levels_equal_full_resolution(spark, tiles, fields, method):
    levels = build_overviews(tiles, new_scratch(spark, "overviews"), TILE, method)
    got = overview_cells(levels, TILE).where("var = 'TS'").collect()
    assert {r["level"] for r in got} == {1, 2, 3}
    for t, field in fields.items():
        for level in (1, 2, 3):
            found = {(r["row"], r["col"]): (r["value"], r["n"]) for r in got if r["label"] == f"2024-01-{t}" and r["level"] == level}
            want = expected(field.astype(np.float32).astype(float), level, method)
            assert found.keys() == want.keys()
            assert all(found[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert levels.where("level = 3").select("name").distinct().count() == levels.where("level = 3").count() == 4
    for r in levels.where("var = 'TS'").collect():
        assert len(r["pixels"]) == TILE * TILE and r["crs"] == "EPSG:4326"
        assert [p == -1.0 for p in r["pixels"]] == [n == 0 for n in r["counts"]]
        step = 2.0 ** r["level"]
        assert r["transform"] == pytest.approx([-0.5 + r["tile_col"] * TILE * step, step, 0, ROWS + 0.5 - r["tile_row"] * TILE * step, 0, -step])


def test_only_what_is_missing_is_made(spark, tiles):
    root = new_scratch(spark, "overviews")
    first = tiles.where("label = '2024-01-01'")
    build_overviews(first, root, TILE)
    runs = {k: list_names(spark, f"{root}/{k}") for k in list_names(spark, root)}
    assert sorted(runs) == ["level=1", "level=2", "level=3"] and all(len(r) == 1 for r in runs.values())
    build_overviews(first, root, TILE)
    assert runs == {k: list_names(spark, f"{root}/{k}") for k in runs}
    delete_path(spark, f"{root}/level=2/{runs['level=2'][0]}/_SUCCESS")  # as a lost run leaves a level
    build_overviews(first, root, TILE)
    again = {k: list_names(spark, f"{root}/{k}") for k in runs}
    assert [len(again[f"level={k}"]) for k in (1, 2, 3)] == [1, 2, 1]
    grown = build_overviews(tiles, root, TILE)
    fresh = build_overviews(tiles, new_scratch(spark, "overviews"), TILE)
    assert grown.exceptAll(fresh).isEmpty() and fresh.exceptAll(grown).isEmpty()


def test_single_tiles_and_nothing(spark, tiles):
    root = new_scratch(spark, "overviews")
    assert build_overviews(tiles.where("false"), root, TILE).isEmpty()
    assert build_overviews(tiles.where("tile_row = 0 AND tile_col = 0"), root, TILE).isEmpty()
    assert read_overviews(spark, root).isEmpty()
    with pytest.raises(ValueError, match="even"):
        build_overviews(tiles, root, 5)
    with pytest.raises(ValueError, match="method"):
        build_overviews(tiles, root, TILE, "mode")
