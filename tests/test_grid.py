import pytest
from pyspark.sql import functions as F

from tissueframe.operators import grid

CASES = [
    ((2900, 3060), {}, 48, [(0, 0, 147, 147), (1, 0, 537, 373)], (7, 5, 2881, 2634)),
    ((3000, 1100), dict(grid_type="square", magnification=20, spot_diameter=55), 65, [(0, 0, 62, 62), (1, 0, 288, 62)], (4, 12, 966, 2776)),
    ((29000, 30600), {}, 4953, [(0, 0, 147, 147), (1, 0, 537, 373)], (76, 63, 29836, 28642)),
    ((3000, 3000), dict(grid_type="square", resolution=4, spot_diameter=56, spot_spacing=56), 169, [(0, 0, 112, 112), (1, 0, 336, 112)], (12, 12, 2800, 2800)),
]


@pytest.mark.parametrize("size,args,rows,first,last", CASES)
def test_golden_grids(spark, size, args, rows, first, last):
    slides = spark.createDataFrame([("a", *size)], "sample string, x int, y int")
    found = grid.make_grid(slides, **args).orderBy("grid_ord").collect()
    assert len(found) == rows
    place = [(r.array_row, r.array_col, r.pxl_row_in_fullres, r.pxl_col_in_fullres) for r in found]
    assert place[:2] == first and place[-1] == last
    assert [r.grid_ord for r in found] == list(range(1, rows + 1))
    assert found[0].barcode == "tile-00000001"
    assert place == sorted(place, key=lambda p: (p[1], p[0]))


def test_grid_plan_needs_no_shuffle(spark):
    slides = spark.createDataFrame([("a", 2900, 3060)], "sample string, x int, y int")
    plan = grid.make_grid(slides)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_slide_smaller_than_a_tile_has_no_tiles(spark):
    slides = spark.createDataFrame([("a", 100, 100)], "sample string, x int, y int")
    assert grid.make_grid(slides).count() == 0


def test_unknown_grid_type(spark):
    slides = spark.createDataFrame([("a", 100, 100)], "sample string, x int, y int")
    with pytest.raises(ValueError):
        grid.make_grid(slides, "random")


def test_windows_truncate_and_round_half_even(spark):
    g = spark.createDataFrame([("a", "t", 10, 3)], "sample string, barcode string, pxl_row_in_fullres int, pxl_col_in_fullres int")
    info = spark.createDataFrame([("a", 6.5)], "sample string, spot_diameter_fullres double")
    w = grid.tile_windows(g, info).first()
    assert (w.side, w.x0, w.y0) == (6, 0, 7)
    w = grid.tile_windows(g, info, 1.25).first()
    assert (w.stride, w.out, w.side, w.x0) == (2, 6, 12, -3)
    w = grid.tile_windows(g, info, 1.25, downsample=False).first()
    assert (w.stride, w.out, w.side, w.x0) == (1, 8, 8, -1)


def test_sample_tiles_is_repeatable_and_bounded(spark):
    slides = spark.createDataFrame([("a", 2900, 3060), ("b", 900, 900)], "sample string, x int, y int")
    g = grid.make_grid(slides)
    a = {tuple(r) for r in grid.sample_tiles(g, 10, 1).select("sample", "barcode").collect()}
    b = {tuple(r) for r in grid.sample_tiles(g.repartition(7), 10, 1).select("sample", "barcode").collect()}
    assert a == b
    assert len([s for s, _ in a if s == "a"]) == 10
    assert len([s for s, _ in a if s == "b"]) == g.where(F.col("sample") == "b").count()
