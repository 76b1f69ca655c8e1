import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueframe.operators import raster
from tissueframe.plans import runs

LABELS = """
0 8 8 8 8 8 8 8 8 8 8 8
0 0 2 2 2 2 2 2 2 8 8 8
0 0 2 2 5 5 2 2 2 8 8 8
0 0 2 2 5 5 2 2 2 8 8 8
0 0 2 2 2 2 2 2 2 8 8 8
0 0 2 2 2 1 1 1 1 1 8 8
0 0 0 0 0 1 1 1 1 1 3 3
0 0 0 0 0 1 1 1 1 1 3 3
0 0 0 0 0 1 1 1 1 1 3 3
0 0 0 0 0 1 1 1 1 1 3 3
0 0 0 0 0 0 0 0 0 3 3 3
0 0 0 0 0 0 0 0 3 3 3 3
"""


def label_table(spark):
    rows = [[int(v) for v in line.split()] for line in LABELS.strip().splitlines()]
    return spark.createDataFrame(
        [("s", x, y, v) for y, row in enumerate(rows) for x, v in enumerate(row)], "sample string, x int, y int, label int"
    )


def test_boundary_golden(spark):
    found = raster.label_boundaries(label_table(spark)).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in found} == {0: 17, 1: 16, 2: 24, 3: 7, 5: 4, 8: 14}


def test_expand_labels_brute_force(spark):
    rng = np.random.default_rng(3)
    cells = {(int(x), int(y)): int(v) for x, y, v in rng.integers(0, [30, 30, 6], (60, 3)) if v > 0}
    df = spark.createDataFrame([("s", x, y, v) for (x, y), v in cells.items()], "sample string, x int, y int, label int")
    canvas = spark.createDataFrame([("s", 30, 30)], "sample string, width int, height int")
    d = 4
    expected = {}
    for x in range(30):
        for y in range(30):
            if (x, y) in cells:
                continue
            near = [((x - a) ** 2 + (y - b) ** 2, v) for (a, b), v in cells.items() if (x - a) ** 2 + (y - b) ** 2 <= d * d]
            if near:
                expected[(x, y)] = min(near)[1]
    assert {(r.x, r.y): r.label for r in raster.expand_labels(df, d, canvas).collect()} == expected
    shifted = spark.createDataFrame([("s", 5, 7, 10, 12)], "sample string, x0 int, y0 int, width int, height int")
    inside = {k: v for k, v in expected.items() if 5 <= k[0] < 15 and 7 <= k[1] < 19}
    assert {(r.x, r.y): r.label for r in raster.expand_labels(df, d, shifted).collect()} == inside


def test_pixel_mask_limits(spark):
    df = spark.createDataFrame(
        [("s", i, 0, *rgb) for i, rgb in enumerate([(100, 100, 100), (200, 200, 200), (99, 100, 100), (201, 200, 200)])],
        "sample string, x int, y int, r int, g int, b int",
    )
    assert [r.in_tissue for r in raster.pixel_mask(df).orderBy("x").collect()] == [1, 1, 0, 0]


def test_tile_window_off_the_image_is_empty(spark):
    mask = spark.createDataFrame([("s", x, y, 1) for x in range(10) for y in range(10)], "sample string, x int, y int, in_tissue int")
    meta = spark.createDataFrame([("s", 10, 10)], "sample string, width int, height int")
    info = spark.createDataFrame([("s", 100, 100, 40.0)], "sample string, x int, y int, spot_diameter_fullres double")
    g = spark.createDataFrame(
        [("s", "off", 10, 50), ("s", "in", 50, 50), ("s", "past", 95, 95)],
        "sample string, barcode string, pxl_row_in_fullres int, pxl_col_in_fullres int",
    )
    found = {r.barcode: r.in_tissue for r in raster.tile_mask(g, info, mask, meta).collect()}
    assert found == {"off": 0, "in": 1, "past": 1}


def test_roi_golden(spark):
    meta = spark.createDataFrame([("a", 1000, 500), ("b", 10, 20)], "sample string, width int, height int")
    roi = spark.createDataFrame(
        [("a", {"0": (0.33, 0.33), "1": (0.33, 0.33)})], "sample string, roi map<string,struct<location:double,size:double>>"
    )
    found = {r.sample: (r.x0, r.y0, r.w, r.h) for r in raster.roi_pixels(meta, roi).collect()}
    assert found == {"a": (330, 165, 330, 165), "b": (0, 0, 10, 20)}


def test_closing_brute_force():
    rng = np.random.default_rng(5)
    for kernel in (2, 3, 4):
        mask = rng.random((25, 31)) < 0.12
        low, high = -(kernel // 2), kernel - kernel // 2
        def neighbours(m, outside, y, x):
            return [
                m[y + b, x + a] if 0 <= y + b < 25 and 0 <= x + a < 31 else outside
                for a in range(low, high) for b in range(low, high)
            ]
        grown = np.array([[any(neighbours(mask, False, y, x)) for x in range(31)] for y in range(25)])
        reach = np.zeros_like(grown)
        todo = [(y, x) for y in range(25) for x in range(31) if (y in (0, 24) or x in (0, 30)) and not grown[y, x]]
        while todo:
            y, x = todo.pop()
            if 0 <= y < 25 and 0 <= x < 31 and not grown[y, x] and not reach[y, x]:
                reach[y, x] = True
                todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
        filled = ~reach
        expected = np.array([[all(neighbours(filled, True, y, x)) for x in range(31)] for y in range(25)])
        assert (runs._close(mask, kernel) == expected).all()


def test_tissue_mask_draws_disks(spark):
    info = spark.createDataFrame([("s", 100, 100, 20.0)], "sample string, x int, y int, spot_diameter_fullres double")
    g = spark.createDataFrame(
        [("s", "t", 1, 50, 40), ("s", "u", 0, 10, 10)],
        "sample string, barcode string, in_tissue int, pxl_row_in_fullres int, pxl_col_in_fullres int",
    )
    cells = {(r.x, r.y) for r in raster.tissue_mask(g, info, up=0.5, chunk=1000, kernel=1).collect()}
    assert cells == {(x, y) for x in range(100) for y in range(100) if (x - 40) ** 2 + (y - 50) ** 2 < 100}


def test_check_mask_keeps_bright_backgrounds(spark):
    thumb = spark.createDataFrame(
        [(s, x, 0, v, v, v) for s, v in (("dark", 100), ("light", 250)) for x in range(3)],
        "sample string, x int, y int, r int, g int, b int",
    )
    mask = thumb.select("sample", "x", "y", (F.col("x") == 0).cast("int").alias("in_tissue"))
    total = raster.check_mask(thumb, mask).groupBy("sample").agg(F.sum("in_tissue").alias("n")).collect()
    assert {r.sample: r.n for r in total} == {"dark": 3, "light": 1}


def test_check_mask_of_another_size(spark):
    # A mask of 2 x 2 cells over a thumbnail of 6 x 4 pixels: the left half is tissue, the right half dark or light background.
    schema = "sample string, x int, y int, r int, g int, b int"
    thumb = [(s, x, y, *([v if x >= 3 else 10] * 3)) for s, v in (("dark", 150), ("light", 240)) for x in range(6) for y in range(4)]
    mask = [(s, x, y, int(x == 0)) for s in ("dark", "light") for x in range(2) for y in range(2)]
    found = raster.check_mask(spark.createDataFrame(thumb, schema), spark.createDataFrame(mask, "sample string, x int, y int, in_tissue int"))
    assert {(r.sample, r.x, r.y): r.in_tissue for r in found.collect()} == {(s, x, y): int(s == "dark" or x == 0) for s, x, y, _ in mask}


def test_expand_labels_of_any_size(spark):
    big = [3_000_000_000, (1 << 41) + 7, (1 << 59) - 1]
    rows = [("s", 10 * i + 5, 5, v) for i, v in enumerate(big)] + [("s", 26, 5, 4)]
    df = spark.createDataFrame(rows, "sample string, x int, y int, label long")
    canvas = spark.createDataFrame([("s", 30, 10)], "sample string, width int, height int")
    found = raster.expand_labels(df, 3, canvas)
    assert dict(found.dtypes)["label"] == "bigint"
    label = {(r.x, r.y): r.label for r in found.collect()}
    assert label[4, 5] == label[8, 5] == big[0] and label[15, 8] == big[1] and label[22, 5] == big[2] and label[27, 5] == 4
    for wrong in (1 << 59, -1):
        broken = spark.createDataFrame([("s", 5, 5, wrong)], df.schema)
        with pytest.raises(Exception, match="no room"):
            raster.expand_labels(broken, 3, canvas).collect()


def test_a_slide_stays_in_one_task_until_its_mask_is_closed(spark):
    from tissueframe.operators import grid

    slides = spark.createDataFrame([("a", 900, 700), ("b", 800, 900)], "sample string, x int, y int")
    flagged = grid.make_grid(slides, "hex").withColumn("in_tissue", (F.col("array_col") % 3 != 1).cast("int"))
    mask = raster.tissue_mask(flagged, grid.grid_info(slides, "hex"), chunk=90, kernel=4)
    # The tiles are placed once; the old plan shuffled runs for their union and placed them again.
    assert mask._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    assert "Generate explode(sequence(0, 15" not in mask._jdf.queryExecution().optimizedPlan().toString()
    assert {r["sample"] for r in mask.select("sample").distinct().collect()} == {"a", "b"}
