import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueframe.functions import contour as C
from tissueframe.operators import nuclei
from tissueframe.sources import tables

TEXT = (
    '{"mag":40,"nuc":{"1":{"centroid":[3.7,4.2],"contour":[[0,0],[4,0],[4,2],[0,2]],"type_prob":0.9,"type":1},'
    '"2":{"centroid":[1,1],"contour":[[0,0]],"type_prob":0.5,"type":0}}}'
)


def test_nuclei_json_golden(spark, tmp_path):
    folder = tmp_path / "sample=s1"
    folder.mkdir()
    (folder / "n.json").write_text(TEXT)
    rows = {r.ids: r for r in nuclei.measure_nuclei(tables.read_nuclei(spark, str(tmp_path))).collect()}
    one, two = rows["1"], rows["2"]
    assert (one.sample, one.centroid_x, one.centroid_y, one.cell_type) == ("s1", 3, 4, 1)
    assert (one.perimeter_length, one.area, one.orientation) == (12, 8, 0)
    assert math.isclose(one.eccentricity, 0.8660254, abs_tol=1e-6)
    assert math.isclose(one.circularity, 0.6981317, abs_tol=1e-6)
    assert (two.area, two.perimeter_length) == (0, 0)
    assert two.orientation is None and two.eccentricity is None and two.circularity is None


def contours(spark, *lists):
    return spark.createDataFrame([(i, c) for i, c in enumerate(lists)], "i int, c array<array<int>>")


def test_direction_does_not_matter(spark):
    tri = [[1, 1], [9, 2], [4, 8]]
    rows = contours(spark, tri, tri[::-1]).select(C.contour_moments(F.col("c")).alias("m")).collect()
    for a, b in zip(rows[0].m, rows[1].m):
        assert math.isclose(a, b, rel_tol=1e-12)
    assert rows[0].m.m00 > 0


def test_close_and_minimize(spark):
    square = [[0, 0], [3, 0], [3, 3], [0, 3]]
    row = contours(spark, square).select(
        C.close_contour(F.col("c")).alias("dense"), C.minimize_contour(C.close_contour(F.col("c"))).alias("thin")
    ).first()
    assert row.dense[:3] == [[1, 0], [2, 0], [3, 0]]
    assert row.dense[-4:] == [[0, 3], [0, 2], [0, 1], [0, 0]]
    assert len(row.thin) < len(row.dense)
    assert [2, 0] not in row.thin


def test_filled_cells_include_the_border(spark):
    df = spark.createDataFrame(
        [("s", "9", [[0, 0], [4, 0], [4, 2], [0, 2]]), ("s", "10", [[4, 2], [6, 2], [6, 4], [4, 4]]), ("s", "3", [[20, 20]])],
        "sample string, ids string, contour array<array<int>>",
    )
    cells = {(r.x, r.y): r.label for r in nuclei.rasterize_nuclei(df).collect()}
    assert len(cells) == 15 + 9 - 1 + 1
    # "9" is after "10" in string order, so it keeps the shared corner.
    assert cells[(4, 2)] == 10 and cells[(6, 4)] == 11 and cells[(20, 20)] == 4


def test_spans_hold_the_cells_that_are_covered(spark):
    rng = np.random.default_rng(8)
    shapes = [rng.integers(0, 14, (n, 2)).tolist() for n in (1, 2, 3, 4, 5, 7, 9, 12, 20) for _ in range(4)]
    shapes += [[[-3, -2], [5, -2], [5, 6], [-3, 6]], [[0, 0], [9, 0], [9, 0], [0, 0]], [[2, 1], [2, 8]]]
    df = spark.createDataFrame([(f"s{i}", "7", c) for i, c in enumerate(shapes)], "sample string, ids string, contour array<array<int>>")
    around = spark.range(-5, 16).select(F.col("id").cast("int").alias("x"))
    box = df.withColumn("e", C.edges_of(F.col("contour"))).join(around).join(around.withColumnRenamed("x", "y"))
    box = box.where(C.covered(F.col("e"), F.col("x"), F.col("y")))
    want = {(r.sample, r.x, r.y) for r in box.collect()}
    rows = nuclei.rasterize_nuclei(df).collect()
    assert {(r.sample, r.x, r.y) for r in rows} == want and len(rows) == len(want)


def test_id_order_is_the_order_of_texts(spark):
    ids = ["0", "00", "7", "07", "10", "1", "100", "99", "9", "12345678901234567", "12345678901234568", "2147483648"]
    df = spark.createDataFrame([(i,) for i in ids], "ids string").withColumn("o", nuclei.id_order(F.col("ids")))
    rows = df.withColumn("back", nuclei.id_of_order(F.col("o"))).collect()
    assert [r.ids for r in sorted(rows, key=lambda r: r.o)] == sorted(ids)
    assert all(r.back == int(r.ids) for r in rows)
    with pytest.raises(Exception, match="not an id"):
        spark.createDataFrame([("a1",)], "ids string").select(nuclei.id_order(F.col("ids"))).collect()
