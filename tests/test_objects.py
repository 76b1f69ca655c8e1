import numpy as np
from pyspark.sql import functions as F

from tissueframe.operators import objects


def brute_dbscan(points, eps, min_samples):
    """Clusters by breadth-first search over cores in (x, y) order."""
    places = sorted(set(points))
    weight = {p: points.count(p) for p in places}
    near = {p: [q for q in places if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for p in places}
    core = {p for p in places if sum(weight[q] for q in near[p]) >= min_samples}
    label, n = {}, 0
    for p in places:
        if p in core and p not in label:
            todo = [p]
            label[p] = n
            while todo:
                for q in near[todo.pop()]:
                    if q not in label:
                        label[q] = n
                        if q in core:
                            todo.append(q)
            n += 1
    return {p: label.get(p, -1) for p in places}


def test_dbscan_matches_search(spark):
    rng = np.random.default_rng(8)
    for eps, least in ((3, 4), (6, 9)):
        blobs = [rng.normal(c, s, (n, 2)) for c, s, n in (((20, 20), 3, 60), ((45, 30), 4, 80), ((30, 60), 2, 40))]
        pts = [(int(x), int(y)) for x, y in np.concatenate(blobs + [rng.uniform(0, 80, (40, 2))])]
        df = spark.createDataFrame([("s", x, y) for x, y in pts], "sample string, x int, y int")
        found = {(r.x, r.y): r.label for r in objects.dbscan(df, eps, least).collect()}
        assert found == brute_dbscan(pts, eps, least)


def test_box_is_moved_into_the_slide(spark):
    pts = spark.createDataFrame([("s", 0, x, y) for x in range(0, 11) for y in range(40, 51)], "sample string, label int, x int, y int")
    dims = spark.createDataFrame([("s", 20, 60)], "sample string, width int, height int")
    box = objects.object_boxes(pts, dims, widen=(0.5, 0.5)).first()
    assert box.loc0 == 0.0 and abs(box.size0 - 1) < 1e-9
    assert abs(box.loc1 - 35 / 60) < 1e-9 and abs(box.size1 - 20 / 60) < 1e-9
    area = objects.object_area(objects.object_boxes(pts, dims, widen=(0.5, 0.5)), compat=True).first().area
    assert abs(area - 1) < 1e-9


def test_ranks_break_ties_by_order(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("a", 3, 5.0), ("b", 1, 1.0)], "sample string, label int, area double")
    found = {(r.sample, r.label): r["rank"] for r in objects.rank_first(df, ["sample"], "area", ["label"]).collect()}
    assert found == {("a", 2): 1, ("a", 1): 2, ("a", 3): 3, ("b", 1): 1}


def test_sheet_names_have_no_blanks(spark):
    df = spark.createDataFrame([("my slide", 2)], "sample string, label int")
    row = objects.build_samplesheet(df, "/d/", "/r/", 0.25).first()
    assert (row.sample, row.image, row.roifile) == ("my_slide.oid2", "/d/my slide.tif", "/r/my slide.oid2.json")


def test_eps_pairs_count_places_once(spark):
    df = spark.createDataFrame([("s", 0, 0), ("s", 0, 0), ("s", 3, 4), ("s", 9, 9)], "sample string, x int, y int")
    assert objects.eps_pairs(df, 5).count() == 5
    n = {(r.x, r.y): (r.w, r.n) for r in objects.neighbour_counts(df, 5).collect()}
    assert n == {(0, 0): (2, 3), (3, 4): (1, 3), (9, 9): (1, 1)}
    assert objects.drop_noise(df.withColumn("label", F.lit(-1))).count() == 0
