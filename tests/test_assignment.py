import numpy as np
import pytest

from tissueframe.operators import assignment, spots
from tissueframe.plans.quantile import exact_quantiles
from tissueframe.plans.ranking import consecutive
from tissueframe.plans.components import connected_components
from pyspark.sql import functions as F


@pytest.mark.parametrize("shape", ["square", "circle"])
@pytest.mark.parametrize("factor", [1, 3])
def test_brute_force_with_a_crowded_sample(spark, shape, factor):
    rng = np.random.default_rng(11)
    sides = {"a": 20.0, "b": 31.0}
    # Repeated centres and centres closer than the diameter make ties.
    spots_of = {s: [tuple(map(int, p)) for p in rng.integers(0, 200, (40, 2))] for s in sides}
    spots_of["a"][7] = spots_of["a"][3]
    nuclei_of = {"a": rng.integers(-20, 220, (600, 2)).tolist(), "b": rng.integers(0, 200, (60, 2)).tolist()}
    grid = spark.createDataFrame(
        [(s, f"t{i}", x, y, i) for s in sides for i, (x, y) in enumerate(spots_of[s])],
        "sample string, barcode string, pxl_col_in_fullres int, pxl_row_in_fullres int, grid_ord int",
    )
    info = spark.createDataFrame(list(sides.items()), "sample string, spot_diameter_fullres double")
    nuclei = spark.createDataFrame(
        [(s, str(i), x, y) for s in sides for i, (x, y) in enumerate(nuclei_of[s])],
        "sample string, ids string, centroid_x int, centroid_y int",
    )
    fn = assignment.assign_square if shape == "square" else assignment.assign_circle
    found = {(r.sample, r.ids): r.barcode for r in fn(nuclei, grid, info, factor).collect()}
    for s, side in sides.items():
        half = side * factor / 2
        for i, (x, y) in enumerate(nuclei_of[s]):
            near = []
            for k, (px, py) in enumerate(spots_of[s]):
                d2 = (px - x) ** 2 + (py - y) ** 2
                inside = max(abs(px - x), abs(py - y)) <= half if shape == "square" else d2**0.5 <= half
                if inside:
                    near.append((d2, k))
            assert found[(s, str(i))] == (f"t{min(near)[1]}" if near else None)


def test_deviation_of_one_nucleus_is_null(spark):
    cells = spark.createDataFrame(
        [("s", "t", "neoplasia", 2.0), ("s", "t", "necrosis", 4.0), ("s", None, "necrosis", 9.0)],
        "sample string, barcode string, cell_type string, area double",
    )
    row = spots.spot_class_stds(cells, ["area"]).first()
    assert row.std_area_neoplasia is None
    stats = spots.spot_stats(cells, ["area"]).first()
    assert stats.average_area == 3 and abs(stats.std_area - 2**0.5) < 1e-12
    counts = spots.spot_counts(cells).collect()
    assert len(counts) == 1 and counts[0].count_necrosis == 1 and counts[0].count_no_label == 0


def test_quantiles_through_the_bracket_are_exact(spark):
    rng = np.random.default_rng(2)
    groups = {"hot": np.concatenate([np.repeat(1.5, 3000), rng.normal(size=4000)]), "small": rng.normal(size=3), "one": np.array([7.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None)], "g string, v double")
    probs = {"q01": 0.01, "q50": 0.5, "q99": 0.99, "q00": 0.0, "q100": 1.0}
    # A small sketch sends the large group through the bracket step.
    found = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, sketch=200).collect()}
    assert set(found) == set(groups)
    for g, vs in groups.items():
        for name, p in probs.items():
            assert abs(found[g][name] - np.quantile(vs, p)) < 1e-9


def test_numbers_of_a_group_spanning_partitions(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"), ((F.col("id") * 7919) % 5000).alias("v"))
    found = consecutive(df, ["g"], [F.col("v").desc()], "n", parts=8).collect()
    for g in ("hot", "cold"):
        rows = sorted((r.n, -r.v) for r in found if r.g == g)
        assert [n for n, _ in rows] == list(range(1, len(rows) + 1))
        assert [v for _, v in rows] == sorted(v for _, v in rows)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame(chain + star, "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(0, 61), *range(100, 140), 500]], "id long")
    found = {r.id: r.component for r in connected_components(nodes, edges).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 500: 500}
