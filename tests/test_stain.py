import numpy as np
from pyspark.sql import functions as F

from tissueframe.functions.colour import lasso2
from tissueframe.operators import stain, superpixels


def pixel_table(spark, images):
    return spark.createDataFrame(
        [(s, x, y, *map(int, im[y, x])) for s, im in images.items() for y in range(im.shape[0]) for x in range(im.shape[1])],
        "sample string, x int, y int, r int, g int, b int",
    )


def numpy_stain(im, angle=99):
    od = np.maximum(-np.log(np.maximum(im.reshape(-1, 3), 1) / 255), 1e-6)
    _, v = np.linalg.eigh(np.cov(od, rowvar=False))
    v = v[:, [2, 1]] * np.where(v[0, [2, 1]] < 0, -1, 1)
    t = od @ v
    phi = np.arctan2(t[:, 1], t[:, 0])
    ends = [v @ np.array([np.cos(p), np.sin(p)]) for p in np.percentile(phi, [100 - angle, angle])]
    if ends[0][0] <= ends[1][0]:
        ends = ends[::-1]
    return np.concatenate([e / np.linalg.norm(e) for e in ends])


def stained(rng, n):
    mix = rng.gamma(2.0, 0.4, (n, n, 2))
    rows = np.array([[0.65, 0.70, 0.29], [0.07, 0.99, 0.11]])
    return np.clip(255 * np.exp(-mix @ rows), 0, 255).astype(np.uint8)


def test_stain_rows_match_numpy(spark):
    rng = np.random.default_rng(4)
    images = {"a": stained(rng, 30), "b": stained(rng, 20)}
    found = {r.sample: [r[c] for c in stain.STAIN] for r in stain.stain_matrix(pixel_table(spark, images), ["sample"]).collect()}
    for s, im in images.items():
        assert np.allclose(found[s], numpy_stain(im), atol=1e-6)


def test_one_colour_patch_takes_the_default(spark):
    flat = {"a": np.full((4, 4, 3), 255, dtype=np.uint8), "one": np.full((1, 1, 3), 9, dtype=np.uint8)}
    rows = stain.with_default_stain(stain.stain_matrix(pixel_table(spark, flat), ["sample"])).collect()
    one = {r.sample: r for r in rows}["one"]
    assert abs(one.h_r - 0.58698897) < 1e-12 and abs(one.e_b - 0.73371214) < 1e-12


def test_lasso_beats_a_grid(spark):
    rng = np.random.default_rng(6)
    a, b = (v / np.linalg.norm(v) for v in np.array([[0.65, 0.70, 0.29], [0.07, 0.99, 0.11]]))
    xs = rng.normal(0.4, 0.6, (40, 3))
    df = spark.createDataFrame([tuple(map(float, x)) for x in xs], "o0 double, o1 double, o2 double")
    od = [F.col(f"o{i}") for i in range(3)]
    found = df.select("o0", "o1", "o2", lasso2(od, [F.lit(float(v)) for v in a], [F.lit(float(v)) for v in b]).alias("c")).collect()
    lam = 0.01
    ticks = np.linspace(0, 3, 151)
    for r in found:
        x = np.array([r.o0, r.o1, r.o2])
        def loss(c1, c2):
            rest = x[:, None, None] - a[:, None, None] * c1 - b[:, None, None] * c2
            return 0.5 * (rest**2).sum(axis=0) + lam * (c1 + c2)
        best = loss(*np.meshgrid(ticks, ticks)).min()
        own = loss(np.array([[r.c.c1]]), np.array([[r.c.c2]]))[0, 0]
        assert r.c.c1 >= 0 and r.c.c2 >= 0 and own <= best + 1e-9


def numpy_lasso(od, rows, lam=0.01):
    h, e = rows[:3], rows[3:]
    c = h @ e
    g1, g2 = od @ h - lam, od @ e - lam
    a, b = (g1 - c * g2) / (1 - c * c), (g2 - c * g1) / (1 - c * c)
    only = np.maximum(g1, 0)
    one = g2 - c * only <= 0
    both = (a >= 0) & (b >= 0)
    return np.stack([np.where(both, a, np.where(one, only, 0)), np.where(both, b, np.where(one, 0, np.maximum(g2, 0)))], axis=1)


def test_normalisation_matches_numpy(spark):
    rng = np.random.default_rng(9)
    images = {"a": stained(rng, 24), "ref": stained(rng, 30) // 2 + 60}
    shifted, density, rows, tops = {}, {}, {}, {}
    for s, im in images.items():
        shifted[s] = np.minimum(im.astype(int) + 255 - int(np.quantile(im.ravel(), 0.95)), 255)
        density[s] = np.maximum(-np.log(np.maximum(shifted[s].reshape(-1, 3), 1) / 255), 1e-6)
        rows[s] = numpy_stain(shifted[s])
        tops[s] = np.percentile(numpy_lasso(density[s], rows[s]), 99, axis=0)
    mixed = numpy_lasso(density["a"], rows["a"]) * tops["ref"] / tops["a"]
    want = (255 * np.exp(-mixed @ rows["ref"].reshape(2, 3))).astype(int).reshape(24, 24, 3) % 256
    px = pixel_table(spark, images)
    out = stain.normalise_stain(px.where("sample = 'a'"), px.where("sample = 'ref'"), s=100, low=0, high=255).collect()
    assert len(out) == 576
    assert all(abs(want[r.y, r.x] - np.array([r.r, r.g, r.b])).max() <= 1 for r in out)


def test_superpixels_partition_each_patch(spark):
    rng = np.random.default_rng(1)
    px = pixel_table(spark, {"a": rng.integers(0, 256, (40, 50, 3)).astype(np.uint8)})
    meta = spark.createDataFrame([("a", 50, 40)], "sample string, width int, height int")
    rows = superpixels.superpixels(px, meta, s=32, pixels_per_segment=64, rounds=2).collect()
    assert len({(r.x, r.y) for r in rows}) == len(rows) == 2000
    for r in rows:
        assert r.label // 10000 == (r.y // 32) * 2 + r.x // 32
    assert superpixels.superpixel_patch(F.lit(20007)) is not None


def test_cells_od_needs_ring_and_core(spark):
    im = np.full((12, 12, 3), 180, dtype=np.uint8)
    im[3:6, 3:6] = (120, 80, 160)
    px = pixel_table(spark, {"a": im})
    labels = spark.createDataFrame([("a", x, y, 1) for x in (3, 4, 5) for y in (3, 4, 5)], "sample string, x int, y int, label int")
    nuclei = spark.createDataFrame([("a", "0", 4, 4)], "sample string, ids string, centroid_x int, centroid_y int")
    row = stain.cells_od(px, labels, nuclei, block=64, distance=2).collect()
    assert len(row) == 1 and row[0].ids == "0" and row[0].x == 4
    assert row[0].nuc_hemat_mean < row[0].cy_hemat_mean <= 1.0
