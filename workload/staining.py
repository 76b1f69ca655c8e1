"""Stain statistics and superpixels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissueframe.functions import colour
from tissueframe.operators import assignment, raster, stain, superpixels
from tissueframe.operators.features import blocks_to_pixels, color_mlp, pixels_to_blocks
from tissueframe.schemas import DEFAULT_STAIN
from workload.imaging import rounded
from workload.views import Data, num, sql

QUERIES: dict = {}
CHECKS: dict = {}


def query(name: str, check: str | None = None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if check:
            CHECKS[name] = check
        return fn

    return keep


def od(c: str) -> str:
    return f"greatest(-ln(greatest({c}, 1) / 255), {num(1e-6)})"


OD_SQL = f"od AS (SELECT *, {od('r')} AS o0, {od('g')} AS o1, {od('b')} AS o2 FROM pixels)"


@query("stain_od", sql("pixels", f"WITH {OD_SQL} SELECT sample, x, y, round(o0, 6) AS od_r, round(o1, 6) AS od_g, round(o2, 6) AS od_b FROM od"))
def _(d):
    return rounded(stain.with_od(d.pixels).drop("r", "g", "b"), *stain.OD)


@query("od_to_rgb", sql("pixels", f"WITH {OD_SQL} SELECT sample, x, y, CAST(trunc(255 * exp(-greatest(o0 / 2, {num(1e-6)}))) AS INT) AS r FROM od"))
def _(d):
    return d.pixels.select("sample", "x", "y", colour.od_to_rgb(colour.to_od(F.col("r")) / 2).alias("r"))


@query("stain_cov", sql("pixels", f"""WITH {OD_SQL} SELECT sample, CAST(floor(y / 50) AS INT) AS pi, CAST(floor(x / 50) AS INT) AS pj, count(*) AS n_pixels,
    {', '.join(f'round(covar_samp(o{i}, o{j}), 6) AS c{i}{j}' for i in range(3) for j in range(i, 3))} FROM od GROUP BY 1, 2, 3"""))
def _(d):
    keys = ["sample", "pi", "pj"]
    cov = stain.od_covariance(stain.colour_counts(raster.patch_index(d.pixels, 50), keys), keys)
    return rounded(cov, *[c for c in cov.columns if c.startswith("c")])


# Fixed stain rows of unit length stand in for estimated ones.
def unit(row):
    n = sum(v * v for v in row) ** 0.5
    return tuple(v / n for v in row)


H, E = unit((0.65, 0.70, 0.29)), unit((0.07, 0.99, 0.11))


def dot(row, names):
    return "(" + " + ".join(f"{num(v)} * {n}" for v, n in zip(row, names)) + ")"


OS = ("o0", "o1", "o2")
LASSO_SQL = f"""{OD_SQL},
  g AS (SELECT *, {dot(H, OS)} - {num(0.01)} AS g1, {dot(E, OS)} - {num(0.01)} AS g2, {num(sum(a * b for a, b in zip(H, E)))} AS c FROM od),
  s AS (SELECT *, (g1 - c * g2) / (1 - c * c) AS a, (g2 - c * g1) / (1 - c * c) AS bb, greatest(g1, 0) AS only1 FROM g),
  conc AS (SELECT sample, x, y,
      CASE WHEN a >= 0 AND bb >= 0 THEN a WHEN g2 - c * only1 <= 0 THEN only1 ELSE 0 END AS c1,
      CASE WHEN a >= 0 AND bb >= 0 THEN bb WHEN g2 - c * only1 <= 0 THEN 0 ELSE greatest(g2, 0) END AS c2 FROM s)"""


def with_fixed_stain(df):
    return df.withColumns({n: F.lit(v) for n, v in zip(stain.STAIN, H + E)})


@query("lasso2", sql("pixels", f"WITH {LASSO_SQL} SELECT sample, x, y, round(c1, 6) AS c1, round(c2, 6) AS c2 FROM conc"))
def _(d):
    mixed = stain.concentrations(with_fixed_stain(d.pixels))
    return rounded(mixed.select("sample", "x", "y", "c1", "c2"), "c1", "c2")


@query("max_concentration", sql("pixels", f"""WITH {LASSO_SQL} SELECT sample, round(quantile_cont(c1, {num(0.99)}), 6) AS max_c1,
    round(quantile_cont(c2, {num(0.99)}), 6) AS max_c2 FROM conc GROUP BY 1"""))
def _(d):
    stains = with_fixed_stain(d.thumbs.select("sample"))
    return rounded(stain.max_concentration(stain.colour_counts(d.pixels, ["sample"]), stains, ["sample"]), "max_c1", "max_c2")


@query("color_shift", sql("pixels", f"""WITH q AS (SELECT sample, 255 - CAST(trunc(quantile_cont(v, {num(0.95)})) AS INT) AS shift
    FROM (SELECT sample, unnest([r, g, b]) AS v FROM pixels) GROUP BY 1)
    SELECT sample, x, y, least(255, r + shift) AS r, least(255, g + shift) AS g, least(255, b + shift) AS b, shift FROM pixels JOIN q USING (sample)"""))
def _(d):
    return stain.color_shift(d.pixels)


FRACTION_SQL = """f AS (SELECT sample, CAST(floor(y / 20) AS INT) AS pi, CAST(floor(x / 20) AS INT) AS pj,
    avg(CASE WHEN (r + g + b) / 3 BETWEEN 130 AND 170 THEN 1 ELSE 0 END) AS fraction FROM pixels GROUP BY 1, 2, 3),
  top AS (SELECT *, max(fraction) OVER (PARTITION BY sample) AS top FROM f),
  chosen AS (SELECT *, CASE WHEN top >= 0.5 THEN 0.5 WHEN top >= 0.25 THEN 0.25 WHEN top >= 0.125 THEN 0.125 END::DOUBLE AS cutoff FROM top)"""


@query("select_patches", sql("pixels", f"WITH {FRACTION_SQL} SELECT sample, pi, pj, round(fraction, 6) AS fraction, cutoff FROM chosen WHERE fraction >= cutoff"))
def _(d):
    return rounded(stain.select_patches(d.pixels, 20, 130, 170), "fraction")


@query("representative_patch", sql("pixels", """WITH p AS (SELECT sample, CAST(floor(y / 20) AS INT) AS pi, CAST(floor(x / 20) AS INT) AS pj,
    avg(r) AS h_r, avg(g) AS h_g, avg(b) AS h_b, var_samp(r) AS e_r, var_samp(g) AS e_g, var_samp(b) AS e_b FROM pixels GROUP BY 1, 2, 3),
  m AS (SELECT sample, median(h_r) AS a, median(h_g) AS b, median(h_b) AS c, median(e_r) AS d, median(e_g) AS e, median(e_b) AS f FROM p GROUP BY 1),
  gap AS (SELECT sample, pi, pj, sqrt((h_r - a) ** 2 + (h_g - b) ** 2 + (h_b - c) ** 2 + (e_r - d) ** 2 + (e_g - e) ** 2 + (e_b - f) ** 2) AS gap FROM p JOIN m USING (sample))
  SELECT sample, pi, pj FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY gap, pi, pj) AS rn FROM gap) WHERE rn = 1"""))
def _(d):
    patches = raster.patch_index(d.pixels, 20).groupBy("sample", "pi", "pj").agg(
        *[F.avg(c).alias(f"h_{c}") for c in "rgb"], *[F.var_samp(c).alias(f"e_{c}") for c in "rgb"]
    )
    return stain.representative_patch(patches).select("sample", "pi", "pj")


def eigen_sql(k: int) -> str:
    """Unit eigenvector ``v{k}_0 .. v{k}_2`` of eigenvalue ``e{k}``: the longest cross product of two rows of ``C - e``."""
    rows = [(f"c00 - e{k}", "c01", "c02"), ("c01", f"c11 - e{k}", "c12"), ("c02", "c12", f"c22 - e{k}")]

    def cross(a, b):
        return [f"(({a[i]}) * ({b[j]}) - ({a[j]}) * ({b[i]}))" for i, j in ((1, 2), (2, 0), (0, 1))]

    turns = [cross(rows[i], rows[j]) for i, j in ((0, 1), (0, 2), (1, 2))]
    size = [" + ".join(f"{t} * {t}" for t in turn) for turn in turns]
    pick = "CASE WHEN n0 >= n1 AND n0 >= n2 THEN x0_{i} WHEN n1 >= n2 THEN x1_{i} ELSE x2_{i} END"
    inner = ", ".join([*[f"{t} AS x{m}_{i}" for m, turn in enumerate(turns) for i, t in enumerate(turn)], *[f"{n} AS n{m}" for m, n in enumerate(size)]])
    signed = f"(CASE WHEN {pick.format(i=0)} < 0 THEN -1 ELSE 1 END) / sqrt(greatest(n0, n1, n2))"
    return f"""SELECT * EXCLUDE (n0, n1, n2, {', '.join(f'x{m}_{i}' for m in range(3) for i in range(3))}),
        {', '.join(f"{pick.format(i=i)} * {signed} AS v{k}_{i}" for i in range(3))} FROM (SELECT *, {inner} FROM {{source}})"""


# Principal plane from the closed form of 3 x 3 eigenvalues; then angles, their two percentiles and the stains there.
STAIN_SQL = f"""{OD_SQL},
    patches AS (SELECT *, CAST(floor(y / 50) AS INT) AS pi, CAST(floor(x / 50) AS INT) AS pj FROM od),
    cov AS (SELECT sample, pi, pj, {', '.join(f'covar_samp(o{i}, o{j}) AS c{i}{j}' for i in range(3) for j in range(i, 3))} FROM patches GROUP BY 1, 2, 3),
    mid AS (SELECT *, (c00 + c11 + c22) / 3 AS q FROM cov),
    wide AS (SELECT *, sqrt(((c00 - q) * (c00 - q) + (c11 - q) * (c11 - q) + (c22 - q) * (c22 - q) + 2 * (c01 * c01 + c02 * c02 + c12 * c12)) / 6) AS p FROM mid),
    turned AS (SELECT *, acos(greatest(-1, least(1, ((c00 - q) * ((c11 - q) * (c22 - q) - c12 * c12) - c01 * (c01 * (c22 - q) - c12 * c02)
        + c02 * (c01 * c12 - (c11 - q) * c02)) / (2 * p * p * p)))) / 3 AS t FROM wide),
    valued AS (SELECT *, q + 2 * p * cos(t) AS e1, 3 * q - (q + 2 * p * cos(t)) - (q + 2 * p * cos(t + 2 * pi() / 3)) AS e2 FROM turned),
    first AS ({eigen_sql(1).format(source='valued')}),
    plane AS ({eigen_sql(2).format(source='first')}),
    angles AS (SELECT sample, pi, pj, {', '.join(f'any_value(v{k}_{i}) AS v{k}_{i}' for k in (1, 2) for i in range(3))},
        quantile_cont(phi, {num(0.01)}) AS low, quantile_cont(phi, {num(0.99)}) AS high
        FROM (SELECT *, atan2({' + '.join(f'v2_{i} * o{i}' for i in range(3))}, {' + '.join(f'v1_{i} * o{i}' for i in range(3))}) AS phi FROM patches JOIN plane USING (sample, pi, pj)) GROUP BY 1, 2, 3),
    ends AS (SELECT sample, pi, pj, {', '.join(f'v1_{i} * cos({e}) + v2_{i} * sin({e}) AS {e}_{i}' for e in ('low', 'high') for i in range(3))} FROM angles),
    ordered AS (SELECT sample, pi, pj, {', '.join(f'CASE WHEN low_0 > high_0 THEN {a}_{i} ELSE {b}_{i} END AS {n}_{i}' for n, a, b in (('h', 'low', 'high'), ('e', 'high', 'low')) for i in range(3))} FROM ends)
    SELECT sample, pi, pj, {', '.join(f'round({n}_{i} / sqrt({n}_0 * {n}_0 + {n}_1 * {n}_1 + {n}_2 * {n}_2), 6) AS {n}_{c}' for n in 'he' for i, c in enumerate('rgb'))} FROM ordered"""


@query("stain_matrix", sql("pixels", f"WITH {STAIN_SQL}"))
def _(d):
    keys = ["sample", "pi", "pj"]
    return rounded(stain.stain_matrix(raster.patch_index(d.pixels, 50), keys), *stain.STAIN)


FLAT = DEFAULT_STAIN[0] + DEFAULT_STAIN[1]
HE_SQL = f"""he0 AS (SELECT *, {dot(FLAT[:3], ('greatest(r, 1)', 'greatest(g, 1)', 'greatest(b, 1)'))} AS h0,
        {dot(FLAT[3:], ('greatest(r, 1)', 'greatest(g, 1)', 'greatest(b, 1)'))} AS e0 FROM pixels),
    he AS (SELECT sample, x, y, h0 / max(h0) OVER w AS h, e0 / max(e0) OVER w AS e FROM he0 WINDOW w AS (PARTITION BY sample))"""


def default_he(d):
    missing = d.thumbs.select("sample", *[F.lit(None).cast("double").alias(c) for c in stain.STAIN])
    return stain.he_channels(d.pixels, stain.with_default_stain(missing), ["sample"]).select("sample", "x", "y", "h", "e")


@query("he_channels", sql("pixels", f"WITH {HE_SQL} SELECT sample, x, y, round(h, 6) AS h, round(e, 6) AS e FROM he"))
def _(d):
    return rounded(default_he(d), "h", "e")


# Rings are cells outside a nucleus, handed to the nucleus left of them.
PARTS_SQL = f"""{HE_SQL},
  parts AS (SELECT sample, x, y, label, 'nuc' AS part FROM raster WHERE label > 0 UNION ALL
            SELECT sample, x, y, CAST(1 + floor(x / 10) + 10 * floor(y / 8) AS INT), 'cy' FROM raster WHERE label = 0 AND (x + y) % 3 = 0),
  seen AS (SELECT p.*, h, e FROM parts p JOIN he USING (sample, x, y))"""
MEASURE_SQL = """round(avg(h) FILTER (WHERE part = 'cy'), 6) AS cy_hemat_mean, round(avg(e) FILTER (WHERE part = 'cy'), 6) AS cy_eosin_mean,
    round(avg(h) FILTER (WHERE part = 'nuc'), 6) AS nuc_hemat_mean, round(avg(e) FILTER (WHERE part = 'nuc'), 6) AS nuc_eosin_mean,
    round(max(e) FILTER (WHERE part = 'cy'), 6) AS cy_eosin_max, round(min(e) FILTER (WHERE part = 'cy'), 6) AS cy_eosin_min"""


def parts(d):
    ring_label = (1 + F.floor(F.col("x") / 10) + 10 * F.floor(F.col("y") / 8)).cast("int")
    cells = d.raster
    both = cells.where("label > 0").withColumn("part", F.lit("nuc")).unionByName(
        cells.where("label = 0 AND (x + y) % 3 = 0").withColumn("label", ring_label).withColumn("part", F.lit("cy"))
    )
    return both.join(default_he(d), ["sample", "x", "y"])


@query("nucleus_stain", sql("raster", f"""WITH {PARTS_SQL} SELECT sample, label, {MEASURE_SQL} FROM seen GROUP BY 1, 2
    HAVING count(*) FILTER (WHERE part = 'cy') > 0 AND count(*) FILTER (WHERE part = 'nuc') > 0"""))
def _(d):
    return rounded(stain.nucleus_stain(parts(d), ["sample"]), *stain.MEASURES)


@query("merge_fragments", sql("raster", f"""WITH {PARTS_SQL}, frag AS (SELECT sample, CAST(floor(x / 4) AS INT) AS pj, label,
      avg(h) FILTER (WHERE part = 'cy') AS a, avg(h) FILTER (WHERE part = 'nuc') AS b FROM seen GROUP BY 1, 2, 3)
    SELECT sample, label, round(avg(a), 6) AS cy_hemat_mean, round(avg(b), 6) AS nuc_hemat_mean FROM frag WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2"""))
def _(d):
    pieces = stain.nucleus_stain(parts(d).withColumn("pj", F.floor(F.col("x") / 4).cast("int")), ["sample", "pj"])
    cols = ("cy_hemat_mean", "nuc_hemat_mean")
    return rounded(stain.merge_fragments(pieces, cols), *cols)


LAB_SQL = f"""lin AS (SELECT sample, x, y,
      {', '.join(f"CASE WHEN {c} / 255 > {num(0.04045)} THEN pow(({c} / 255 + {num(0.055)}) / {num(1.055)}, {num(2.4)}) ELSE {c} / 255 / {num(12.92)} END AS l{c}" for c in 'rgb')} FROM pixels),
    t AS (SELECT *, {', '.join(f"{dot(row, ('lr', 'lg', 'lb'))} / {num(w)} AS t{n}" for n, (row, w) in zip('xyz', zip(colour.RGB_TO_XYZ, colour.WHITE_D65)))} FROM lin),
    f AS (SELECT *, {', '.join(f"CASE WHEN t{n} > {num(0.008856)} THEN cbrt(t{n}) ELSE {num(7.787)} * t{n} + {num(16 / 116)} END AS f{n}" for n in 'xyz')} FROM t),
    lab AS (SELECT sample, x, y, 116 * fy - 16 AS l, 500 * (fx - fy) AS a, 200 * (fy - fz) AS b FROM f)"""


@query("rgb_to_lab", sql("pixels", f"WITH {LAB_SQL} SELECT sample, x, y, round(l, 5) AS l, round(a, 5) AS a, round(b, 5) AS b FROM lab"))
def _(d):
    lab = colour.rgb_to_lab(F.col("r"), F.col("g"), F.col("b"))
    return rounded(d.pixels.select("sample", "x", "y", lab.alias("c")).select("sample", "x", "y", "c.l", "c.a", "c.b"), "l", "a", "b", digits=5)


# A small recolouring network whose numbers are exact in binary.
LAYERS = (
    {"weight": [[0.5, 0.25, 0.0], [0.0, -0.5, 0.5]], "bias": [0.25, 0.125]},
    {"weight": [[1.0, 0.5], [0.5, -0.5], [-0.25, 1.0]], "bias": [0.0, 0.25, -0.5]},
)


def mlp_sql(layers) -> str:
    """The layers as nested selects in single precision, terms added in the order of the weights."""
    text = "SELECT sample, x, y, " + ", ".join(f"(({c}::FLOAT / 255::FLOAT) - 0.5::FLOAT) * 2::FLOAT AS v{i}" for i, c in enumerate("rgb")) + " FROM pixels"
    for k, layer in enumerate(layers):
        outs = []
        for j, (row, bias) in enumerate(zip(layer["weight"], layer["bias"])):
            total = " + ".join(f"v{i} * {w!r}::FLOAT" for i, w in enumerate(row)) + f" + {bias!r}::FLOAT"
            outs.append((f"greatest({total}, 0::FLOAT)" if k + 1 < len(layers) else total) + f" AS v{j}")
        text = f"SELECT sample, x, y, {', '.join(outs)} FROM ({text})"
    shown = ", ".join(f"CAST(floor(greatest(0::FLOAT, least(1::FLOAT, v{i} * 0.5::FLOAT + 0.5::FLOAT)) * 255::FLOAT) AS INT) AS {c}" for i, c in enumerate("rgb"))
    return f"SELECT sample, x, y, {shown} FROM ({text})"


@query("color_mlp", sql("pixels", mlp_sql(LAYERS)))
def _(d):
    return blocks_to_pixels(color_mlp(pixels_to_blocks(d.pixels, 64), LAYERS))


@query("normalise_stain")
def _(d):
    reference = d.pixels.where("sample = 'T0'").withColumn("sample", F.lit("reference"))
    return stain.normalise_stain(d.pixels, reference, s=50, low=100, high=220)


@query("cells_od")
def _(d):
    # The nuclei of the label raster, by id.
    cells = d.raster.where("label > 0")
    centres = cells.groupBy("sample", (F.col("label") - 1).cast("string").alias("ids")).agg(
        F.avg("x").cast("int").alias("centroid_x"), F.avg("y").cast("int").alias("centroid_y")
    )
    return rounded(stain.cells_od(d.pixels, cells, centres, block=50, distance=2), *stain.MEASURES)


# ---------------------------------------------------------------- superpixels

# Cells with measures: one per event on the thumbnails.
CELLS_SQL = """cells AS (SELECT sample, concat('', id) AS ids, x, y, m1, m2 FROM (
    SELECT concat('T', CAST(floor(o_orderkey / 10000) AS INT)) AS sample, o_orderkey AS id,
           (o_orderkey * 7) % 400 AS x, (o_orderkey * 13) % 400 AS y, o_totalprice AS m1, CAST(o_custkey AS DOUBLE) AS m2 FROM orders))"""


def cells(d):
    key = F.col("o_orderkey")
    return d.orders.select(
        F.concat(F.lit("T"), F.floor(key / 10000).cast("string")).alias("sample"),
        key.cast("string").alias("ids"),
        ((key * 7) % 400).alias("x"),
        ((key * 13) % 400).alias("y"),
        F.col("o_totalprice").alias("m1"),
        F.col("o_custkey").cast("double").alias("m2"),
    )


LOOKUP_SQL = f"""{CELLS_SQL}, placed AS (SELECT c.*, CAST(floor(c.x / 4) AS INT) AS xd, CAST(floor(c.y / 4) AS INT) AS yd FROM cells c),
    seen AS (SELECT p.*, s.label AS uspx FROM placed p LEFT JOIN segments s ON s.sample = p.sample AND s.x = xd AND s.y = yd)"""


@query("superpixel_lookup", sql("segments", f"WITH {LOOKUP_SQL} SELECT sample, ids, xd, yd, uspx FROM seen"))
def _(d):
    return assignment.assign_superpixel(cells(d), d.segments, 4).select("sample", "ids", "xd", "yd", "uspx")


SIZES_SQL = "sizes AS (SELECT sample, label AS uspx, count(*) * 16 AS spx_size FROM segments GROUP BY 1, 2)"


@query("superpixel_size", sql("segments", f"WITH {LOOKUP_SQL}, {SIZES_SQL} SELECT sample, ids, uspx, spx_size FROM seen LEFT JOIN sizes USING (sample, uspx)"))
def _(d):
    placed = assignment.assign_superpixel(cells(d), d.segments, 4)
    return superpixels.attach_superpixel_size(placed, d.segments, 4).select("sample", "ids", "uspx", "spx_size")


@query("superpixel_counts", sql("segments", "SELECT sample, label, count(*) AS n_cells FROM segments GROUP BY 1, 2"))
def _(d):
    return superpixels.superpixel_sizes(d.segments)


@query("superpixel_ids", sql("segments", """SELECT sample, label, CAST(label % 7 * 10000 + label AS BIGINT) AS uspx, CAST(label % 7 AS INT) AS patch,
    CAST(floor((label % 7 * 10000 + label) / 1000) AS INT) AS patch_compat FROM segments GROUP BY 1, 2"""))
def _(d):
    named = d.segments.select("sample", "label").distinct().withColumn("uspx", superpixels.superpixel_id(F.col("label") % 7, F.col("label")))
    return named.withColumn("patch", superpixels.superpixel_patch(F.col("uspx"))).withColumn(
        "patch_compat", superpixels.superpixel_patch(F.col("uspx"), compat=True)
    )


@query("median_normalise", sql("", f"""WITH {CELLS_SQL}, m AS (SELECT sample, median(m1) AS a, median(m2) AS b FROM cells GROUP BY 1)
    SELECT sample, ids, round(m1 * {num(0.18)} / a, 6) AS m1, round(m2 * {num(0.18)} / b, 6) AS m2 FROM cells JOIN m USING (sample)"""))
def _(d):
    return rounded(superpixels.median_normalise(cells(d), ["m1", "m2"]).drop("x", "y"), "m1", "m2")


@query("od_per_cell", sql("segments", f"""WITH {LOOKUP_SQL}, {SIZES_SQL}, m AS (SELECT sample, median(m1) AS a, median(m2) AS b FROM cells GROUP BY 1)
    SELECT sample, ids, xd, yd, uspx, CAST(floor(uspx / 10000) AS INT) AS ipatch, spx_size,
           round(m1 * {num(0.18)} / a, 6) AS cy_hemat_mean, round(m2 * {num(0.18)} / b, 6) AS nuc_eosin_mean
    FROM seen JOIN m USING (sample) LEFT JOIN sizes USING (sample, uspx)"""))
def _(d):
    measured = cells(d).withColumns({c: F.col("m1") for c in stain.MEASURES}).withColumn("nuc_eosin_mean", F.col("m2"))
    report = superpixels.od_per_cell(measured, d.segments, 4)
    return rounded(
        report.select("sample", "ids", "xd", "yd", "uspx", "ipatch", "spx_size", "cy_hemat_mean", "nuc_eosin_mean"),
        "cy_hemat_mean", "nuc_eosin_mean",
    )


@query("numeric_id_order", sql("", f"WITH {CELLS_SQL} SELECT sample, ids FROM cells ORDER BY sample, CAST(ids AS BIGINT)"))
def _(d):
    return superpixels.order_by_numeric_id(cells(d).select("sample", "ids"))


@query("distinct_labels", sql("raster", "SELECT DISTINCT sample, label FROM raster"))
def _(d):
    return d.raster.select("sample", "label").distinct()


def superpixels_sql(s: int, side: int, weight: float, rounds: int) -> str:
    """Every pixel with the cheapest of the nine seeds around it, ``rounds`` moves written one after the other."""
    channels = ("l", "a", "b", "x", "y")
    means = ", ".join(f"avg({c}) AS {c}" for c in channels)
    cell = "sample, pi, pj"
    cost = " + ".join(f"{num(w)} * (p.{c} - s.{c}) * (p.{c} - s.{c})" for c, w in zip(channels, (1.0, 1.0, 1.0, weight, weight)))
    steps = [
        f"cut AS MATERIALIZED (SELECT *, y // {s} AS pi, x // {s} AS pj, (y % {s}) // {side} AS ci, (x % {s}) // {side} AS cj FROM lab)",
        f"s0 AS MATERIALIZED (SELECT {cell}, ci AS si, cj AS sj, {means} FROM cut GROUP BY ALL)",
    ]
    for r in range(rounds + 1):
        steps.append(f"""c{r} AS MATERIALIZED (SELECT {cell}, p.l, p.a, p.b, p.x, p.y,
          min([CAST(floor(({cost}) * 1000000 + {num(0.3)}) AS BIGINT), si, sj]) AS best
        FROM cut p JOIN s{r} s USING ({cell}) WHERE abs(si - ci) <= 1 AND abs(sj - cj) <= 1 GROUP BY ALL)""")
        steps.append(f"""s{r + 1} AS MATERIALIZED (SELECT {cell}, best[2] AS si, best[3] AS sj, {means} FROM c{r} GROUP BY ALL
        UNION ALL SELECT * FROM s{r} ANTI JOIN (SELECT {cell}, best[2] AS si, best[3] AS sj FROM c{r}) USING ({cell}, si, sj))""")
    return ", ".join(steps)


@query("superpixels", sql("pixels thumbs", f"""WITH {LAB_SQL}, {superpixels_sql(64, 10, 1.0, 3)}
    SELECT sample, CAST(c.x AS INT) AS x, CAST(c.y AS INT) AS y,
      CAST((pi * (width // 64 + 1) + pj) * 10000 + best[2] * 7 + best[3] AS BIGINT) AS label FROM c3 c JOIN thumbs USING (sample)"""))
def _(d):
    return superpixels.superpixels(d.pixels, d.thumbs, s=64, pixels_per_segment=100, compactness=10.0, rounds=3)
