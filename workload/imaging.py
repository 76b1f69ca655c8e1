"""Grids, rasters, nuclei and spots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissueframe.functions import contour as C
from tissueframe.functions.scalar import round_even
from tissueframe.operators import assignment, grid, nuclei, raster, spots
from tissueframe.plans.spread import spread_evenly
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


def rounded(df, *names, digits: int = 6):
    """Doubles rounded for comparison across engines."""
    return df.withColumns({n: F.round(n, digits) for n in names})


# ------------------------------------------------------------------------ grids

HEX = {"tile": 294 / 65 * 65 * 40.0 / 40.0, "dx": 294 / 65 * 100 * 40.0 / 40.0}
HEX["dy"] = 0.5 * (64 / 39) * HEX["dx"] / 0.95
SQUARE = {"tile": 4.0 * 56 * 40.0 / 40.0, "dx": 4.0 * 56 * 40.0 / 40.0, "dy": 4.0 * 56 * 40.0 / 40.0}


def grid_sql(g: dict, hexagonal: bool) -> str:
    t, dx, dy = num(g["tile"]), num(g["dx"]), num(g["dy"])
    shift = f"CASE WHEN j % 2 = 1 THEN 0.5 * {dx} ELSE 0 END" if hexagonal else "0"
    return f"""
    grid0 AS (
      SELECT sample, i, j,
             CAST(trunc({t} / 2 + i * {dx} + {shift}) AS INT) AS px,
             CAST(trunc({t} / 2 + j * {dy}) AS INT) AS py, x, y
      FROM slides, range(0, 30) a(i), range(0, 30) b(j)
      WHERE i < ceil(x / {dx}) AND j < ceil(y / {dy})),
    grid AS (
      SELECT sample, concat('tile-', lpad(concat('', row_number() OVER w), 8, '0')) AS barcode,
             1 AS in_tissue, CAST(j AS INT) AS array_row, CAST(i AS INT) AS array_col,
             py AS pxl_row_in_fullres, px AS pxl_col_in_fullres, row_number() OVER w AS grid_ord
      FROM grid0 WHERE px + {t} / 2 <= x AND py + {t} / 2 <= y
      WINDOW w AS (PARTITION BY sample ORDER BY i, j))"""


HEX_SQL, SQUARE_SQL = grid_sql(HEX, True), grid_sql(SQUARE, False)
SQUARE_ARGS = dict(grid_type="square", resolution=4.0, spot_diameter=56, spot_spacing=56)


def hex_grid(d):
    return grid.make_grid(d.slides, "hex")


def hex_info(d):
    return grid.grid_info(d.slides, "hex")


@query("grid_hex", sql("slides", f"WITH {HEX_SQL} SELECT * FROM grid"))
def _(d):
    return hex_grid(d)


@query("grid_square", sql("slides", f"WITH {SQUARE_SQL} SELECT * FROM grid"))
def _(d):
    return grid.make_grid(d.slides, **SQUARE_ARGS)


@query(
    "rescale_grid",
    sql("slides", f"""WITH {HEX_SQL} SELECT g.sample, barcode,
        CAST(trunc(pxl_row_in_fullres * (mpp / {num(0.25)})) AS INT) AS pxl_row_in_fullres,
        CAST(trunc(pxl_col_in_fullres * (mpp / {num(0.25)})) AS INT) AS pxl_col_in_fullres,
        round({num(HEX['tile'])} * (mpp / {num(0.25)}), 6) AS diameter
        FROM grid g JOIN slides USING (sample)"""),
)
def _(d):
    moved, info = grid.rescale_grid(hex_grid(d), hex_info(d), d.slides)
    joined = moved.join(info.select("sample", F.col("spot_diameter_fullres").alias("diameter")), "sample")
    return rounded(joined.select("sample", "barcode", "pxl_row_in_fullres", "pxl_col_in_fullres", "diameter"), "diameter")


@query(
    "resolve_grid",
    sql("slides", f"""WITH {HEX_SQL}, tagged AS (
        SELECT *, CAST(substr(sample, 2) AS INT) % 3 AS k FROM grid)
        SELECT sample, barcode, CASE k WHEN 0 THEN 'sheet' WHEN 1 THEN 'aligner' ELSE 'new' END AS source,
               pxl_row_in_fullres + CAST(CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS INT) AS pxl_row_in_fullres,
               k = 1 AS full_roi
        FROM tagged"""),
)
def _(d):
    # A third of the slides bring their own grid, a third have an aligner grid.
    kind = F.substring("sample", 2, 20).cast("int") % 3
    sheet = d.slides.select("sample", F.when(kind == 0, F.lit("given")).alias("grid"))
    made = hex_grid(d)
    given = made.where(kind == 0).withColumn("pxl_row_in_fullres", F.col("pxl_row_in_fullres") + 1)
    aligned = made.where(kind == 1).withColumn("pxl_row_in_fullres", F.col("pxl_row_in_fullres") + 2)
    return grid.resolve_grid(sheet, given, aligned, made).select("sample", "barcode", "source", "pxl_row_in_fullres", "full_roi")


FACTORS = (1.0, 1.25, 2.0, 3.0)

WINDOWS_SQL = f"""sized AS (
    SELECT sample, barcode, pxl_row_in_fullres, pxl_col_in_fullres, f AS expansion_factor,
           CAST(CASE WHEN f <> 1 THEN ceil(f) ELSE 1 END AS INT) AS stride,
           CAST(round_even({num(HEX['tile'])}, 0) AS INT) AS out
    FROM grid, (SELECT unnest([1.0, 1.25, 2.0, 3.0])::DOUBLE AS f)),
  windows AS (
    SELECT *, out * stride AS side,
           CAST(trunc(pxl_col_in_fullres - (out * stride) / 2) AS INT) AS x0,
           CAST(trunc(pxl_row_in_fullres - (out * stride) / 2) AS INT) AS y0
    FROM sized)"""
WINDOW_COLS = ("sample", "barcode", "expansion_factor", "stride", "out", "side", "x0", "y0")


@query("expand_factors", sql("slides", f"WITH {HEX_SQL}, {WINDOWS_SQL} SELECT sample, barcode, expansion_factor FROM sized"))
def _(d):
    return grid.expand_factors(hex_grid(d), FACTORS).select("sample", "barcode", "expansion_factor")


def windows(d):
    spread = grid.expand_factors(hex_grid(d), FACTORS)
    return grid.tile_windows(spread, hex_info(d), F.col("expansion_factor"))


@query("tile_windows", sql("slides", f"WITH {HEX_SQL}, {WINDOWS_SQL} SELECT {', '.join(WINDOW_COLS)} FROM windows"))
def _(d):
    return windows(d).select(*WINDOW_COLS)


@query(
    "subtile_windows",
    sql("slides", f"""WITH {HEX_SQL}, {WINDOWS_SQL}
        SELECT sample, barcode, expansion_factor, CAST(n AS INT) AS subtile,
               CAST(y0 + floor(side / 4) * (i - 1) AS INT) AS sub_y0,
               CAST(x0 + floor(side / 4) * (i - 1) AS INT) AS sub_x0,
               CAST(2 * floor(side / 4) AS INT) AS sub_side
        FROM windows, (VALUES (0, 1, 1), (1, 3, 1), (2, 2, 2), (3, 1, 3), (4, 3, 3)) c(n, i, j)"""),
)
def _(d):
    return grid.subtile_windows(windows(d)).select(
        "sample", "barcode", "expansion_factor", "subtile", "sub_y0", "sub_x0", "sub_side"
    )


# ---------------------------------------------------------------- masks, pixels

MASK_SQL = """mask AS (
    SELECT sample, x, y, CAST((r + g + b) / 3 BETWEEN 100 AND 200 AS INT) AS in_tissue FROM pixels)"""


@query("pixel_mask", sql("pixels", f"WITH {MASK_SQL} SELECT * FROM mask"))
def _(d):
    return raster.pixel_mask(d.pixels)


# The thumbnails belong to slides of 3100 x 3100 with tiles of 124 pixels.
TILE = {"tile": 124.0, "dx": 155.0, "dy": 155.0}
TILE_ARGS = dict(grid_type="square", resolution=1.0, spot_diameter=124, spot_spacing=155)


def thumb_slides(d):
    return d.thumbs.select("sample", F.lit(3100).alias("x"), F.lit(3100).alias("y"))


THUMB_GRID = f"slides AS (SELECT sample, 3100 AS x, 3100 AS y FROM thumbs), {grid_sql(TILE, False)}"
TILE_MASK_SQL = f"""{MASK_SQL}, {THUMB_GRID},
    sc AS (SELECT {num(0.5)} * (100 / 3100) + {num(0.5)} * (100 / 3100) AS s),
    boxes AS (SELECT sample, barcode, CAST(trunc(pxl_col_in_fullres * s) AS INT) AS cx,
                     CAST(trunc(pxl_row_in_fullres * s) AS INT) AS cy, CAST(trunc(124 * s / 2) AS INT) AS h FROM grid, sc),
    tilemask AS (SELECT b.sample, b.barcode,
           CASE WHEN any_value(cx - h) < 0 OR any_value(cy - h) < 0 THEN 0
                ELSE coalesce(CAST(avg(m.in_tissue) >= {num(0.6)} AS INT), 0) END AS in_tissue
    FROM boxes b LEFT JOIN mask m ON b.sample = m.sample AND m.x >= cx - h AND m.x < cx + h AND m.y >= cy - h AND m.y < cy + h
    GROUP BY b.sample, b.barcode)"""


def thumb_tiles(d):
    slides = thumb_slides(d)
    made = grid.make_grid(slides, **TILE_ARGS)
    info = grid.grid_info(slides, **TILE_ARGS)
    mask = raster.tile_mask(made, info, raster.pixel_mask(d.pixels), d.thumbs, 0.6)
    return made, info, mask


@query("tile_mask", sql("thumbs", f"WITH {TILE_MASK_SQL} SELECT * FROM tilemask"))
def _(d):
    return thumb_tiles(d)[2]


@query(
    "mask_override",
    sql("thumbs", f"""WITH {TILE_MASK_SQL}
        SELECT g.sample, g.barcode, CASE WHEN array_col % 2 = 0 THEN m.in_tissue ELSE g.in_tissue END AS in_tissue
        FROM grid g JOIN tilemask m USING (sample, barcode)"""),
)
def _(d):
    made, _, mask = thumb_tiles(d)
    tagged = made.withColumn("source", F.when(F.col("array_col") % 2 == 0, "new").otherwise("aligner"))
    return grid.override_mask(tagged, mask).select("sample", "barcode", "in_tissue")


@query("mask_semi", sql("thumbs", f"""WITH {TILE_MASK_SQL} SELECT g.sample, g.barcode, g.array_row, g.array_col
    FROM grid g WHERE EXISTS (SELECT 1 FROM tilemask m WHERE m.sample = g.sample AND m.barcode = g.barcode AND m.in_tissue = 1)"""))
def _(d):
    made, _, mask = thumb_tiles(d)
    return grid.keep_listed(made, grid.in_tissue(mask), ["sample", "barcode"]).select("sample", "barcode", "array_row", "array_col")


@query("in_tissue", sql("thumbs", f"WITH {TILE_MASK_SQL} SELECT sample, barcode FROM tilemask WHERE in_tissue = 1"))
def _(d):
    return grid.in_tissue(thumb_tiles(d)[2]).select("sample", "barcode")


# The draw is by hash; what SQL knows of it is its size, and that it takes tiles in tissue, each once.
@query("sample_tiles", sql("slides", f"""WITH {HEX_SQL} SELECT sample, least(20, count(*)) AS drawn, least(20, count(*)) AS different, 0 AS strange
    FROM grid WHERE array_col % 2 = 0 GROUP BY 1"""))
def _(d):
    flagged = hex_grid(d).withColumn("in_tissue", (F.col("array_col") % 2 == 0).cast("int"))
    drawn = grid.sample_tiles(flagged, 20, seed=7).select("sample", "barcode")
    known = flagged.where("in_tissue = 1").select("sample", "barcode", F.lit(1).alias("known"))
    return drawn.join(known, ["sample", "barcode"], "left").groupBy("sample").agg(
        F.count("*").alias("drawn"), F.countDistinct("barcode").alias("different"), F.count_if(F.col("known").isNull()).alias("strange")
    )


# With more draws than tiles a slide gives all of its tiles.
@query("sample_tiles_all", sql("slides", f"WITH {HEX_SQL} SELECT sample, barcode FROM grid WHERE array_col % 2 = 0"))
def _(d):
    flagged = hex_grid(d).withColumn("in_tissue", (F.col("array_col") % 2 == 0).cast("int"))
    return grid.sample_tiles(flagged, 100).select("sample", "barcode")


ROI_SQL = """roi AS (SELECT sample, 100 AS width, 100 AS height, CAST(trunc(100 * 0.33::DOUBLE) AS INT) AS x0,
    CAST(trunc(100 * 0.1::DOUBLE) AS INT) AS y0, CAST(trunc(100 * 0.5::DOUBLE) AS INT) AS w, CAST(trunc(100 * 0.255::DOUBLE) AS INT) AS h FROM thumbs)"""


def thumb_roi(d):
    text = F.lit('{"0":{"location":0.33,"size":0.5},"1":{"location":0.1,"size":0.255}}')
    from tissueframe.functions.jsonx import parse_roi

    return d.thumbs.select("sample", parse_roi(text).alias("roi"))


@query("crop_roi", sql("pixels thumbs", f"""WITH {ROI_SQL} SELECT p.sample, p.x - x0 AS x, p.y - y0 AS y, r, g, b
    FROM pixels p JOIN roi USING (sample) WHERE x >= x0 AND x < x0 + w AND y >= y0 AND y < y0 + h"""))
def _(d):
    return raster.crop_roi(d.pixels, thumb_roi(d), d.thumbs)


@query("image_size", sql("slides", """SELECT sample, CAST(round_even(CAST(x AS DOUBLE) * y / 1e6, 0) AS BIGINT) AS whole_mp,
    CAST(round_even(CAST(trunc(x * 0.5::DOUBLE) AS DOUBLE) * trunc(y * 0.4::DOUBLE) / 1e6, 0) AS BIGINT) AS roi_mp,
    CAST(floor(CAST(x AS DOUBLE) * y / 1e6) AS BIGINT) AS cut_mp FROM slides"""))
def _(d):
    from tissueframe.functions.jsonx import parse_roi

    meta = d.slides.select("sample", F.col("x").alias("width"), F.col("y").alias("height"))
    text = F.lit('{"0":{"location":0.2,"size":0.5},"1":{"location":0.1,"size":0.4}}')
    roi = d.slides.select("sample", parse_roi(text).alias("roi"))
    whole = raster.image_size_mp(meta, roi, whole=True).withColumnRenamed("size_mp", "whole_mp")
    part = raster.image_size_mp(meta, roi).withColumnRenamed("size_mp", "roi_mp")
    cut = raster.image_size_mp(meta, roi, whole=True, resized=True).withColumnRenamed("size_mp", "cut_mp")
    return whole.join(part, "sample").join(cut, "sample")


@query("stride_downsample", sql("pixels", """SELECT sample, CAST(floor(x / 4) AS INT) AS x, CAST(floor(y / 4) AS INT) AS y, r, g, b
    FROM pixels WHERE x % 4 = 0 AND y % 4 = 0"""))
def _(d):
    return raster.stride_downsample(d.pixels, 4)


@query("area_downsample", sql("pixels", f"""SELECT sample, CAST(floor(x * {num(0.15)}) AS INT) AS x, CAST(floor(y * {num(0.15)}) AS INT) AS y,
    round(avg(r), 6) AS r, round(avg(g), 6) AS g, round(avg(b), 6) AS b FROM pixels GROUP BY 1, 2, 3"""))
def _(d):
    return rounded(raster.area_downsample(d.pixels, 0.15), "r", "g", "b")


@query("patch_index", sql("pixels", """SELECT sample, CAST(floor(y / 32) AS INT) AS pi, CAST(floor(x / 32) AS INT) AS pj,
    CAST(floor(y / 32) * 4 + floor(x / 32) AS INT) AS ipatch, count(*) AS n FROM pixels GROUP BY 1, 2, 3, 4"""))
def _(d):
    return raster.patch_index(d.pixels, 32, F.lit(4)).groupBy("sample", "pi", "pj", "ipatch").agg(F.count("*").alias("n"))


@query("foreground", sql("pixels", "SELECT sample, x, y FROM pixels WHERE (r + g + b) / 3 BETWEEN 80 AND 180"))
def _(d):
    return raster.foreground(raster.detect_scale(d.pixels), 80, 180)


@query("label_boundaries", sql("raster", """SELECT a.sample, a.x, a.y, a.label FROM raster a WHERE EXISTS (
    SELECT 1 FROM raster b WHERE a.sample = b.sample AND abs(a.x - b.x) + abs(a.y - b.y) = 1 AND a.label <> b.label
    AND b.x BETWEEN a.x - 1 AND a.x + 1)"""))
def _(d):
    return raster.label_boundaries(d.raster)


CHECKS["label_boundaries"] = sql("raster", """SELECT DISTINCT a.sample, a.x, a.y, a.label
    FROM raster a, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) s(dx, dy), raster b
    WHERE a.sample = b.sample AND b.x = a.x + dx AND b.y = a.y + dy AND a.label <> b.label""")


@query("label_adjacency", sql("segments", """SELECT a.sample, least(a.label, b.label) AS label_a, greatest(a.label, b.label) AS label_b,
    count(*) AS border FROM segments a, (VALUES (1, 0), (0, 1)) s(dx, dy), segments b
    WHERE a.sample = b.sample AND b.x = a.x + dx AND b.y = a.y + dy AND a.label <> b.label GROUP BY 1, 2, 3"""))
def _(d):
    return raster.label_adjacency(d.segments)


@query("expand_labels", sql("raster", """WITH steps AS (
    SELECT dx, dy FROM range(-3, 4) a(dx), range(-3, 4) b(dy) WHERE dx * dx + dy * dy <= 9),
    near AS (SELECT sample, x + dx AS x, y + dy AS y, dx * dx + dy * dy AS d2, label FROM raster, steps WHERE label > 0)
    SELECT n.sample, CAST(n.x AS INT) AS x, CAST(n.y AS INT) AS y, arg_min(n.label, n.d2 * 1000000 + n.label) AS label
    FROM near n WHERE n.x BETWEEN 0 AND 99 AND n.y BETWEEN 0 AND 99 AND NOT EXISTS (SELECT 1 FROM raster r WHERE r.sample = n.sample AND r.x = n.x AND r.y = n.y AND r.label > 0)
    GROUP BY 1, 2, 3"""))
def _(d):
    return raster.expand_labels(d.raster.where("label > 0"), 3, d.thumbs)


@query("focus", sql("pixels", """WITH grey AS (SELECT sample, x, y, r + g + b AS v FROM pixels),
    sent AS (SELECT sample, x + dx AS x, y + dy AS y, v * w AS v
             FROM grey, (VALUES (0, 0, -4), (1, 0, 1), (-1, 0, 1), (0, 1, 1), (0, -1, 1)) s(dx, dy, w)),
    lap AS (SELECT sample, x, y, sum(v) AS v FROM sent GROUP BY 1, 2, 3 HAVING count(*) = 5)
    SELECT sample, CAST(floor(x / 25) AS INT) AS tx, CAST(floor(y / 25) AS INT) AS ty,
           round(var_pop(v / 3), 4) AS focus, count(*) AS n_pixels FROM lap GROUP BY 1, 2, 3"""))
def _(d):
    return rounded(raster.focus_score(d.pixels, 25), "focus", digits=4)


@query("check_mask", sql("pixels", f"""WITH {MASK_SQL}, bg AS (
    SELECT p.sample, avg(CASE WHEN in_tissue = 0 THEN (r + g + b) / 3 END) AS shade
    FROM pixels p JOIN mask USING (sample, x, y) GROUP BY 1)
    SELECT m.sample, x, y, CASE WHEN coalesce(shade < 216, false) THEN 1 ELSE in_tissue END AS in_tissue FROM mask m JOIN bg USING (sample)"""))
def _(d):
    return raster.check_mask(d.pixels, raster.pixel_mask(d.pixels), 216.0)


@query("binarise_half_max", sql("pixels", """SELECT p.sample, x, y, CAST(g >= top / 2 AS INT) AS g
    FROM pixels p JOIN (SELECT sample, max(g) AS top FROM pixels GROUP BY 1) USING (sample)"""))
def _(d):
    return raster.binarise_half_max(d.pixels.select("sample", "x", "y", "g"), "g")


# Disks as starts and ends along a row, closing by running maxima and minima, holes by a flood over the gaps of rows.
def tissue_mask_sql(chunk: int, kernel: int) -> str:
    around = f"ROWS BETWEEN {kernel // 2} PRECEDING AND {kernel - kernel // 2 - 1} FOLLOWING"
    across, down = "PARTITION BY sample, y ORDER BY x", "PARTITION BY sample, x ORDER BY y"
    return f"""{HEX_SQL},
    info AS (SELECT sample, f, CAST(trunc(trunc({num(HEX["tile"])}) * {num(1.5)} / f) AS INT) AS r,
        CAST(ceil(x / f) AS INT) AS width, CAST(ceil(y / f) AS INT) AS height
      FROM (SELECT *, CAST(ceil(greatest(x, y) / {chunk}) AS INT) AS f FROM slides)),
    tiles AS (SELECT sample, r, width, height, pxl_col_in_fullres // f AS cx, pxl_row_in_fullres // f AS cy
      FROM grid JOIN info USING (sample) WHERE array_col % 3 <> 1),
    rows_ AS (SELECT sample, cy + dy AS y, width, cx - CAST(ceil(sqrt(r * r - dy * dy)) AS INT) + 1 AS x0, cx + CAST(ceil(sqrt(r * r - dy * dy)) AS INT) AS x1
      FROM tiles JOIN range(-200, 201) d(dy) ON abs(dy) < r WHERE cy + dy BETWEEN 0 AND height - 1),
    marks AS (SELECT sample, y, x, sum(v) AS v FROM (
        SELECT sample, y, greatest(x0, 0) AS x, 1 AS v FROM rows_ WHERE x1 > 0 AND x0 < width
        UNION ALL SELECT sample, y, x1, -1 FROM rows_ WHERE x1 > 0 AND x0 < width) GROUP BY ALL),
    canvas AS (SELECT sample, i AS x, j AS y, width, height FROM info JOIN range(0, {chunk}) a(i) ON i < width JOIN range(0, {chunk}) b(j) ON j < height),
    marked AS (SELECT sample, x, y, width, height, coalesce(v, 0) AS v FROM canvas LEFT JOIN marks USING (sample, x, y)),
    drawn AS (SELECT * EXCLUDE (v), sum(v) OVER ({across}) > 0 AS m FROM marked),
    wide AS (SELECT * REPLACE (bool_or(m) OVER ({across} {around}) AS m) FROM drawn),
    grown AS MATERIALIZED (SELECT * REPLACE (bool_or(m) OVER ({down} {around}) AS m) FROM wide),
    gaps AS MATERIALIZED (SELECT sample, y, min(x) AS a, max(x) AS b,
        bool_or(x = 0 OR y = 0 OR x = width - 1 OR y = height - 1) AS edge
      FROM (SELECT *, x - row_number() OVER ({across}) AS island FROM grown WHERE NOT m) GROUP BY sample, y, island),
    outside AS (SELECT sample, y, a, b FROM gaps WHERE edge
      UNION SELECT g.sample, g.y, g.a, g.b FROM outside o JOIN gaps g ON g.sample = o.sample AND abs(g.y - o.y) = 1 AND g.a <= o.b AND g.b >= o.a),
    free AS (SELECT sample, y, unnest(range(a, b + 1)) AS x FROM outside),
    filled AS (SELECT c.sample, c.x, c.y, o.x IS NULL AS m FROM canvas c LEFT JOIN free o ON o.sample = c.sample AND o.y = c.y AND o.x = c.x),
    thin AS (SELECT * REPLACE (bool_and(m) OVER ({across} {around}) AS m) FROM filled),
    closed AS (SELECT * REPLACE (bool_and(m) OVER ({down} {around}) AS m) FROM thin)"""


@query("tissue_mask", sql("slides", f"""WITH {tissue_mask_sql(300, 10)}
    SELECT sample, CAST(y AS INT) AS y, count(*) AS cells, CAST(min(x) AS INT) AS x0, CAST(max(x) AS INT) AS x1, CAST(sum(x * x) AS BIGINT) AS spread
    FROM closed WHERE m GROUP BY 1, 2""").replace("WITH ", "WITH RECURSIVE ", 1))
def _(d):
    # Every third tile column is tissue, so the mask has bands and holes.
    slides = spread_evenly(d.slides, "sample")
    flagged = grid.make_grid(slides, "hex").withColumn("in_tissue", (F.col("array_col") % 3 != 1).cast("int"))
    return raster.tissue_mask(flagged, hex_info(d), chunk=300, kernel=10).groupBy("sample", "y").agg(
        F.count("*").alias("cells"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.sum(F.col("x").cast("long") * F.col("x")).alias("spread")
    )


# -------------------------------------------------------------- nuclei to spots


def assigned_sql(factor: int, circle: bool) -> str:
    t = num(HEX["tile"])
    within = (
        f"sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)) <= {factor} * {t} / 2"
        if circle
        else f"abs(px - cx) <= {factor} * {t} / 2 AND abs(py - cy) <= {factor} * {t} / 2"
    )
    return f"""cand AS (
        SELECT n.sample, n.ids, g.barcode, row_number() OVER (PARTITION BY n.sample, n.ids
               ORDER BY (px - cx) * (px - cx) + (py - cy) * (py - cy), grid_ord) AS rn
        FROM (SELECT sample, ids, centroid_x AS cx, centroid_y AS cy FROM nuclei) n
        JOIN (SELECT sample, barcode, grid_ord, pxl_col_in_fullres AS px, pxl_row_in_fullres AS py FROM grid) g USING (sample)
        WHERE {within}),
      best AS (SELECT sample, ids, barcode FROM cand WHERE rn = 1)"""


def assigned(d, shape="square", factor=1):
    fn = assignment.assign_square if shape == "square" else assignment.assign_circle
    return fn(d.nuclei, hex_grid(d), hex_info(d), factor)


for _shape, _factor in (("square", 1), ("square", 2), ("circle", 1), ("circle", 2)):
    _name = f"assign_{_shape}" + ("" if _factor == 1 else f"_x{_factor}")

    @query(_name, sql("slides nuclei", f"""WITH {HEX_SQL}, {assigned_sql(_factor, _shape == 'circle')}
        SELECT n.sample, n.ids, barcode FROM nuclei n LEFT JOIN best USING (sample, ids)"""))
    def _(d, shape=_shape, factor=_factor):
        return assigned(d, shape, factor).select("sample", "ids", "barcode")


SPOT_SQL = f"""{HEX_SQL}, {assigned_sql(2, False)},
    cells AS (SELECT n.* REPLACE (CASE WHEN cell_type_prob < {num(0.75)} THEN 'no_label' ELSE cell_type END AS cell_type), barcode
              FROM nuclei n JOIN best USING (sample, ids))"""


def spot_cells(d):
    return nuclei.relabel_low_prob(assigned(d, "square", 2), 0.75)


def over_classes(template: str) -> str:
    return ", ".join(template.format(c=c) for c in spots.CLASSES)


def spot_query(name: str, columns: str, fn, doubles=()):
    text = sql("slides nuclei", f"WITH {SPOT_SQL} SELECT sample, barcode, {columns} FROM cells GROUP BY 1, 2")

    @query(name, text)
    def _(d):
        result = fn(spot_cells(d))
        return rounded(result, *[c for c in result.columns if c.startswith(doubles)]) if doubles else result


Q2 = ("area", "orientation")
COUNT_COLS = over_classes("count(*) FILTER (WHERE cell_type = '{c}') AS count_{c}")
DENSITY_COLS = over_classes("round(avg(CASE WHEN cell_type = '{c}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS density_{c}")
MEAN_COLS = ", ".join(over_classes(f"round(avg({q}) FILTER (WHERE cell_type = '{{c}}'), 6) AS average_{q}_{{c}}") for q in Q2)
STD_COLS = ", ".join(over_classes(f"round(stddev_samp({q}) FILTER (WHERE cell_type = '{{c}}'), 6) AS std_{q}_{{c}}") for q in Q2)
STAT_COLS = ", ".join(f"round(avg({q}), 6) AS average_{q}, round(stddev_samp({q}), 6) AS std_{q}" for q in Q2)

spot_query("spot_counts", COUNT_COLS, spots.spot_counts)
spot_query("spot_density", DENSITY_COLS, spots.spot_density, ("density",))
spot_query("spot_totals", "count(*) AS total_count", spots.spot_totals)
spot_query("spot_class_means", MEAN_COLS, lambda n: spots.spot_class_means(n, Q2), ("average",))
spot_query("spot_class_stds", STD_COLS, lambda n: spots.spot_class_stds(n, Q2), ("std",))
spot_query("spot_stats", STAT_COLS, lambda n: spots.spot_stats(n, Q2), ("average", "std"))


@query("per_spot", sql("slides nuclei", f"""WITH {SPOT_SQL} SELECT sample, barcode, {DENSITY_COLS}, {COUNT_COLS},
    count(*) AS total_count, {MEAN_COLS}, {STD_COLS}, {STAT_COLS} FROM cells GROUP BY 1, 2"""))
def _(d):
    result = spots.per_spot(d.nuclei, hex_grid(d), hex_info(d), "square", 2, quantities=Q2)
    return rounded(result, *[c for c in result.columns if c.startswith(("density", "average", "std"))])


@query("spot_long", sql("slides nuclei", f"""WITH {SPOT_SQL} SELECT sample, barcode, cell_type, quantity, count(*) AS n,
    round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std
    FROM (SELECT sample, barcode, cell_type, unnest(['area', 'orientation']) AS quantity, unnest([area, orientation]) AS v FROM cells)
    GROUP BY 1, 2, 3, 4"""))
def _(d):
    return rounded(spots.spot_long(spot_cells(d), Q2), "mean", "std")


@query("relabel_low_prob", sql("nuclei", f"""SELECT sample, ids, CASE WHEN cell_type_prob < {num(0.75)} THEN 'no_label' ELSE cell_type END AS cell_type FROM nuclei"""))
def _(d):
    return nuclei.relabel_low_prob(d.nuclei).select("sample", "ids", "cell_type")


@query("label_cell_types", sql("nuclei", """SELECT sample, ids, CASE CAST(ids AS BIGINT) % 7 WHEN 0 THEN 'no_label' WHEN 1 THEN 'neoplasia'
    WHEN 2 THEN 'inflammatory' WHEN 3 THEN 'connective' WHEN 4 THEN 'necrosis' WHEN 5 THEN 'no_neoplasia' ELSE '6' END AS cell_type FROM nuclei"""))
def _(d):
    coded = d.nuclei.withColumn("cell_type", (F.col("ids").cast("long") % 7).cast("int"))
    return nuclei.label_cell_types(coded).select("sample", "ids", "cell_type")


@query("tile_type_counts", sql("nuclei", f"""SELECT sample, concat('t', CAST(ids AS BIGINT) % 100) AS tile,
    {over_classes("count(*) FILTER (WHERE cell_type = '{c}' AND cell_type_prob >= " + num(0.75) + ") AS {c}")} FROM nuclei GROUP BY 1, 2"""))
def _(d):
    tiled = d.nuclei.withColumn("tile", F.concat(F.lit("t"), (F.col("ids").cast("long") % 100).cast("string")))
    return spots.tile_type_counts(tiled)


@query("label_counts", sql("nuclei", "SELECT sample, cell_type, count(*) AS n FROM nuclei GROUP BY 1, 2"))
def _(d):
    return spots.label_counts(d.nuclei, ["sample"], "cell_type")


@query("ordered_classes", sql("nuclei", "SELECT DISTINCT cell_type FROM nuclei ORDER BY 1"))
def _(d):
    return spots.ordered_classes(d.nuclei, "cell_type")


@query("attach_morphometry", sql("slides nuclei", f"""WITH {SPOT_SQL}, s AS (SELECT sample, barcode, count(*) AS total_count FROM cells GROUP BY 1, 2)
    SELECT g.sample, g.barcode, g.array_row, total_count FROM grid g LEFT JOIN s USING (sample, barcode)"""))
def _(d):
    obs = hex_grid(d).select("sample", "barcode", "array_row")
    return assignment.attach_morphometry(obs, spots.spot_totals(spot_cells(d)))


@query("attach_spatial", sql("slides nuclei", f"""WITH {SPOT_SQL}, s AS (SELECT sample, barcode, count(*) AS total_count FROM cells GROUP BY 1, 2)
    SELECT s.*, pxl_col_in_fullres AS spatial_x, pxl_row_in_fullres AS spatial_y FROM s LEFT JOIN grid g USING (sample, barcode)"""))
def _(d):
    return assignment.attach_spatial(spots.spot_totals(spot_cells(d)), hex_grid(d))


@query("join_on_sample", sql("slides nuclei", "SELECT sample, ids, x, y FROM nuclei JOIN slides USING (sample)"))
def _(d):
    return assignment.join_on_sample(d.nuclei.select("sample", "ids"), d.slides.select("sample", "x", "y"), ["ids"])


@query("drop_listed", sql("slides nuclei", """SELECT sample, ids FROM nuclei n WHERE NOT EXISTS (
    SELECT 1 FROM slides s WHERE s.sample = n.sample AND s.x < 3000)"""))
def _(d):
    return grid.drop_listed(d.nuclei.select("sample", "ids"), d.slides.where("x < 3000"), ["sample"])


# -------------------------------------------------------------------- contours

# A triangle, rectangle, pentagon or point per event, some clockwise.
SHAPES_SQL = """shapes AS (
    SELECT concat('S', user_id % 10) AS sample, concat('', event_id) AS ids, event_id, event_id % 5 AS kind,
           (event_id * 7919) % 290 AS ox, (event_id * 104729) % 306 AS oy, 2 + event_id % 7 AS w, 2 + event_id % 4 AS h
    FROM events),
  corners AS (
    SELECT sample, ids, kind, i, ox + CASE
        WHEN kind = 0 THEN [0, w, w, 0][i + 1] WHEN kind = 1 THEN [0, 0, w, w][i + 1]
        WHEN kind = 2 THEN [0, 2 * w, w][i + 1] WHEN kind = 3 THEN [0, w, w + 3, w, 0][i + 1] ELSE 0 END AS px,
      oy + CASE
        WHEN kind = 0 THEN [0, 0, h, h][i + 1] WHEN kind = 1 THEN [0, h, h, 0][i + 1]
        WHEN kind = 2 THEN [0, h, 3 * h][i + 1] WHEN kind = 3 THEN [0, 0, h, 2 * h, 2 * h][i + 1] ELSE 0 END AS py,
      [4, 4, 3, 5, 1][kind + 1] AS n
    FROM shapes, range(0, 5) r(i) WHERE i < [4, 4, 3, 5, 1][kind + 1]),
  edges AS (
    SELECT a.sample, a.ids, a.i, a.n, a.px AS x, a.py AS y, b.px AS u, b.py AS v
    FROM corners a JOIN corners b ON a.ids = b.ids AND b.i = (a.i + 1) % a.n)"""

MOMENTS_SQL = f"""{SHAPES_SQL},
  raw AS (
    SELECT sample, ids, sum(sqrt((u - x) * (u - x) + (v - y) * (v - y))) AS perimeter,
      sum((x * v - u * y) / 2) AS m00, sum((x * v - u * y) * (x + u) / 6) AS m10, sum((x * v - u * y) * (y + v) / 6) AS m01,
      sum((x * v - u * y) * (x * x + x * u + u * u) / 12) AS m20,
      sum((x * v - u * y) * (2 * x * y + x * v + u * y + 2 * u * v) / 24) AS m11,
      sum((x * v - u * y) * (y * y + y * v + v * v) / 12) AS m02
    FROM edges GROUP BY 1, 2),
  signed AS (
    SELECT sample, ids, perimeter, abs(m00) AS area, nullif(abs(m00), 0) AS a, sign(m00) * m10 AS p, sign(m00) * m01 AS q,
      sign(m00) * m20 AS m20, sign(m00) * m11 AS m11, sign(m00) * m02 AS m02 FROM raw),
  central AS (
    SELECT *, (m20 - p * p / a) / a AS c20, (m11 - p * q / a) / a AS c11, (m02 - q * q / a) / a AS c02 FROM signed),
  shaped AS (
    SELECT *, (c20 + c02) / 2 AS s, 0.5 * sqrt(4 * c11 * c11 + (c20 - c02) * (c20 - c02)) AS g FROM central)"""


def shapes(d):
    """Contours of the shapes above."""
    e = F.col("event_id")
    ox, oy = (e * 7919) % 290, (e * 104729) % 306
    w, h = 2 + e % 7, 2 + e % 4
    zero = F.lit(0).cast("long")

    def contour(xs, ys):
        return F.array(*[F.array((ox + a).cast("int"), (oy + b).cast("int")) for a, b in zip(xs, ys)])

    kind = e % 5
    outline = (
        F.when(kind == 0, contour((zero, w, w, zero), (zero, zero, h, h)))
        .when(kind == 1, contour((zero, zero, w, w), (zero, h, h, zero)))
        .when(kind == 2, contour((zero, 2 * w, w), (zero, h, 3 * h)))
        .when(kind == 3, contour((zero, w, w + 3, w, zero), (zero, zero, h, 2 * h, 2 * h)))
        .otherwise(contour((zero,), (zero,)))
    )
    return d.events.select(
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("sample"),
        e.cast("string").alias("ids"),
        F.array(ox.cast("double"), oy.cast("double")).alias("centroid"),
        outline.alias("contour"),
        ((e * 37) % 101 / 100).alias("type_prob"),
        (e % 6).cast("int").alias("type"),
    )


@query("contour_area", f"WITH {MOMENTS_SQL} SELECT sample, ids, round(perimeter, 6) AS perimeter_length, round(area, 6) AS area FROM shaped")
def _(d):
    m = C.contour_moments(F.col("contour"))
    return shapes(d).select(
        "sample", "ids", F.round(C.contour_perimeter(F.col("contour")), 6).alias("perimeter_length"), F.round(m["m00"], 6).alias("area")
    )


# Orientation hangs on the difference of two near-equal numbers for squares, so
# those are left to the unit tests; eccentricity is compared at four digits.
@query("contour_shape", f"""WITH {MOMENTS_SQL} SELECT sample, ids, round(area, 6) AS area,
    CASE WHEN abs(c20 - c02) > {num(1e-6)} THEN round(degrees(0.5 * atan(2 * c11 / (c20 - c02))), 4) END AS orientation,
    CASE WHEN g > {num(1e-6)} THEN round(sqrt(1 - (s - g) / (s + g)), 4) END AS eccentricity,
    round(4 * pi() * area / nullif(perimeter * perimeter, 0), 6) AS circularity FROM shaped""")
def _(d):
    m = C.contour_moments(F.col("contour"))
    found = nuclei.measure_nuclei(shapes(d)).join(shapes(d).select("ids", m.alias("m")), "ids")
    a = F.when(F.col("m.m00") > 0, F.col("m.m00"))
    c20 = (F.col("m.m20") - F.col("m.m10") * F.col("m.m10") / a) / a
    c02 = (F.col("m.m02") - F.col("m.m01") * F.col("m.m01") / a) / a
    c11 = (F.col("m.m11") - F.col("m.m10") * F.col("m.m01") / a) / a
    gap = 0.5 * F.sqrt(4 * c11 * c11 + (c20 - c02) * (c20 - c02))
    return found.select(
        "sample", "ids", F.round("area", 6).alias("area"),
        F.when(F.abs(c20 - c02) > 1e-6, F.round("orientation", 4)).alias("orientation"),
        F.when(gap > 1e-6, F.round("eccentricity", 4)).alias("eccentricity"),
        F.round("circularity", 6).alias("circularity"),
    )


@query("load_nuclei", f"""WITH {MOMENTS_SQL} SELECT m.sample, m.ids, CAST(ox AS INT) AS centroid_x, CAST(oy AS INT) AS centroid_y,
    CAST(event_id % 6 AS INT) AS cell_type, (event_id * 37) % 101 / 100 AS cell_type_prob,
    round(perimeter, 6) AS perimeter_length, round(area, 6) AS area FROM shaped m JOIN shapes USING (sample, ids)""")
def _(d):
    return rounded(
        nuclei.measure_nuclei(shapes(d)).drop("orientation", "eccentricity", "circularity"), "perimeter_length", "area"
    )


DENSE_SQL = f"""{SHAPES_SQL},
    walked AS (SELECT *, greatest(abs(u - x), abs(v - y)) AS l FROM edges),
    dense AS (SELECT sample, ids, i, t, CASE WHEN t = l THEN u ELSE floor(x + t * ((u - x) / l)) END AS cx,
            CASE WHEN t = l THEN v ELSE floor(y + t * ((v - y) / l)) END AS cy
        FROM walked, range(0, 40) r(t) WHERE t <= l AND t >= CASE WHEN i = n - 1 THEN 0 ELSE 1 END),
    placed AS (SELECT sample, ids, CAST(row_number() OVER (PARTITION BY ids ORDER BY i, t) - 1 AS INT) AS pos,
            CAST(cx AS INT) AS cx, CAST(cy AS INT) AS cy FROM dense)"""


@query("contour_close", f"WITH {DENSE_SQL} SELECT * FROM placed")
def _(d):
    return shapes(d).select("sample", "ids", F.posexplode(C.close_contour(F.col("contour"))).alias("pos", "p")).select(
        "sample", "ids", "pos", F.col("p")[0].alias("cx"), F.col("p")[1].alias("cy")
    )


@query("contour_minimize", f"""WITH {DENSE_SQL}, sized AS (SELECT *, count(*) OVER (PARTITION BY ids) AS n FROM placed),
    around AS (SELECT c.sample, c.ids, c.pos, c.cx, c.cy, p.cx AS ax, p.cy AS ay, q.cx AS bx, q.cy AS by_
      FROM sized c JOIN sized p ON p.ids = c.ids AND p.pos = (c.pos + c.n - 1) % c.n
      JOIN sized q ON q.ids = c.ids AND q.pos = (c.pos + 1) % c.n)
    SELECT sample, ids, CAST(row_number() OVER (PARTITION BY ids ORDER BY pos) - 1 AS INT) AS pos, cx, cy FROM around
    WHERE NOT (abs(ax - bx) = abs(ay - by_) AND abs(ax - bx) >= 2)
      AND NOT (abs(ax - bx) >= 2 AND ay = by_ AND ay = cy) AND NOT (abs(ay - by_) >= 2 AND ax = bx AND ax = cx)""")
def _(d):
    thin = C.minimize_contour(C.close_contour(F.col("contour")))
    return shapes(d).select("sample", "ids", F.posexplode(thin).alias("pos", "p")).select(
        "sample", "ids", "pos", F.col("p")[0].alias("cx"), F.col("p")[1].alias("cy")
    )


@query("contour_raster", f"""WITH {SHAPES_SQL},
    box AS (SELECT sample, ids, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM edges GROUP BY 1, 2),
    cells AS (SELECT sample, ids, x0 + i AS px, y0 + j AS py FROM box, range(0, 40) a(i), range(0, 40) b(j) WHERE x0 + i <= x1 AND y0 + j <= y1),
    tested AS (SELECT c.sample, c.ids, px, py,
        bool_or((u - x) * (py - y) = (v - y) * (px - x) AND px BETWEEN least(x, u) AND greatest(x, u) AND py BETWEEN least(y, v) AND greatest(y, v)) AS border,
        count(*) FILTER (WHERE (y > py) <> (v > py) AND px < (u - x) * (py - y) / nullif(v - y, 0) + x) % 2 = 1 AS inside
      FROM cells c JOIN edges e USING (sample, ids) GROUP BY 1, 2, 3, 4)
    SELECT sample, CAST(px AS INT) AS x, CAST(py AS INT) AS y, CAST(max(ids) AS BIGINT) + 1 AS label FROM tested WHERE border OR inside GROUP BY 1, 2, 3""")
def _(d):
    return nuclei.rasterize_nuclei(shapes(d))


@query("auto_offset", sql("nuclei", f"SELECT sample, CAST(trunc(quantile_cont(sqrt(area), {num(0.99)}) * 2) AS INT) AS \"offset\" FROM nuclei GROUP BY 1"))
def _(d):
    return nuclei.auto_offset(d.nuclei)


@query("round_even", sql("slides", "SELECT sample, CAST(round_even(x / 8, 0) AS INT) AS rounded FROM slides"))
def _(d):
    return d.slides.select("sample", round_even(F.col("x") / 8).cast("int").alias("rounded"))
