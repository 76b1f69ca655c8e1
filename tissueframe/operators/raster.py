"""Pixel and label rasters as long tables: masks, crops, boundaries, morphology."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.functions.scalar import axis_scale, trunc_int
from tissueframe.plans import runs as R
from tissueframe.plans.skew import attach
from tissueframe.plans.spread import spread, spread_evenly

FOUR_NEIGHBOURS = ((1, 0), (-1, 0), (0, 1), (0, -1))


def channel_mean() -> Column:
    """Mean of the three channels."""
    return (F.col("r") + F.col("g") + F.col("b")) / 3


def pixel_mask(pixels: DataFrame, low: float = 100.0, high: float = 200.0) -> DataFrame:
    """Tissue flag: channel mean within ``[low, high]``."""
    inside = channel_mean().between(F.lit(low), F.lit(high))
    return pixels.select("sample", "x", "y", inside.cast("int").alias("in_tissue"))


def foreground(pixels: DataFrame, a: float = 80.0, b: float = 225.0) -> DataFrame:
    """Cells whose channel mean lies in ``[a, b]``; unit-range images scale the limits.

    The scale is a column ``unit`` of the input when it has one (see
    :func:`detect_scale`), else the 0-255 range is assumed.
    """
    scale = F.when(F.col("unit"), 1.0 / 255).otherwise(1.0) if "unit" in pixels.columns else F.lit(1.0)
    mean = channel_mean()
    return pixels.where((mean >= F.lit(a) * scale) & (mean <= F.lit(b) * scale)).select("sample", "x", "y")


def detect_scale(pixels: DataFrame) -> DataFrame:
    """Mark the pixels of slides whose largest value is at most 1 as unit range."""
    top = pixels.groupBy("sample").agg((F.max(F.greatest("r", "g", "b")) <= 1).alias("unit"))
    return attach(pixels, top, ["sample"], "inner", spread=["x", "y"])


def crop_roi(pixels: DataFrame, roi: DataFrame, meta: DataFrame) -> DataFrame:
    """Pixels inside the region of their slide, moved to its corner.

    ``roi`` has ``sample, roi`` (map of axis to location and size), ``meta`` has
    the slide's ``width, height``; a slide without a region is kept whole.
    """
    spans = roi_pixels(meta, roi).drop("width", "height")
    inside = attach(pixels, spans, ["sample"], "inner", spread=["x", "y"])
    x, y = F.col("x"), F.col("y")
    kept = inside.where(
        (x >= F.col("x0")) & (x < F.col("x0") + F.col("w")) & (y >= F.col("y0")) & (y < F.col("y0") + F.col("h"))
    )
    return kept.select("sample", (x - F.col("x0")).alias("x"), (y - F.col("y0")).alias("y"), "r", "g", "b")


def roi_pixels(meta: DataFrame, roi: DataFrame) -> DataFrame:
    """Region of each slide in pixels, truncated: ``x0, y0, w, h``."""
    joined = meta.join(roi, "sample", "left")

    def part(axis, field, whole):
        found = F.try_element_at(F.col("roi"), F.lit(axis))[field]
        return F.coalesce(found, F.lit(whole))

    return joined.select(
        "sample",
        "width",
        "height",
        trunc_int(F.col("width") * part("0", "location", 0.0)).alias("x0"),
        trunc_int(F.col("height") * part("1", "location", 0.0)).alias("y0"),
        trunc_int(F.col("width") * part("0", "size", 1.0)).alias("w"),
        trunc_int(F.col("height") * part("1", "size", 1.0)).alias("h"),
    )


def image_size_mp(meta: DataFrame, roi: DataFrame, whole: bool = False, resized: bool = False) -> DataFrame:
    """Megapixels per slide or region: rounded half to even, or cut after a resize."""
    spans = roi_pixels(meta, roi)
    w, h = ("width", "height") if whole else ("w", "h")
    size = F.col(w).cast("double") * F.col(h) / 1e6
    shown = F.floor(size) if resized else F.bround(size, 0)
    return spans.select("sample", shown.cast("long").alias("size_mp"))


def stride_downsample(pixels: DataFrame, f: int) -> DataFrame:
    """Every ``f``-th pixel of both axes."""
    kept = pixels.where((F.col("x") % f == 0) & (F.col("y") % f == 0))
    return kept.withColumn("x", (F.col("x") / f).cast("int")).withColumn("y", (F.col("y") / f).cast("int"))


def area_downsample(pixels: DataFrame, f: float) -> DataFrame:
    """Mean colour of the pixels that fall on each pixel of the smaller image."""
    return pixels.groupBy(
        "sample",
        F.floor(F.col("x") * F.lit(f)).cast("int").alias("x"),
        F.floor(F.col("y") * F.lit(f)).cast("int").alias("y"),
    ).agg(F.avg("r").alias("r"), F.avg("g").alias("g"), F.avg("b").alias("b"))


def patch_index(df: DataFrame, s: int, columns: Column | None = None) -> DataFrame:
    """Patch of each pixel: ``pi`` down, ``pj`` across, ``ipatch`` when ``columns`` is given.

    ``columns`` is the number of patch columns of the slide,
    ``width // s + 1`` as patches are cut.
    """
    cut = df.withColumn("pi", F.floor(F.col("y") / s).cast("int")).withColumn(
        "pj", F.floor(F.col("x") / s).cast("int")
    )
    if columns is None:
        return cut
    return cut.withColumn("ipatch", (F.col("pi") * columns + F.col("pj")).cast("int"))


def tile_pixels(grid: DataFrame, info: DataFrame, meta: DataFrame) -> DataFrame:
    """Each tile with the pixels of its half-open window at the scale of ``meta``.

    ``info`` has the slide's ``x, y, spot_diameter_fullres``; ``meta`` the small
    image's ``width, height``. Windows that begin left of or above the image are
    flagged ``outside`` and get no pixels.
    """
    scale = axis_scale(F.col("width"), F.col("height"), F.col("_fx"), F.col("_fy"))
    per_slide = (
        info.select("sample", F.col("x").alias("_fx"), F.col("y").alias("_fy"), "spot_diameter_fullres")
        .join(meta, "sample")
        .select("sample", scale.alias("_scale"), "spot_diameter_fullres", "width", "height")
    )
    tiles = attach(grid, per_slide, ["sample"], "inner", spread=["barcode"])
    cx = trunc_int(F.col("pxl_col_in_fullres") * F.col("_scale"))
    cy = trunc_int(F.col("pxl_row_in_fullres") * F.col("_scale"))
    half = trunc_int(F.col("spot_diameter_fullres") * F.col("_scale") / 2)
    windows = tiles.select("sample", "barcode", cx.alias("_cx"), cy.alias("_cy"), half.alias("_h"))
    x0, y0 = F.col("_cx") - F.col("_h"), F.col("_cy") - F.col("_h")
    usable = (x0 >= 0) & (y0 >= 0) & (F.col("_h") > 0)

    def span(low):
        return F.when(usable, F.sequence(low, low + 2 * F.col("_h") - 1))

    spread = windows.withColumn("x", F.explode_outer(span(x0)))
    return spread.withColumn("y", F.explode_outer(span(y0))).select("sample", "barcode", "x", "y")


def tile_mask(
    grid: DataFrame, info: DataFrame, mask: DataFrame, meta: DataFrame, fraction: float = 0.1
) -> DataFrame:
    """Tissue flag per tile: share of tissue pixels in its window at least ``fraction``.

    A window is a few pixels of the small image, so each tile is unrolled to its
    pixel keys and met by equality. A window without pixels gives 0.
    """
    wanted = tile_pixels(grid, info, meta)
    met = wanted.join(mask.select("sample", "x", "y", "in_tissue"), ["sample", "x", "y"], "left")
    share = F.avg(F.col("in_tissue").cast("double"))
    return met.groupBy("sample", "barcode").agg(
        F.coalesce((share >= F.lit(fraction)).cast("int"), F.lit(0)).alias("in_tissue")
    )


def _around(labels: DataFrame) -> DataFrame:
    """Each cell sent to itself and its four neighbours, in one shuffle's worth of rows."""
    targets = F.array(
        F.struct(F.lit(0).alias("dx"), F.lit(0).alias("dy")),
        *[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in FOUR_NEIGHBOURS],
    )
    sent = spread(labels, "sample", "x", "y").withColumn("_t", F.explode(targets))
    return sent.withColumn("x", F.col("x") + F.col("_t.dx")).withColumn("y", F.col("y") + F.col("_t.dy")).withColumn(
        "_self", (F.col("_t.dx") == 0) & (F.col("_t.dy") == 0)
    ).drop("_t")


def label_boundaries(labels: DataFrame) -> DataFrame:
    """Cells with a 4-neighbour of another label inside the raster.

    Cells send their label to their neighbours and one aggregation compares,
    which replaces four shifted self joins.
    """
    seen = _around(labels).groupBy("sample", "x", "y").agg(
        F.max(F.when(F.col("_self"), F.col("label"))).alias("label"),
        F.min("label").alias("_low"),
        F.max("label").alias("_high"),
    )
    return seen.where(
        F.col("label").isNotNull() & ((F.col("_low") != F.col("label")) | (F.col("_high") != F.col("label")))
    ).select("sample", "x", "y", "label")


def label_adjacency(labels: DataFrame) -> DataFrame:
    """Pairs of labels that share a border, with the border's length in cell sides."""
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, 0), (0, 1))])
    sent = labels.withColumn("_t", F.explode(steps)).select(
        "sample",
        (F.col("x") + F.col("_t.dx")).alias("x"),
        (F.col("y") + F.col("_t.dy")).alias("y"),
        F.col("label").alias("other"),
    )
    met = labels.join(sent, ["sample", "x", "y"]).where(F.col("label") != F.col("other"))
    return met.groupBy(
        "sample", F.least("label", "other").alias("label_a"), F.greatest("label", "other").alias("label_b")
    ).agg(F.count("*").alias("border"))


def expand_labels(labels: DataFrame, d: int, canvas: DataFrame, by: Sequence[str] = ("sample",)) -> DataFrame:
    """Empty cells of the raster within ``d`` of a label, with the nearest label (ties: smallest).

    ``labels`` lists the labelled cells only, all of them. ``canvas`` has one row
    per raster: ``width``, ``height`` and, if it does not begin at 0, ``x0`` and
    ``y0``; cells outside are not filled. The nearest label is
    found first along each row and then across rows, so a cell is sent to
    ``2 (2d + 1)`` places instead of to a whole disk. Labels keep their type. Distance and
    label share one BIGINT, in which ``d * d`` leaves room for labels below 2^59 at the usual
    three cells (2^48 at 181); a negative or larger label fails the job.
    """
    by = list(by)
    room = 63 - (d * d).bit_length()
    fits = F.col("label").between(F.lit(0), F.lit((1 << room) - 1))
    label = F.when(fits, F.col("label").cast("long")).otherwise(F.raise_error(F.lit("a label leaves no room for its distance")).cast("long"))
    bare = F.col("_k").bitwiseAND(F.lit((1 << room) - 1))
    steps = F.sequence(F.lit(-d), F.lit(d))
    own = spread(labels.select(*by, "x", "y", "label"), *by, "x", "y")
    sideways = own.withColumn("_dx", F.explode(steps)).select(
        *by, (F.col("x") + F.col("_dx")).alias("x"), "y", (F.abs("_dx").cast("long") * F.lit(1 << room) + label).alias("_k")
    )
    # Packed key: distance first, then label, so that one min() settles both.
    in_row = sideways.groupBy(*by, "x", "y").agg(F.min("_k").alias("_k"))
    in_row = in_row.select(*by, "x", "y", F.shiftright("_k", room).alias("_d1"), bare.alias("label"))
    across = in_row.withColumn("_dy", F.explode(steps))
    d2 = F.col("_d1") * F.col("_d1") + F.col("_dy") * F.col("_dy")
    across = across.where(d2 <= d * d).select(
        *by, "x", (F.col("y") + F.col("_dy")).alias("y"), (d2 * F.lit(1 << room) + F.col("label")).alias("_k")
    )
    nearest = across.groupBy(*by, "x", "y").agg(F.min("_k").alias("_k"))
    empty = nearest.where(F.shiftright("_k", room) > 0)
    origin = [F.col(c) if c in canvas.columns else F.lit(0) for c in ("x0", "y0")]
    edges = canvas.select(*by, origin[0].alias("_x0"), origin[1].alias("_y0"), F.col("width").alias("_w"), F.col("height").alias("_h"))
    empty = attach(empty, edges, by, "inner", spread=["x", "y"])
    empty = empty.where("x >= _x0 AND x < _x0 + _w AND y >= _y0 AND y < _y0 + _h")
    return empty.select(*by, "x", "y", bare.cast(labels.schema["label"].dataType).alias("label"))


def focus_score(pixels: DataFrame, tile: int) -> DataFrame:
    """Sharpness per square tile: variance of the Laplacian of the channel mean.

    Stands in for a trained focus network. Only pixels with all four neighbours
    count.
    """
    parts = F.array(
        F.struct(F.lit(0).alias("dx"), F.lit(0).alias("dy"), F.lit(-4).alias("w")),
        *[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(1).alias("w")) for dx, dy in FOUR_NEIGHBOURS],
    )
    grey = pixels.select("sample", "x", "y", (F.col("r") + F.col("g") + F.col("b")).alias("v"))
    sent = grey.withColumn("_p", F.explode(parts)).select(
        "sample",
        (F.col("x") + F.col("_p.dx")).alias("x"),
        (F.col("y") + F.col("_p.dy")).alias("y"),
        (F.col("v") * F.col("_p.w")).alias("v"),
    )
    laplace = sent.groupBy("sample", "x", "y").agg(F.sum("v").alias("v"), F.count("*").alias("n")).where("n = 5")
    return laplace.groupBy(
        "sample",
        F.floor(F.col("x") / tile).cast("int").alias("tx"),
        F.floor(F.col("y") / tile).cast("int").alias("ty"),
    ).agg(F.var_pop(F.col("v") / 3.0).alias("focus"), F.count("*").alias("n_pixels"))


def check_mask(thumb: DataFrame, mask: DataFrame, bc: float = 210.0) -> DataFrame:
    """Mask set to 1 everywhere on slides whose background is too dark.

    Background is the mean of the channel mean over pixels outside the mask. Mask
    and thumbnail may differ in size: a pixel takes the mask cell its centre falls
    into, which is what resizing and cutting at one half gives inside and outside.
    """
    def extent(df, width, height):
        return df.groupBy("sample").agg((F.max("x") + 1).alias(width), (F.max("y") + 1).alias(height))

    sizes = extent(thumb, "_tw", "_th").join(extent(mask, "_mw", "_mh"), "sample")
    placed = attach(thumb, sizes, ["sample"], "inner", spread=["x", "y"]).withColumns({
        "x": F.floor((2 * F.col("x") + 1) * F.col("_mw") / (2 * F.col("_tw"))).cast("int"),
        "y": F.floor((2 * F.col("y") + 1) * F.col("_mh") / (2 * F.col("_th"))).cast("int"),
    })
    both = placed.join(mask, ["sample", "x", "y"])
    shade = both.groupBy("sample").agg(
        F.avg(F.when(F.col("in_tissue") == 0, channel_mean())).alias("_background")
    )
    judged = attach(mask, shade, ["sample"], "left", spread=["x", "y"])
    dark = F.coalesce(F.col("_background") < F.lit(bc), F.lit(False))
    return judged.withColumn("in_tissue", F.when(dark, 1).otherwise(F.col("in_tissue"))).drop("_background")


def binarise_half_max(df: DataFrame, value: str, by: Sequence[str] = ("sample",)) -> DataFrame:
    """1 where the value reaches half of its maximum on the slide, else 0."""
    top = df.groupBy(*by).agg(F.max(value).alias("_top"))
    spread = [c for c in df.columns if c not in by and c != value]
    met = attach(df, top, list(by), "inner", spread=spread)
    return met.withColumn(value, (F.col(value) >= F.col("_top") / 2).cast("int")).drop("_top")


def tissue_mask(
    grid: DataFrame,
    info: DataFrame,
    square: bool = False,
    up: float = 1.5,
    chunk: int = 1000,
    kernel: int = 20,
) -> DataFrame:
    """Tissue mask of each slide from its in-tissue tiles, as cells ``(sample, x, y)``.

    Tiles become disks (or squares) of ``up`` diameters' radius on a canvas of
    at most ``chunk`` cells a side; the union is dilated, its holes are filled,
    and it is eroded again. A slide's tiles are drawn and merged as horizontal runs
    in the task that closes its canvas.
    """
    step = F.ceil(F.greatest("x", "y") / chunk).cast("int")
    canvas_info = info.select(
        "sample",
        step.alias("_f"),
        trunc_int(trunc_int(F.col("spot_diameter_fullres")) * up / step).alias("_r"),
        F.ceil(F.col("x") / step).cast("int").alias("width"),
        F.ceil(F.col("y") / step).cast("int").alias("height"),
    )
    canvas = canvas_info.select("sample", "width", "height")
    # Placed by slide while tiles are few; their runs stay there until the canvas is closed.
    tiles = spread_evenly(grid.where("in_tissue = 1"), "sample").join(canvas_info.select("sample", "_f", "_r"), "sample")
    cx = trunc_int(F.col("pxl_col_in_fullres") / F.col("_f"))
    cy = trunc_int(F.col("pxl_row_in_fullres") / F.col("_f"))
    low, high = (-F.col("_r"), F.col("_r") - 1) if square else (-(F.col("_r") - 1), F.col("_r") - 1)
    rows = tiles.where("_r > 0").select(
        "sample", cx.alias("_cx"), cy.alias("_cy"), "_r", F.explode(F.sequence(low, high)).alias("_dy")
    )
    if square:
        x0, x1 = F.col("_cx") - F.col("_r"), F.col("_cx") + F.col("_r") - 1
    else:
        # Widest dx with dx^2 + dy^2 < r^2; roots of whole squares are exact.
        rest = F.col("_r") * F.col("_r") - F.col("_dy") * F.col("_dy")
        reach = (F.ceil(F.sqrt(rest.cast("double"))) - 1).cast("int")
        x0, x1 = F.col("_cx") - reach, F.col("_cx") + reach
    drawn = rows.select("sample", (F.col("_cy") + F.col("_dy")).alias("y"), x0.alias("x0"), x1.alias("x1"))
    shape = R.merge_runs(R.clip(drawn, canvas))
    return R.runs_to_cells(R.close_canvas(shape, canvas, kernel))
