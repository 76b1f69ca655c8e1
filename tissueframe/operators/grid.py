"""Tile grids: generation, rescaling, choice of source, windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.functions.scalar import round_even, tile_id, trunc_int
from tissueframe.plans.skew import attach


def grid_info(
    slides: DataFrame,
    grid_type: str = "hex",
    factor: float = 64 / 39,
    magnification: float = 40.0,
    resolution: float = 294 / 65,
    spot_diameter: float = 65,
    spot_spacing: float = 100,
    aspect: float = 0.95,
) -> DataFrame:
    """One row per slide (``sample, x, y``) with the grid geometry in pixels."""
    if grid_type not in ("hex", "square"):
        raise ValueError(f"grid type must be hex or square, not {grid_type}")
    tile = resolution * spot_diameter * magnification / 40.0
    dx = resolution * spot_spacing * magnification / 40.0
    dy = 0.5 * factor * dx / aspect if grid_type == "hex" else dx
    return slides.select(
        "sample",
        "x",
        "y",
        F.lit(grid_type).alias("grid_type"),
        F.lit(float(factor)).alias("factor"),
        F.lit(float(magnification)).alias("magnification"),
        F.lit(float(resolution)).alias("resolution"),
        F.lit(float(aspect)).alias("aspect_correction"),
        F.lit(float(spot_diameter)).alias("spot_diamter"),
        F.lit(float(spot_spacing)).alias("spot_horizontal_spacing"),
        F.lit(float(tile)).alias("spot_diameter_fullres"),
        F.lit(float(dx)).alias("dx"),
        F.lit(float(dy)).alias("dy"),
    )


def make_grid(slides: DataFrame, grid_type: str = "hex", **geometry) -> DataFrame:
    """Tile centres of every slide, numbered down the columns.

    Both bounds tests are monotone in the column and the row, so the number of
    tiles in front of a tile follows from three counts per slide. The whole
    operator is therefore map-only: slides explode to columns, columns to rows,
    and no window or shuffle numbers the tiles, however large a slide is.
    """
    info = grid_info(slides, grid_type, **geometry)
    half = F.col("spot_diameter_fullres") / 2
    shift = 0.5 * F.col("dx") if grid_type == "hex" else F.lit(0.0)

    def column_x(i: Column, odd: bool) -> Column:
        start = half + i * F.col("dx")
        return trunc_int(start + shift if odd else start)

    def row_y(j: Column) -> Column:
        return trunc_int(half + j * F.col("dy"))

    def fitting(count: Column, centre, limit: Column) -> Column:
        """How many of the first ``count`` positions pass the bounds test."""
        inside = F.filter(
            F.sequence(F.lit(0), count - 1), lambda i: centre(i) + half <= limit
        )
        return F.when(count > 0, F.size(inside)).otherwise(F.lit(0))

    columns = F.ceil(F.col("x") / F.col("dx")).cast("int")
    rows = F.ceil(F.col("y") / F.col("dy")).cast("int")
    counted = info.select(
        "*",
        fitting(columns, lambda i: column_x(i, False), F.col("x")).alias("_even"),
        fitting(columns, lambda i: column_x(i, True), F.col("x")).alias("_odd"),
        fitting(rows, row_y, F.col("y")).alias("_rows"),
    ).where((F.col("_even") > 0) & (F.col("_rows") > 0))
    placed = counted.withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("_even") - 1))
    ).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)))
    i, j = F.col("i"), F.col("j")
    is_odd = j % 2 == 1
    placed = placed.where(~is_odd | (i < F.col("_odd")))
    even_rows = F.ceil(F.col("_rows") / 2)
    odd_rows = F.floor(F.col("_rows") / 2)
    in_front = F.least(i, F.col("_even")) * even_rows + F.least(i, F.col("_odd")) * odd_rows
    within = F.when(i < F.col("_odd"), j).otherwise(F.floor(j / 2))
    return placed.select(
        "sample",
        tile_id(in_front + within + 1).alias("barcode"),
        F.lit(1).alias("in_tissue"),
        j.alias("array_row"),
        i.alias("array_col"),
        row_y(j).alias("pxl_row_in_fullres"),
        F.when(is_odd, column_x(i, True)).otherwise(column_x(i, False)).alias("pxl_col_in_fullres"),
        (in_front + within + 1).cast("long").alias("grid_ord"),
    )


def rescale_grid(
    grid: DataFrame, info: DataFrame, samples: DataFrame, target_mpp: float = 0.25
) -> tuple[DataFrame, DataFrame]:
    """Aligner grid and its diameter moved to the target resolution.

    ``samples`` gives ``mpp`` per sample. Coordinates are truncated, the spot
    diameter keeps its fraction. Returns the new grid and the new grid info.
    """
    ratio = samples.select("sample", (F.col("mpp") / F.lit(target_mpp)).alias("_f"))
    scaled = attach(grid, ratio, ["sample"], "inner", spread=["barcode"])
    for name in ("pxl_row_in_fullres", "pxl_col_in_fullres"):
        scaled = scaled.withColumn(name, trunc_int(F.col(name) * F.col("_f")))
    wide = info.join(ratio, "sample").withColumn(
        "spot_diameter_fullres", F.col("spot_diameter_fullres") * F.col("_f")
    )
    return scaled.drop("_f"), wide.drop("_f")


FULL_SLIDE = {"0": (0.0, 1.0), "1": (0.0, 1.0)}


def resolve_grid(
    sheet: DataFrame,
    provided: DataFrame,
    aligner: DataFrame,
    generated: DataFrame,
    use_provided_grid: bool = True,
) -> DataFrame:
    """Pick one grid per sample and say where it came from.

    The sheet's grid is taken when the sheet names one and it is allowed, else
    the aligner's, else the generated one. ``source`` is ``sheet``, ``aligner``
    or ``new``; aligner grids also force the full slide (``full_roi``).
    The three inputs are tagged and filtered by one lookup, not joined pairwise.
    """
    has_aligner = aligner.select("sample").distinct().withColumn("_aligned", F.lit(True))
    wants = F.lit(use_provided_grid) & F.col("grid").isNotNull()
    choice = sheet.join(has_aligner, "sample", "left").select(
        "sample",
        F.when(wants, "sheet").when(F.col("_aligned"), "aligner").otherwise("new").alias("source"),
    )
    tagged = (
        provided.withColumn("source", F.lit("sheet"))
        .unionByName(aligner.withColumn("source", F.lit("aligner")))
        .unionByName(generated.withColumn("source", F.lit("new")), allowMissingColumns=True)
    )
    picked = attach(tagged, choice, ["sample", "source"], "inner", spread=["barcode"])
    return picked.withColumn("full_roi", F.col("source") == "aligner")


def in_tissue(df: DataFrame) -> DataFrame:
    """Rows flagged as tissue; NULL counts as not in tissue."""
    return df.where(F.col("in_tissue") == 1)


def expand_factors(tiles: DataFrame, factors: Sequence[float]) -> DataFrame:
    """Each row once per expansion factor."""
    values = F.array(*[F.lit(float(f)) for f in factors])
    return tiles.withColumn("expansion_factor", F.explode(values))


def tile_windows(
    grid: DataFrame,
    info: DataFrame,
    factor: float | Column = 1.0,
    downsample: bool = True,
) -> DataFrame:
    """Pixel window of each tile: ``x0, y0, side`` to read, ``stride`` and ``out`` size.

    The spot diameter is rounded half to even. With downsampling an expanded
    window is read at the factor rounded up and thinned by it; without, the
    window itself grows.
    """
    f = F.lit(float(factor)) if not isinstance(factor, Column) else factor
    spots = attach(
        grid, info.select("sample", "spot_diameter_fullres"), ["sample"], "inner", spread=["barcode"]
    )
    base = round_even(F.col("spot_diameter_fullres"))
    thin = (f != 1.0) & F.lit(downsample)
    stride = F.when(thin, F.ceil(f)).otherwise(F.lit(1))
    out = F.when(thin, base).otherwise(round_even(base * f))
    sized = spots.withColumn("stride", stride.cast("int")).withColumn("out", out.cast("int"))
    sized = sized.withColumn("side", F.col("out") * F.col("stride"))
    half = F.col("side") / 2
    return (
        sized.withColumn("x0", trunc_int(F.col("pxl_col_in_fullres") - half))
        .withColumn("y0", trunc_int(F.col("pxl_row_in_fullres") - half))
        .drop("spot_diameter_fullres")
    )


# The five sub-tile centres.
SUBTILES = ((1, 1), (3, 1), (2, 2), (1, 3), (3, 3))


def subtile_windows(
    tiles: DataFrame,
    coords: Sequence[tuple[int, int]] = SUBTILES,
    factor: int = 4,
    compat: bool = True,
) -> DataFrame:
    """Overlapping sub-windows of each window, numbered by ``subtile``.

    Sub-window (i, j) spans two steps of ``side // factor`` around step i. With
    ``compat`` both axes use i, as the reference pipeline does; otherwise the
    horizontal axis uses j.
    """
    listed = F.array(
        *[
            F.struct(F.lit(n).alias("n"), F.lit(i).alias("i"), F.lit(j).alias("j"))
            for n, (i, j) in enumerate(coords)
        ]
    )
    step = F.floor(F.col("side") / factor).cast("int")
    along_x = F.col("_s.i") if compat else F.col("_s.j")
    return (
        tiles.withColumn("_s", F.explode(listed))
        .withColumn("subtile", F.col("_s.n"))
        .withColumn("sub_y0", F.col("y0") + step * (F.col("_s.i") - 1))
        .withColumn("sub_x0", F.col("x0") + step * (along_x - 1))
        .withColumn("sub_side", 2 * step)
        .drop("_s")
    )


def override_mask(grid: DataFrame, mask: DataFrame) -> DataFrame:
    """Take ``in_tissue`` from the tile mask where the grid was newly made.

    ``grid`` carries ``source``; a tile missing in the mask becomes NULL, which
    counts as not in tissue.
    """
    flags = mask.select("sample", "barcode", F.col("in_tissue").alias("_mask"))
    joined = grid.join(flags, ["sample", "barcode"], "left")
    fresh = F.when(F.col("source") == "new", F.col("_mask")).otherwise(F.col("in_tissue"))
    return joined.withColumn("in_tissue", fresh).drop("_mask")


def keep_listed(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(keys.select(*on), list(on), "left_semi")


def drop_listed(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed."""
    return df.join(keys.select(*on), list(on), "left_anti")


def sample_tiles(grid: DataFrame, n: int = 100, seed: int = 0) -> DataFrame:
    """Up to ``n`` in-tissue tiles per slide, by a seeded hash of the barcode.

    The draw is the same on every run and every partitioning.
    """
    from tissueframe.plans.ranking import first_per_key

    lottery = in_tissue(grid).withColumn("_draw", F.xxhash64("sample", "barcode", F.lit(seed)))
    order = [F.col("_draw"), F.col("barcode")]
    return first_per_key(lottery, ["sample"], order, n, "_rn").drop("_draw", "_rn")
