"""Nuclei to spots, superpixels and samples: keyed and spatial joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.functions.scalar import squared_distance
from tissueframe.plans.cells import cell_of, cover
from tissueframe.plans.skew import attach
from tissueframe.plans.spread import spread


def _spot_cells(grid: DataFrame, info: DataFrame, factor: float) -> DataFrame:
    """Spots by the cells their reach touches, one row per cell.

    Of spots with the same centre only the first in grid order can ever be
    nearest, so the others are dropped before cells are gathered. A cell is one
    reach wide, so it meets only the spots around it.
    """
    sized = info.select("sample", (F.col("spot_diameter_fullres") * F.lit(float(factor))).alias("_side"))
    spots = attach(grid, sized, ["sample"], "inner", spread=["barcode"])
    centres = spots.groupBy("sample", "_side", "pxl_col_in_fullres", "pxl_row_in_fullres").agg(
        F.min("grid_ord").alias("ord"), F.min_by("barcode", "grid_ord").alias("barcode")
    )
    px, py = F.col("pxl_col_in_fullres"), F.col("pxl_row_in_fullres")
    half = F.col("_side") / 2
    covered = cover(centres, (px - half, px + half), (py - half, py + half), F.col("_side"))
    return covered.groupBy("sample", "cx", "cy").agg(
        F.collect_list(
            F.struct(px.alias("px"), py.alias("py"), F.col("ord"), F.col("barcode"))
        ).alias("_near")
    )


def _assign(
    nuclei: DataFrame,
    grid: DataFrame,
    info: DataFrame,
    factor: float,
    within,
    keep_unassigned: bool,
) -> DataFrame:
    sized = info.select("sample", (F.col("spot_diameter_fullres") * F.lit(float(factor))).alias("_side"))
    placed = attach(spread(nuclei, "sample", "ids"), sized, ["sample"], "inner" if not keep_unassigned else "left", spread=["ids"])
    x, y, side = F.col("centroid_x").cast("long"), F.col("centroid_y").cast("long"), F.col("_side")
    placed = placed.withColumn("cx", cell_of(x, side)).withColumn("cy", cell_of(y, side))
    cells = _spot_cells(grid, info, factor)
    met = attach(placed, cells, ["sample", "cx", "cy"], "left" if keep_unassigned else "inner", spread=["ids"])
    reach = F.filter("_near", lambda s: within(s, x, y, side))
    ranked = F.transform(
        reach,
        lambda s: F.struct(
            squared_distance(s["px"], s["py"], x, y).alias("d2"),
            s["ord"].alias("ord"),
            s["barcode"].alias("barcode"),
        ),
    )
    result = met.withColumn("barcode", F.array_min(ranked)["barcode"])
    if not keep_unassigned:
        result = result.where(F.col("barcode").isNotNull())
    return result.drop("_near", "_side", "cx", "cy")


def assign_square(
    nuclei: DataFrame, grid: DataFrame, info: DataFrame, factor: float = 1, keep_unassigned: bool = True
) -> DataFrame:
    """Nearest spot among those whose square holds the nucleus, borders included.

    Ties go to the first spot in grid order; nuclei without a spot get NULL.
    """

    def within(s: Column, x: Column, y: Column, side: Column) -> Column:
        return (F.abs(s["px"] - x) <= side / 2) & (F.abs(s["py"] - y) <= side / 2)

    return _assign(nuclei, grid, info, factor, within, keep_unassigned)


def assign_circle(
    nuclei: DataFrame, grid: DataFrame, info: DataFrame, factor: float = 1, keep_unassigned: bool = True
) -> DataFrame:
    """Nearest spot of all, kept when the nucleus lies within its radius.

    If any spot lies within the radius then so does the nearest, hence only the
    spots within reach are candidates.
    """

    def within(s: Column, x: Column, y: Column, side: Column) -> Column:
        d = F.sqrt(squared_distance(s["px"], s["py"], x, y).cast("double"))
        return d <= side / 2

    return _assign(nuclei, grid, info, factor, within, keep_unassigned)


def assign_superpixel(nuclei: DataFrame, labels: DataFrame, factor: int = 4) -> DataFrame:
    """Label of the raster cell under each nucleus, at the raster's scale."""
    placed = nuclei.withColumn("xd", (F.col("x") / factor).cast("int")).withColumn(
        "yd", (F.col("y") / factor).cast("int")
    )
    raster = labels.select(
        "sample", F.col("x").alias("xd"), F.col("y").alias("yd"), F.col("label").alias("uspx")
    )
    return placed.join(raster, ["sample", "xd", "yd"], "left")


def join_on_sample(left: DataFrame, right: DataFrame, spread: list[str] | None = None) -> DataFrame:
    """Inner join of stage outputs; samples missing on one side drop out.

    ``right`` holds one row per sample; ``spread`` deals the rows of a large
    sample of ``left`` over several tasks.
    """
    return attach(left, right, ["sample"], "inner", spread=spread or [])


def attach_by_barcode(obs: DataFrame, other: DataFrame) -> DataFrame:
    """Left join of per-spot columns, keeping every row of ``obs``."""
    return obs.join(other, ["sample", "barcode"], "left")


def attach_morphometry(obs: DataFrame, spots: DataFrame) -> DataFrame:
    """Per-spot nuclear measures beside the feature rows."""
    return attach_by_barcode(obs, spots)


def attach_spatial(obs: DataFrame, grid: DataFrame) -> DataFrame:
    """Spatial coordinates (column, row) of each feature row."""
    place = grid.select(
        "sample",
        "barcode",
        F.col("pxl_col_in_fullres").alias("spatial_x"),
        F.col("pxl_row_in_fullres").alias("spatial_y"),
    )
    return attach_by_barcode(obs, place)


def pair_species(mouse: DataFrame, human: DataFrame) -> DataFrame:
    """Outputs of the two species of one sample side by side, prefixed."""
    def named(df, prefix):
        return df.select("sample", *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c != "sample"])

    return named(mouse, "mouse").join(named(human, "human"), "sample", "inner")
