"""Superpixels: segmentation, ids, and the per-cell density report."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.functions.colour import rgb_to_lab
from tissueframe.operators.assignment import assign_superpixel
from tissueframe.operators.raster import patch_index
from tissueframe.operators.stain import MEASURES
from tissueframe.plans.quantile import exact_quantiles
from tissueframe.plans.skew import attach

# Id step between patches, and the level cells are scaled to.
PATCH_STEP = 10000
MEDIAN_LEVEL = 0.18


def patch_step(s: int, pixels_per_segment: int) -> int:
    """Step between the ids of two patches: the usual one, or the next power of ten that a patch's segments need."""
    side = max(1, round(pixels_per_segment**0.5))
    step = PATCH_STEP
    while step < math.ceil(s / side) ** 2:
        step *= 10
    return step


def superpixel_id(patch: Column, local: Column, step: int = PATCH_STEP) -> Column:
    """Slide-wide id of a patch's superpixel; ``local`` must stay below ``step``."""
    return (patch.cast("long") * step + local).cast("long")


def superpixel_patch(uspx: Column, compat: bool = False, step: int = PATCH_STEP) -> Column:
    """Patch of a superpixel id. ``compat`` divides by 1000 as the reference does."""
    return F.floor(uspx / (1000 if compat else step)).cast("int")


def superpixel_sizes(labels: DataFrame) -> DataFrame:
    """Raster cells per label."""
    return labels.groupBy("sample", "label").agg(F.count("*").alias("n_cells"))


def attach_superpixel_size(cells: DataFrame, labels: DataFrame, factor: int = 4) -> DataFrame:
    """Full-resolution area of each cell's superpixel."""
    sizes = superpixel_sizes(labels).select(
        "sample", F.col("label").alias("uspx"), (F.col("n_cells") * factor * factor).alias("spx_size")
    )
    return attach(cells, sizes, ["sample", "uspx"], "left", spread=["ids"])


def median_normalise(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("sample",), level: float = MEDIAN_LEVEL
) -> DataFrame:
    """Scale columns so that their median per group becomes ``level``.

    All columns are unrolled to one long column first, so one quantile job
    serves them all.
    """
    by = list(by)
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(*by, F.explode(pairs).alias("_p")).select(*by, "_p.k", "_p.v")
    medians = exact_quantiles(long, [*by, "k"], "v", {"m": 0.5})
    wide = medians.groupBy(*by).agg(*[F.max(F.when(F.col("k") == c, F.col("m"))).alias(f"_m_{c}") for c in columns])
    spread = [c for c in df.columns if c not in by]
    met = attach(df, wide, by, "left", spread=spread)
    scaled = {c: F.try_divide(F.col(c) * F.lit(level), F.col(f"_m_{c}")) for c in columns}
    return met.withColumns(scaled).drop(*[f"_m_{c}" for c in columns])


def od_per_cell(
    cells: DataFrame, labels: DataFrame, factor: int = 4, compat: bool = False, by: Sequence[str] = ("sample",), step: int = PATCH_STEP
) -> DataFrame:
    """Per-cell density report: superpixel, its patch and size, scaled measures.

    The scaling is over the whole slide; pass ``by=("sample", "ipatch")`` for
    patch-wise scaling. ``step`` is the id step the labels were made with.
    """
    placed = assign_superpixel(cells, labels, factor)
    placed = placed.withColumn("ipatch", superpixel_patch(F.col("uspx"), compat, step))
    scaled = median_normalise(placed, MEASURES, by)
    return attach_superpixel_size(scaled, labels, factor)


def order_by_numeric_id(df: DataFrame, column: str = "ids") -> DataFrame:
    """Global order by the number a text id stands for."""
    return df.orderBy("sample", F.col(column).cast("long"))


def superpixels(
    pixels: DataFrame,
    meta: DataFrame,
    s: int = 2048,
    pixels_per_segment: int = 10000,
    compactness: float = 1.0,
    rounds: int = 10,
) -> DataFrame:
    """Superpixel label of every pixel: k-means in colour and place, by patch.

    Stands in for the sequential priority-queue segmentation. Seeds lie on a
    square lattice of about ``pixels_per_segment`` cells; a pixel only compares
    the nine seeds around its own lattice cell. Costs are compared in
    millionths, equal ones go to the first seed of the lattice, and a seed that
    lost all pixels keeps its place. ``meta`` has the slide's ``width``.
    The number of ``rounds`` is the method's own parameter, as in the published
    k-means form: labels are the nearest seeds after that many moves.

    Pixels are shuffled once. A patch stays in one task through all rounds; it
    has at most ``s`` x ``s`` pixels of five numbers however large the slide is
    (about half a gigabyte of working arrays at 2048).
    """
    side = max(1, round(pixels_per_segment**0.5))
    keys = ["sample", "pi", "pj"]
    lab = rgb_to_lab(F.col("r"), F.col("g"), F.col("b"))
    wide = attach(pixels, meta.select("sample", "width"), ["sample"], "inner", spread=["x", "y"])
    cut = patch_index(wide, s).withColumn("_lab", lab)
    points = cut.select(*keys, "width", "x", "y", F.col("_lab.l").alias("l"), F.col("_lab.a").alias("a"), F.col("_lab.b").alias("b"))
    # Few bytes, much arithmetic: patches are spread by count, not by size.
    parts = int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = points.repartition(parts, *keys).groupBy(*keys)
    kinds = dict(points.dtypes)
    shape = f"sample {kinds['sample']}, pi int, pj int, width {kinds['width']}, x {kinds['x']}, y {kinds['y']}, _local int"
    final = dealt.applyInPandas(_segment(s, side, compactness * compactness / (side * side), rounds), shape)
    patch = F.col("pi") * (F.floor(F.col("width") / s) + 1) + F.col("pj")
    return final.select("sample", "x", "y", superpixel_id(patch, F.col("_local"), patch_step(s, pixels_per_segment)).alias("label"))


def _segment(s: int, side: int, weight: float, rounds: int):
    """Local label of a patch's pixels; its seeds are kept as a small lattice."""
    lattice = math.ceil(s / side)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        points = [frame[c].to_numpy(dtype=float) for c in ("l", "a", "b", "x", "y")]
        ci = (frame["y"].to_numpy() - int(frame["pi"].iloc[0]) * s) // side
        cj = (frame["x"].to_numpy() - int(frame["pj"].iloc[0]) * s) // side
        # One ring of empty cells round the lattice, so that every cell has nine around it.
        ring = lattice + 2
        home = ((ci + 1) * ring + cj + 1).astype(np.int64)

        def centres(at, before):
            n = np.bincount(at, minlength=ring * ring)
            sums = [np.bincount(at, weights=p, minlength=ring * ring) for p in points]
            return [np.where(n > 0, v / np.maximum(n, 1), b) for v, b in zip(sums, before)]

        def nearest(seeds):
            least, chosen = np.full(len(home), np.inf), home.copy()
            for step in (di * ring + dj for di in (-1, 0, 1) for dj in (-1, 0, 1)):
                at = home + step
                cost = np.zeros(len(home))
                for p, seed, w in zip(points, seeds, (1.0, 1.0, 1.0, weight, weight)):
                    gap = p - seed[at]
                    cost += w * gap * gap
                cost = np.floor(cost * 1e6 + 0.3)
                # A cell without a seed costs NaN and is never less.
                better = cost < least
                least[better], chosen[better] = cost[better], at[better]
            return chosen

        seeds = centres(home, [np.nan] * 5)
        for _ in range(rounds):
            seeds = centres(nearest(seeds), seeds)
        chosen = nearest(seeds)
        label = (chosen // ring - 1) * lattice + chosen % ring - 1
        return frame[["sample", "pi", "pj", "width", "x", "y"]].assign(_local=label.astype("int32"))

    return run
