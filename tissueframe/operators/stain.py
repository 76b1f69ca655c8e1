"""Stain statistics: stain rows per patch, normalisation, nuclear optical density.

Everything that depends on colour only is computed on the distinct colours of a
patch with their pixel counts, so a patch costs its colours, not its pixels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.functions.colour import concentration_to_rgb, lasso2, to_od
from tissueframe.operators.raster import channel_mean, expand_labels, patch_index
from tissueframe.plans.lineage import store
from tissueframe.plans.quantile import weighted_quantiles
from tissueframe.plans.skew import attach
from tissueframe.schemas import DEFAULT_STAIN

OD = ("od_r", "od_g", "od_b")
STAIN = ("h_r", "h_g", "h_b", "e_r", "e_g", "e_b")


def colour_counts(pixels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct colours of each group with their pixel count ``n``."""
    return pixels.groupBy(*by, "r", "g", "b").agg(F.count("*").alias("n"))


def with_od(colours: DataFrame) -> DataFrame:
    """Optical density of the three channels."""
    return colours.withColumns({o: to_od(F.col(c)) for o, c in zip(OD, "rgb")})


def od_covariance(colours: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sample covariance of the optical densities per group, weighted by ``n``.

    One pass of centred sums: the group mean comes first and is joined back, so
    the differences stay exact for bright patches.
    """
    od = with_od(colours)
    total = F.sum("n")
    means = od.groupBy(*by).agg(
        total.alias("_total"), *[(F.sum(F.col(o) * F.col("n")) / total).alias(f"_{o}") for o in OD]
    )
    centred = attach(od, means, list(by), "inner", spread=["r", "g", "b"])
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    return centred.groupBy(*by).agg(
        F.sum("n").alias("n_pixels"),
        *[
            F.try_divide(
                F.sum(
                    F.col("n")
                    * (F.col(OD[i]) - F.col(f"_{OD[i]}"))
                    * (F.col(OD[j]) - F.col(f"_{OD[j]}"))
                ),
                F.sum("n") - 1,
            ).alias(f"c{i}{j}")
            for i, j in pairs
        ],
    )


def _leading_vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Two leading eigenvectors of each row's 3x3 covariance, first entry positive."""
    import numpy as np

    for frame in batches:
        c = frame[["c00", "c01", "c02", "c11", "c12", "c22"]].to_numpy(dtype=float, na_value=np.nan)
        full = c[:, [0, 1, 2, 1, 3, 4, 2, 4, 5]].reshape(-1, 3, 3)
        sound = np.isfinite(full).all(axis=(1, 2))
        vectors = np.full((len(frame), 3, 2), np.nan)
        if sound.any():
            _, found = np.linalg.eigh(full[sound])
            found = found[:, :, [2, 1]]
            turn = np.where(found[:, 0, :] < 0, -1.0, 1.0)
            vectors[sound] = found * turn[:, None, :]
        out = frame.drop(columns=["c00", "c01", "c02", "c11", "c12", "c22", "n_pixels"])
        for k, name in enumerate(("v1", "v2")):
            for i in range(3):
                out[f"{name}_{i}"] = vectors[:, i, k]
        yield out


def leading_vectors(covariance: DataFrame, by: Sequence[str]) -> DataFrame:
    """Principal plane of each group; the 3x3 eigen step runs on Arrow batches."""
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in covariance.select(*by).schema]
    names = [f"{v}_{i} double" for v in ("v1", "v2") for i in range(3)]
    return covariance.mapInPandas(_leading_vectors, ", ".join(fields + names))


def stain_matrix(pixels: DataFrame, by: Sequence[str], angle: float = 99.0) -> DataFrame:
    """Unit stain rows (haematoxylin first) of each group of pixels.

    The optical densities are projected on their principal plane; the two
    percentiles of the angle there give the stains. Groups without a plane get
    NULL rows (see :func:`with_default_stain`).
    """
    return stain_of_colours(colour_counts(pixels, by), by, angle)


def stain_of_colours(colours: DataFrame, by: Sequence[str], angle: float = 99.0) -> DataFrame:
    """:func:`stain_matrix` of colours counted before."""
    by = list(by)
    plane = store(leading_vectors(od_covariance(colours, by), by), "stain-planes")
    projected = attach(with_od(colours), plane, by, "inner", spread=["r", "g", "b"])

    def along(v):
        return sum(F.col(o) * F.col(f"{v}_{i}") for i, o in enumerate(OD))

    turned = projected.withColumn("_phi", F.atan2(along("v2"), along("v1")))
    low, high = (100.0 - angle) / 100.0, angle / 100.0
    ends = plane.join(weighted_quantiles(turned, by, "_phi", "n", {"_low": low, "_high": high}), by, "left")

    def mixed(phi):
        phi = F.col(phi)
        return F.array(*[F.col(f"v1_{i}") * F.cos(phi) + F.col(f"v2_{i}") * F.sin(phi) for i in range(3)])

    ends = ends.withColumn("_a", mixed("_low")).withColumn("_b", mixed("_high"))
    first = F.col("_a")[0] > F.col("_b")[0]
    ends = ends.withColumn("_h", F.when(first, F.col("_a")).otherwise(F.col("_b"))).withColumn(
        "_e", F.when(first, F.col("_b")).otherwise(F.col("_a"))
    )

    def unit(name, i):
        v = F.col(name)
        norm = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])
        return F.try_divide(v[i], norm)

    return ends.select(
        *by,
        *[unit("_h", i).alias(STAIN[i]) for i in range(3)],
        *[unit("_e", i).alias(STAIN[3 + i]) for i in range(3)],
    )


def with_default_stain(stains: DataFrame) -> DataFrame:
    """Fixed stain rows in place of missing ones."""
    flat = DEFAULT_STAIN[0] + DEFAULT_STAIN[1]
    whole = F.lit(True)
    for name in STAIN:
        whole = whole & F.col(name).isNotNull() & ~F.isnan(F.col(name))
    return stains.withColumns(
        {name: F.when(whole, F.col(name)).otherwise(F.lit(value)) for name, value in zip(STAIN, flat)}
    )


def _rows() -> tuple[list[Column], list[Column]]:
    return [F.col(c) for c in STAIN[:3]], [F.col(c) for c in STAIN[3:]]


def concentrations(colours: DataFrame, lam: float = 0.01) -> DataFrame:
    """Stain amounts ``c1, c2`` of rows that carry a colour and its stain rows."""
    h, e = _rows()
    found = lasso2([to_od(F.col(c)) for c in "rgb"], h, e, lam)
    return colours.withColumn("_c", found).withColumns({"c1": F.col("_c.c1"), "c2": F.col("_c.c2")}).drop("_c")


def max_concentration(colours: DataFrame, stains: DataFrame, by: Sequence[str], lam: float = 0.01) -> DataFrame:
    """99% quantile of both stain amounts per group of counted colours."""
    by = list(by)
    mixed = concentrations(attach(colours, stains, by, "inner", spread=["r", "g", "b"]), lam)
    stains = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("c")) for k in (1, 2)]))
    long = mixed.select(*by, "n", stains.alias("_s")).select(*by, "n", "_s.*")
    top = weighted_quantiles(long, [*by, "k"], "c", "n", {"q": 0.99})
    return top.groupBy(*by).agg(*[F.max(F.when(F.col("k") == k, F.col("q"))).alias(f"max_c{k}") for k in (1, 2)])


def channel_histogram(pixels: DataFrame) -> DataFrame:
    """Pixels per sample and channel value, all channels together."""
    stacked = F.explode(F.array("r", "g", "b"))
    return pixels.select("sample", stacked.alias("value")).groupBy("sample", "value").agg(F.count("*").alias("n"))


def color_shift(pixels: DataFrame, quantile: float = 0.95) -> DataFrame:
    """Shift all channels so that the 95% quantile becomes 255, saturating.

    The quantile is taken from the 256-bin histogram of the sample.
    """
    top = channel_histogram(pixels).groupBy("sample").agg(
        F.expr(f"percentile(value, {quantile!r}D, n)").alias("_q")
    )
    shift = top.select("sample", (255 - F.col("_q").cast("int")).alias("shift"))
    met = attach(pixels, shift, ["sample"], "inner", spread=["x", "y"])
    return met.withColumns({c: F.least(F.lit(255), F.col(c) + F.col("shift")).cast("int") for c in "rgb"})


def select_patches(
    pixels: DataFrame, s: int, low: float = 100.0, high: float = 200.0, cutoffs: Sequence[float] = (0.5, 0.25, 0.125)
) -> DataFrame:
    """Patches with enough tissue: the first cut-off that any patch of the sample reaches."""
    inside = channel_mean().between(F.lit(low), F.lit(high)).cast("double")
    shares = patch_index(pixels, s).groupBy("sample", "pi", "pj").agg(F.avg(inside).alias("fraction"))
    best = Window.partitionBy("sample")
    top = F.max("fraction").over(best)
    chosen = F.lit(None).cast("double")
    for c in reversed(cutoffs):
        chosen = F.when(top >= F.lit(c), F.lit(c)).otherwise(chosen)
    return shares.withColumn("cutoff", chosen).where(F.col("fraction") >= F.col("cutoff"))


def representative_patch(patches: DataFrame) -> DataFrame:
    """The patch of each sample whose stain rows are nearest to their median.

    ``patches`` has ``sample, pi, pj``, stain rows and maxima; ties go to the
    first patch in row order.
    """
    centre = exact_medians(patches, STAIN)
    met = attach(patches, centre, ["sample"], "inner", spread=["pi", "pj"])
    gap = F.sqrt(sum((F.col(c) - F.col(f"_m_{c}")) * (F.col(c) - F.col(f"_m_{c}")) for c in STAIN))
    payload = [c for c in patches.columns if c not in ("sample", "pi", "pj")]
    best = met.groupBy("sample").agg(
        F.min(F.struct(gap.alias("gap"), F.col("pi"), F.col("pj"), *[F.col(c) for c in payload])).alias("_b")
    )
    return best.select("sample", "_b.pi", "_b.pj", *[f"_b.{c}" for c in payload])


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median of several columns per sample; rows are patches, thousands per slide."""
    return df.groupBy("sample").agg(*[F.percentile(c, 0.5).alias(f"_m_{c}") for c in columns])


def normalise_stain(
    pixels: DataFrame, reference: DataFrame, s: int = 512, low: float = 100.0, high: float = 200.0, lam: float = 0.01
) -> DataFrame:
    """Recolour slides so that their stains match a reference image.

    Colours are shifted, the representative patch of each slide gives its stain
    rows and maxima, and every pixel's stain amounts are rescaled to the
    reference's maxima and mixed with the reference's stain rows. The job fails
    if ``reference`` is not exactly one image with stain, or if a slide has no
    patch with enough tissue: no slide is left out silently.
    """
    ref = color_shift(reference)
    ref_colours = colour_counts(ref, ["sample"])
    ref_stain = stain_of_colours(ref_colours, ["sample"])
    target = ref_stain.join(max_concentration(ref_colours, ref_stain, ["sample"], lam), "sample")
    target = target.select(*[F.col(c).alias(f"t_{c}") for c in (*STAIN, "max_c1", "max_c2")])

    shifted = color_shift(pixels).drop("shift")
    keys = ["sample", "pi", "pj"]
    chosen = select_patches(shifted, s, low, high).select(*keys)
    colours = colour_counts(patch_index(shifted, s), keys)
    colours = store(attach(colours, chosen, keys, "inner", spread=["r", "g", "b"]), "patch-colours")
    stains = stain_of_colours(colours, keys).where(F.col("h_r").isNotNull())
    maxima = max_concentration(colours, stains, keys, lam)
    source = representative_patch(stains.join(maxima, keys)).drop("pi", "pj")
    # One image, hence one row; more or none is an error in that row.
    single = F.col("_n") == 1
    target = target.agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in target.columns])
    wrong = F.raise_error(F.lit("the reference must be exactly one image with two stains")).cast("double")
    target = target.select(*[F.when(single, F.col(c)).otherwise(wrong).alias(c) for c in target.columns if c != "_n"])
    slides = shifted.select("sample").distinct().join(source, "sample", "left")
    poor = F.raise_error(F.concat(F.lit("no patch with enough tissue in slide "), F.col("sample").cast("string"))).cast("double")
    names = [*STAIN, "max_c1", "max_c2"]
    slides = slides.withColumns({c: F.when(F.col("h_r").isNotNull(), F.col(c)).otherwise(poor) for c in names if c != "h_r"})
    source = slides.join(F.broadcast(target))
    mixed = concentrations(attach(shifted, source, ["sample"], "inner", spread=["x", "y"]), lam)
    # A stain the slide lacks stays absent.
    c1, c2 = (
        F.col(c) * F.coalesce(F.try_divide(f"t_max_{c}", f"max_{c}"), F.lit(0.0)) for c in ("c1", "c2")
    )
    return mixed.select(
        "sample",
        "x",
        "y",
        *[
            concentration_to_rgb(c1 * F.col(f"t_h_{ch}") + c2 * F.col(f"t_e_{ch}")).alias(ch)
            for ch in "rgb"
        ],
    )


def he_channels(pixels: DataFrame, stains: DataFrame, by: Sequence[str]) -> DataFrame:
    """Haematoxylin and eosin images ``h, e``: colour times stain rows, over the group maximum.

    The colour enters as it is (0 counts as 1), not as optical density.
    """
    by = list(by)
    met = attach(pixels, stains, by, "inner", spread=["x", "y"])
    rgb = [F.greatest(F.col(c), F.lit(1)) for c in "rgb"]
    h_row, e_row = _rows()
    raw = met.withColumn("_h", sum(a * b for a, b in zip(rgb, h_row))).withColumn(
        "_e", sum(a * b for a, b in zip(rgb, e_row))
    )
    top = raw.groupBy(*by).agg(F.max("_h").alias("_mh"), F.max("_e").alias("_me"))
    scaled = attach(raw, top, by, "inner", spread=["x", "y"])
    return scaled.withColumns({"h": F.try_divide("_h", "_mh"), "e": F.try_divide("_e", "_me")}).drop(
        "_h", "_e", "_mh", "_me", *STAIN
    )


def nucleus_stain(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stain means of each nucleus and its ring, and eosin extremes of the ring.

    ``parts`` has ``label, part`` (``nuc`` or ``cy``), ``h, e``. Nuclei lacking
    one of the two parts are left out.
    """
    ring, core = F.col("part") == "cy", F.col("part") == "nuc"

    def over(fn, cond, value):
        return fn(F.when(cond, F.col(value)))

    measured = parts.groupBy(*by, "label").agg(
        over(F.avg, ring, "h").alias("cy_hemat_mean"),
        over(F.avg, ring, "e").alias("cy_eosin_mean"),
        over(F.avg, core, "h").alias("nuc_hemat_mean"),
        over(F.avg, core, "e").alias("nuc_eosin_mean"),
        over(F.max, ring, "e").alias("cy_eosin_max"),
        over(F.min, ring, "e").alias("cy_eosin_min"),
    )
    return measured.where(F.col("cy_hemat_mean").isNotNull() & F.col("nuc_hemat_mean").isNotNull())


MEASURES = (
    "cy_hemat_mean",
    "cy_eosin_mean",
    "nuc_hemat_mean",
    "nuc_eosin_mean",
    "cy_eosin_max",
    "cy_eosin_min",
)


def merge_fragments(fragments: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """Unweighted mean over the pieces of a nucleus cut by patch borders."""
    return fragments.groupBy("sample", "label").agg(*[F.avg(c).alias(c) for c in columns])


def cells_od(
    pixels: DataFrame, labels: DataFrame, nuclei: DataFrame, block: int = 4096, distance: int = 15
) -> DataFrame:
    """Stain measures per nucleus over the whole slide, computed by blocks.

    ``labels`` lists labelled cells (id + 1). Nuclei are cut at block borders
    and their pieces averaged, as the measures are defined per block. The window
    that limits the reference's search around a nucleus only saves work and is
    not needed here.
    """
    keys = ["sample", "pi", "pj"]
    blocks = patch_index(pixels, block)
    cut = patch_index(labels.where("label <> 0"), block)
    busy = cut.select(*keys).distinct()
    used = blocks.join(busy, keys, "left_semi")
    stains = with_default_stain(stain_matrix(used, keys))
    he = he_channels(used, stains, keys).select(*keys, "x", "y", "h", "e")
    frames = busy.withColumns({
        "x0": F.col("pj") * block, "y0": F.col("pi") * block, "width": F.lit(block), "height": F.lit(block)
    })
    rings = expand_labels(cut, distance, frames, by=keys)
    parts = cut.select(*keys, "x", "y", "label", F.lit("nuc").alias("part")).unionByName(
        rings.select(*keys, "x", "y", "label", F.lit("cy").alias("part"))
    )
    measured = nucleus_stain(parts.join(he, [*keys, "x", "y"]), keys)
    merged = merge_fragments(measured)
    centres = nuclei.select(
        "sample",
        (F.col("ids").cast("long") + 1).alias("label"),
        "ids",
        F.col("centroid_x").alias("x"),
        F.col("centroid_y").alias("y"),
    )
    return merged.join(centres, ["sample", "label"]).select("sample", "ids", "x", "y", *MEASURES)
