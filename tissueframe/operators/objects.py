"""Tissue objects on slide thumbnails: clusters, boxes, ranks, sample sheet."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.operators.raster import detect_scale, foreground
from tissueframe.plans.components import connected_components
from tissueframe.plans.lineage import store
from tissueframe.plans.quantile import exact_quantiles
from tissueframe.plans.skew import attach
from tissueframe.plans.spread import spread


def eps_pairs(points: DataFrame, eps: float) -> DataFrame:
    """Ordered pairs of distinct places within ``eps``: ``sample, x, y, x2, y2``.

    Points with equal coordinates are one place. Places meet in the 3 x 3 cells
    around them; a cell of side ``eps`` holds a bounded number of whole places.
    """
    places = points.select("sample", "x", "y").distinct()
    keyed = places.withColumn("cx", F.floor(F.col("x") / F.lit(float(eps)))).withColumn("cy", F.floor(F.col("y") / F.lit(float(eps))))
    steps = F.sequence(F.lit(-1), F.lit(1))
    sent = keyed.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps)).select(
        "sample",
        F.col("x").alias("x2"),
        F.col("y").alias("y2"),
        (F.col("cx") + F.col("_i")).alias("cx"),
        (F.col("cy") + F.col("_j")).alias("cy"),
    )
    dx, dy = F.col("x") - F.col("x2"), F.col("y") - F.col("y2")
    met = keyed.join(sent, ["sample", "cx", "cy"]).where(dx * dx + dy * dy <= F.lit(float(eps) * float(eps)))
    return met.select("sample", "x", "y", "x2", "y2")


def neighbour_counts(points: DataFrame, eps: int) -> DataFrame:
    """Points within ``eps`` of each place, itself included: ``sample, x, y, w, n``.

    No pair is formed. Every place adds its weight to one stretch of each of the
    ``2 eps + 1`` rows around it; a running sum along the row then reads all
    counts. A row is as long as the image is wide.
    """
    places = points.groupBy("sample", "x", "y").agg(F.count("*").alias("w"))
    rows = spread(places, "sample", "x", "y").withColumn("_dy", F.explode(F.sequence(F.lit(-eps), F.lit(eps))))
    reach = F.floor(F.sqrt(F.lit(eps * eps) - F.col("_dy") * F.col("_dy"))).cast("int")
    steps = rows.select(
        "sample",
        (F.col("y") + F.col("_dy")).alias("y"),
        F.explode(
            F.array(
                F.struct((F.col("x") - reach).alias("x"), F.col("w").alias("d")),
                F.struct((F.col("x") + reach + 1).alias("x"), (-F.col("w")).alias("d")),
            )
        ).alias("_e"),
    )
    changes = steps.groupBy("sample", "y", F.col("_e.x").alias("x")).agg(F.sum("_e.d").alias("d"))
    marks = changes.withColumn("w", F.lit(None).cast("long")).unionByName(
        places.select("sample", "y", "x", F.lit(0).cast("long").alias("d"), "w")
    )
    # Range frame: all changes at the same x count for the place at x.
    run = Window.partitionBy("sample", "y").orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = marks.withColumn("n", F.sum("d").over(run))
    return summed.where(F.col("w").isNotNull()).select("sample", "x", "y", "w", "n")


def _ends(df: DataFrame, keys: list[str]) -> DataFrame:
    """Row and column ends of the places of each cell, as one array per cell.

    Seen from outside a cell, the nearest of its places is an end of its row or
    of its column, so the ends decide every distance to the cell.
    """
    by_row = df.groupBy(*keys, "y").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    by_col = df.groupBy(*keys, "x").agg(F.min("y").alias("a"), F.max("y").alias("b"))
    ends = by_row.select(*keys, F.explode(F.array("a", "b")).alias("x"), "y").unionByName(
        by_col.select(*keys, "x", F.explode(F.array("a", "b")).alias("y"))
    )
    return ends.groupBy(*keys).agg(F.collect_set(F.struct("x", "y")).alias("ends"))


def dbscan(points: DataFrame, eps: int = 50, min_samples: int = 500) -> DataFrame:
    """Density clusters of whole-numbered points: ``sample, x, y, label``; noise is -1.

    A place is a core with at least ``min_samples`` points within ``eps``. Core
    places are gathered in cells whose diagonal is at most ``eps``, so the cores
    of a cell belong together; cells are linked where some of their cores are
    within ``eps``, and the components of that small graph are the clusters,
    numbered in order of their first core (x, then y). Other places join the
    first cluster with a core within ``eps``.
    """
    counted = store(neighbour_counts(points, eps), "density")
    side = math.floor(eps / math.sqrt(2)) + 1
    cell = [F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy")]
    keys = ["sample", "cx", "cy"]
    core = counted.where(F.col("n") >= min_samples).select("sample", "x", "y", *cell)
    cells = store(
        _ends(core, keys).join(
            core.groupBy(*keys).agg(F.min(F.struct("x", "y")).alias("first")), keys
        ),
        "cells",
    )
    around = (eps - 1) // side + 1
    limit = F.lit(eps * eps)

    def close(a, b):
        return F.exists(
            a, lambda p: F.exists(b, lambda q: (p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]) <= limit)
        )

    # Each unordered pair of cells once.
    offsets = F.array(
        *[
            F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j"))
            for i in range(0, around + 1)
            for j in range(-around, around + 1)
            if (i, j) > (0, 0)
        ]
    )
    sent = cells.withColumn("_o", F.explode(offsets)).select(
        "sample",
        (F.col("cx") + F.col("_o.i")).alias("cx"),
        (F.col("cy") + F.col("_o.j")).alias("cy"),
        F.struct("sample", "cx", "cy").alias("a"),
        F.col("ends").alias("_other"),
    )
    links = cells.join(sent, keys).where(close(F.col("ends"), F.col("_other"))).select("a", F.struct("sample", "cx", "cy").alias("b"))
    nodes = cells.select(F.struct(*keys).alias("id"))
    parts = connected_components(nodes, links)
    joined = cells.join(parts, F.struct(*[cells[c] for c in keys]) == parts["id"]).select(*keys, "ends", "first", "component")
    firsts = joined.groupBy("sample", "component").agg(F.min("first").alias("_first"))
    # Objects on a slide are few; their numbering is a window per slide.
    numbered = firsts.select(
        "sample", "component", (F.row_number().over(Window.partitionBy("sample").orderBy("_first")) - 1).cast("int").alias("label")
    )
    labelled = store(joined.join(numbered, ["sample", "component"]).select(*keys, "ends", "label"), "labelled")
    core_labels = core.join(labelled.select(*keys, "label"), keys).select("sample", "x", "y", "label")
    border = counted.where(F.col("n") < min_samples).select("sample", "x", "y", *cell)
    near = labelled.withColumn("_i", F.explode(F.sequence(F.lit(-around), F.lit(around)))).withColumn(
        "_j", F.explode(F.sequence(F.lit(-around), F.lit(around)))
    ).select("sample", (F.col("cx") + F.col("_i")).alias("cx"), (F.col("cy") + F.col("_j")).alias("cy"), "ends", "label")
    dx, dy = lambda q: q["x"] - F.col("x"), lambda q: q["y"] - F.col("y")
    touches = F.exists("ends", lambda q: dx(q) * dx(q) + dy(q) * dy(q) <= limit)
    met = border.join(near, keys, "left").groupBy("sample", "x", "y").agg(
        F.min(F.when(touches, F.col("label"))).alias("label")
    )
    others = met.withColumn("label", F.coalesce("label", F.lit(-1)))
    return core_labels.unionByName(others)


def drop_noise(df: DataFrame) -> DataFrame:
    """Rows of real clusters."""
    return df.where(F.col("label") != -1)


def object_boxes(
    points: DataFrame,
    dims: DataFrame,
    widen: tuple[float, float] = (0.35, 0.35),
    shift: Sequence[float] = (0, 0, 0, 0),
) -> DataFrame:
    """Box of each object as fractions of its slide: ``loc0, size0, loc1, size1``.

    Per axis the box spans the 5% to 95% quantiles of the object's places,
    widened on both sides, moved into the slide. ``dims`` has ``width, height``.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("axis"), F.col(c).alias("v")) for i, c in enumerate("xy")])
    long = points.select("sample", "label", F.explode(pairs).alias("_p")).select("sample", "label", "_p.axis", "_p.v")
    spans = exact_quantiles(long, ["sample", "label", "axis"], "v", {"a": 0.05, "b": 0.95})
    met = spans.join(dims, "sample")
    first = F.col("axis") == 0
    dim = F.when(first, F.col("width")).otherwise(F.col("height"))
    span = F.col("b") - F.col("a")
    low = F.when(first, F.lit(float(widen[0] + shift[0]))).otherwise(F.lit(float(widen[1] + shift[2])))
    high = F.when(first, F.lit(float(widen[0] + shift[1]))).otherwise(F.lit(float(widen[1] + shift[3])))
    start, end = F.col("a") - low * span, F.col("b") + high * span
    sized = met.withColumn("_loc", F.greatest(start / dim, F.lit(0.0))).withColumn("_size", end / dim - start / dim)
    sized = sized.withColumn("_size", F.when(F.col("_loc") + F.col("_size") > 1, 1 - F.col("_loc")).otherwise(F.col("_size")))
    def pick(axis, col):
        return F.max(F.when(F.col("axis") == axis, F.col(col)))
    return sized.groupBy("sample", "label").agg(
        pick(0, "_loc").alias("loc0"), pick(0, "_size").alias("size0"), pick(1, "_loc").alias("loc1"), pick(1, "_size").alias("size1")
    )


def object_area(boxes: DataFrame, compat: bool = False) -> DataFrame:
    """Area fraction of each box. ``compat`` squares the width, as the reference does."""
    other = F.col("size0") if compat else F.col("size1")
    return boxes.withColumn("area", F.col("size0") * other)


def rank_first(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], name: str = "rank") -> DataFrame:
    """Rank by falling value inside each group, ties in the given order.

    A group is the objects of one case, so a window holds few rows.
    """
    window = Window.partitionBy(*by).orderBy(F.col(value).desc(), *[F.col(c).asc() for c in order])
    return df.withColumn(name, F.row_number().over(window).cast("long"))


def attach_dims(objects: DataFrame, meta: DataFrame) -> DataFrame:
    """Slide dimensions and their product beside each object."""
    dims = meta.select("sample", "width", "height", (F.col("width").cast("long") * F.col("height")).alias("apx"))
    spread = [c for c in objects.columns if c != "sample"]
    return attach(objects, dims, ["sample"], "inner", spread=spread)


def exclude(objects: DataFrame, listed: DataFrame) -> DataFrame:
    """Objects that are not listed by sample and label."""
    return objects.join(listed.select("sample", "label"), ["sample", "label"], "left_anti")


def build_samplesheet(objects: DataFrame, data_dir: str, roi_dir: str, mpp: float, suffix: str = ".tif") -> DataFrame:
    """One sheet row per object; blanks in slide names become underscores."""
    name = F.concat_ws(".oid", F.col("sample"), F.col("label").cast("string"))
    return objects.select(
        F.concat_ws(".oid", F.regexp_replace("sample", " ", "_"), F.col("label").cast("string")).alias("sample"),
        F.lit("").alias("fastq"),
        F.concat(F.lit(data_dir), F.col("sample"), F.lit(suffix)).alias("image"),
        F.lit("").alias("grid"),
        F.concat(F.lit(roi_dir), name, F.lit(".json")).alias("roifile"),
        F.lit(mpp).alias("mpp"),
    )


def detect_objects(
    thumbs: DataFrame, dims: DataFrame, eps: int = 50, min_samples: int = 500, a: float = 80.0, b: float = 225.0, **boxes
) -> DataFrame:
    """Objects of each slide with box, area, rank by area and slide size."""
    cells = foreground(detect_scale(thumbs), a, b)
    found = drop_noise(dbscan(cells, eps, min_samples))
    # Equal boxes must tie: their areas may differ in the last bits.
    sized = object_area(object_boxes(found, dims, **boxes)).withColumn("area", F.round("area", 12))
    ranked = rank_first(sized, ["sample"], "area", ["label"])
    return attach_dims(ranked, dims)
