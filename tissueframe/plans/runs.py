"""Binary canvases as horizontal runs ``(sample, y, x0, x1)``, both ends included."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_runs(runs: DataFrame) -> DataFrame:
    """Join runs of a row that overlap or touch; a row is as long as the canvas is wide."""
    row = Window.partitionBy("sample", "y").orderBy("x0", "x1")
    reach = F.max("x1").over(row.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reach.isNull() | (F.col("x0") > reach + 1), 1).otherwise(0)
    grouped = runs.withColumn("_start", starts).withColumn(
        "_island", F.sum("_start").over(row.rowsBetween(Window.unboundedPreceding, 0))
    )
    return grouped.groupBy("sample", "y", "_island").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1")
    ).drop("_island")


def clip(runs: DataFrame, canvas: DataFrame) -> DataFrame:
    """Cut runs to the canvas ``(sample, width, height)``; equal runs collapse."""
    inside = runs.distinct().join(canvas, "sample").where(
        (F.col("y") >= 0) & (F.col("y") < F.col("height")) & (F.col("x1") >= 0) & (F.col("x0") < F.col("width"))
    )
    return inside.select(
        "sample",
        "y",
        F.greatest("x0", F.lit(0)).alias("x0"),
        F.least("x1", F.col("width") - 1).alias("x1"),
    )


def _shifted(mask, offsets, axis, outside):
    """All shifted copies of a raster, filled with ``outside`` where they run off it."""
    import numpy as np

    pad = [(0, 0), (0, 0)]
    pad[axis] = (-min(offsets), max(offsets))
    wide = np.pad(mask, pad, constant_values=outside)
    size = mask.shape[axis]
    for o in offsets:
        start = o - min(offsets)
        yield wide[start : start + size] if axis == 0 else wide[:, start : start + size]


def _close(mask, kernel: int):
    """Dilate by a square, fill the holes, erode by the same square."""
    import numpy as np

    # The anchor of an even square is the cell right of its middle.
    offsets = range(-(kernel // 2), kernel - kernel // 2)
    for axis in (0, 1):
        mask = np.logical_or.reduce(list(_shifted(mask, offsets, axis, False)))
    mask = mask | _holes(mask)
    for axis in (0, 1):
        mask = np.logical_and.reduce(list(_shifted(mask, offsets, axis, True)))
    return mask


def _mask_runs(mask):
    """Runs ``(y, x0, x1)`` of set cells by row, then column."""
    import numpy as np

    wide = np.pad(mask.astype(np.int8), ((0, 0), (1, 1)))
    ys, edges = np.nonzero(np.diff(wide, axis=1))
    return list(zip(ys[::2].tolist(), edges[::2].tolist(), (edges[1::2] - 1).tolist()))


def _holes(mask):
    """Empty cells that no 4-connected way leads out of."""
    import numpy as np

    height, width = mask.shape
    gaps = _mask_runs(~mask)
    parent = list(range(len(gaps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # Two pointers over neighbouring rows: gaps are sorted by row, then column.
    behind = 0
    for i, (y, a, b) in enumerate(gaps):
        while gaps[behind][0] < y - 1 or (gaps[behind][0] == y - 1 and gaps[behind][2] < a):
            behind += 1
        j = behind
        while j < i and gaps[j][0] == y - 1 and gaps[j][1] <= b:
            parent[root(j)] = root(i)
            j += 1
    border = {root(i) for i, (y, a, b) in enumerate(gaps) if y in (0, height - 1) or a == 0 or b == width - 1}
    filled = np.zeros_like(mask)
    for i, (y, a, b) in enumerate(gaps):
        if root(i) not in border:
            filled[y, a : b + 1] = True
    return filled


def close_canvas(runs: DataFrame, canvas: DataFrame, kernel: int) -> DataFrame:
    """Closing with filled holes of each canvas, again as runs.

    One task handles one canvas as a raster. Its size is fixed by the caller (at
    most ``chunk`` x ``chunk`` cells however large the slide is) and its runs
    were merged before, so the group is bounded by that.
    """

    def per_canvas(frame: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        mask = np.zeros((int(frame["height"].iloc[0]), int(frame["width"].iloc[0])), dtype=bool)
        for y, a, b in zip(frame["y"], frame["x0"], frame["x1"]):
            mask[y, a : b + 1] = True
        closed = _close(mask, kernel)
        found = pd.DataFrame(_mask_runs(closed), columns=["y", "x0", "x1"])
        found.insert(0, "sample", frame["sample"].iloc[0])
        return found

    sized = runs.join(canvas, "sample")
    return sized.groupBy("sample").applyInPandas(per_canvas, "sample string, y int, x0 int, x1 int")


def runs_to_cells(runs: DataFrame) -> DataFrame:
    """All cells of the runs."""
    return runs.select("sample", F.explode(F.sequence("x0", "x1")).alias("x"), "y")
