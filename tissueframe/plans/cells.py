"""Square cells that turn range conditions into equality joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell_of(value: Column, size: Column) -> Column:
    """Index of the cell holding ``value``."""
    return F.floor(value / size).cast("long")


def cells_between(low: Column, high: Column, size: Column) -> Column:
    """All cell indexes touched by the closed range ``[low, high]``."""
    return F.sequence(cell_of(low, size), cell_of(high, size))


def cover(
    df: DataFrame,
    x_range: tuple[Column, Column],
    y_range: tuple[Column, Column],
    size: Column,
    names: tuple[str, str] = ("cx", "cy"),
) -> DataFrame:
    """Repeat each row for every cell its box touches."""
    wide = df.withColumn(names[0], F.explode(cells_between(*x_range, size)))
    return wide.withColumn(names[1], F.explode(cells_between(*y_range, size)))


def band_join(
    points: DataFrame,
    ranges: DataFrame,
    by: list[str],
    point: str,
    low: str,
    high: str,
    size: int,
    how: str = "inner",
) -> DataFrame:
    """Rows of ``points`` with the rows of ``ranges`` whose ``[low, high)`` holds them.

    Ranges are repeated for the cells they touch and met by equality on the
    cell, so the plan is an equi-join with a residual test. ``ranges`` should be
    the smaller side. Hot cells are left to adaptive skew splitting, which
    applies as the result is not assumed to keep the join's partitioning.
    """
    width = F.lit(size)
    left = points.withColumn("_cell", cell_of(F.col(point), width))
    right = ranges.withColumn(
        "_cell", F.explode(cells_between(F.col(low), F.col(high) - 1, width))
    )
    right_only = [c for c in right.columns if c not in (*by, "_cell")]
    right = right.select(*by, "_cell", *right_only)
    a, b = left.alias("a"), right.alias("b")
    match = F.col("a._cell") == F.col("b._cell")
    for key in by:
        match = match & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    match = match & (F.col(f"a.{point}") >= F.col(f"b.{low}"))
    match = match & (F.col(f"a.{point}") < F.col(f"b.{high}"))
    kept = [F.col(f"a.{c}") for c in points.columns]
    return a.join(b, match, how).select(*kept, *[F.col(f"b.{c}") for c in right_only])
