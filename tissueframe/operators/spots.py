"""Per-spot aggregates of assigned nuclei."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.operators.assignment import assign_circle, assign_square
from tissueframe.operators.nuclei import label_cell_types, nan_to_null, relabel_low_prob
from tissueframe.schemas import CELL_CLASSES, QUANTITIES

CLASSES = tuple(CELL_CLASSES.values())


def _is(name: str) -> Column:
    return F.col("cell_type") == name


def _counts(classes: Sequence[str]) -> list[Column]:
    return [F.count_if(_is(c)).alias(f"count_{c}") for c in classes]


def _densities(classes: Sequence[str]) -> list[Column]:
    return [F.avg(_is(c).cast("double")).alias(f"density_{c}") for c in classes]


def _class_means(quantities: Sequence[str], classes: Sequence[str]) -> list[Column]:
    return [F.avg(F.when(_is(c), F.col(q))).alias(f"average_{q}_{c}") for q in quantities for c in classes]


def _class_stds(quantities: Sequence[str], classes: Sequence[str]) -> list[Column]:
    return [
        F.stddev_samp(F.when(_is(c), F.col(q))).alias(f"std_{q}_{c}") for q in quantities for c in classes
    ]


def _stats(quantities: Sequence[str]) -> list[Column]:
    cols = []
    for q in quantities:
        cols += [F.avg(q).alias(f"average_{q}"), F.stddev_samp(q).alias(f"std_{q}")]
    return cols


def _by_spot(nuclei: DataFrame, columns: list[Column]) -> DataFrame:
    assigned = nuclei.where(F.col("barcode").isNotNull())
    return assigned.groupBy("sample", "barcode").agg(*columns)


def spot_counts(nuclei: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Nuclei of each class per spot."""
    return _by_spot(nuclei, _counts(classes))


def spot_density(nuclei: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Share of each class among the nuclei of a spot."""
    return _by_spot(nuclei, _densities(classes))


def spot_totals(nuclei: DataFrame) -> DataFrame:
    """Nuclei per spot."""
    return _by_spot(nuclei, [F.count("*").alias("total_count")])


def spot_class_means(nuclei: DataFrame, quantities=QUANTITIES, classes=CLASSES) -> DataFrame:
    """Mean of each quantity per spot and class."""
    return _by_spot(nuclei, _class_means(quantities, classes))


def spot_class_stds(nuclei: DataFrame, quantities=QUANTITIES, classes=CLASSES) -> DataFrame:
    """Sample deviation of each quantity per spot and class; NULL for one nucleus."""
    return _by_spot(nuclei, _class_stds(quantities, classes))


def spot_stats(nuclei: DataFrame, quantities=QUANTITIES) -> DataFrame:
    """Mean and sample deviation of each quantity per spot."""
    return _by_spot(nuclei, _stats(quantities))


def spot_long(nuclei: DataFrame, quantities=QUANTITIES) -> DataFrame:
    """The same aggregates in long form: one row per spot, class and quantity."""
    pairs = F.array(
        *[F.struct(F.lit(q).alias("q"), F.col(q).cast("double").alias("v")) for q in quantities]
    )
    assigned = nuclei.where(F.col("barcode").isNotNull()).withColumn("_p", F.explode(pairs))
    return assigned.groupBy(
        "sample", "barcode", "cell_type", F.col("_p.q").alias("quantity")
    ).agg(
        F.count("*").alias("n"),
        F.avg("_p.v").alias("mean"),
        F.stddev_samp("_p.v").alias("std"),
    )


def per_spot(
    nuclei: DataFrame,
    grid: DataFrame,
    info: DataFrame,
    shape: str = "square",
    factor: float = 1,
    min_prob: float = 0.75,
    quantities: Sequence[str] = QUANTITIES,
    classes: Sequence[str] = CLASSES,
) -> DataFrame:
    """Per-spot report: assignment, relabelling and all aggregates in one pass."""
    assign = {"square": assign_square, "circle": assign_circle}[shape]
    named = label_cell_types(nuclei) if dict(nuclei.dtypes)["cell_type"] != "string" else nuclei
    floats = [q for q in quantities if dict(named.dtypes)[q] in ("double", "float")]
    found = assign(nan_to_null(named, floats), grid, info, factor, keep_unassigned=False)
    ready = relabel_low_prob(found, min_prob)
    columns = (
        _densities(classes)
        + _counts(classes)
        + [F.count("*").alias("total_count")]
        + _class_means(quantities, classes)
        + _class_stds(quantities, classes)
        + _stats(quantities)
    )
    return _by_spot(ready, columns)


def tile_type_counts(nuclei: DataFrame, p: float = 0.75, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Confident nuclei of each class per sampled tile.

    A tile without nuclei has no row; a tile whose nuclei are all doubtful has
    zeros.
    """
    sure = F.col("cell_type_prob") >= F.lit(p)
    return nuclei.groupBy("sample", "tile").agg(
        *[F.count_if(sure & _is(c)).alias(c) for c in classes]
    )


def label_counts(df: DataFrame, by: Sequence[str], label: str) -> DataFrame:
    """Rows per label."""
    return df.groupBy(*by, label).agg(F.count("*").alias("n"))


def ordered_classes(df: DataFrame, label: str) -> DataFrame:
    """Distinct classes in sorted order."""
    return df.select(label).distinct().orderBy(label)
