"""Segmented nuclei: measures, class names, rasterisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.functions.contour import contour_moments, contour_perimeter, contour_shape, edges_of, row_spans
from tissueframe.plans.quantile import exact_quantiles
from tissueframe.schemas import CELL_CLASSES
from tissueframe.plans.spread import spread


def measure_nuclei(nuclei: DataFrame, scale: float = 1.0) -> DataFrame:
    """Per-nucleus table from ``(sample, ids, centroid, contour, type, type_prob)``."""
    shaped = spread(nuclei, "sample", "ids").withColumn("_m", contour_moments(F.col("contour"))).withColumn(
        "_p", contour_perimeter(F.col("contour"))
    )
    shape = contour_shape(F.col("_m"), F.col("_p"))
    shaped = shaped.withColumn("_s", shape)
    return shaped.select(
        "sample",
        "ids",
        F.col("centroid")[0].cast("int").alias("centroid_x"),
        F.col("centroid")[1].cast("int").alias("centroid_y"),
        F.col("type").alias("cell_type"),
        F.col("type_prob").alias("cell_type_prob"),
        (F.col("_p") * scale).alias("perimeter_length"),
        (F.col("_s.area") * scale * scale).alias("area"),
        F.col("_s.orientation").alias("orientation"),
        F.col("_s.eccentricity").alias("eccentricity"),
        F.col("_s.circularity").alias("circularity"),
    )


def label_cell_types(nuclei: DataFrame, classes: dict[int, str] = CELL_CLASSES) -> DataFrame:
    """Class codes replaced by names; an unknown code stays as text."""
    pairs = [F.lit(v) for item in classes.items() for v in item]
    name = F.try_element_at(F.create_map(*pairs), F.col("cell_type"))
    return nuclei.withColumn("cell_type", F.coalesce(name, F.col("cell_type").cast("string")))


def relabel_low_prob(nuclei: DataFrame, p: float = 0.75) -> DataFrame:
    """Class ``no_label`` where the class probability is below ``p``."""
    doubtful = F.col("cell_type_prob") < F.lit(p)
    return nuclei.withColumn("cell_type", F.when(doubtful, "no_label").otherwise(F.col("cell_type")))


def nan_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN becomes NULL, so that means and deviations skip it."""
    cleaned = {c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in columns}
    return df.withColumns(cleaned)


def rasterize_nuclei(nuclei: DataFrame) -> DataFrame:
    """Label raster ``(sample, x, y, label)`` of filled contours of whole numbers; label is id + 1.

    Where nuclei overlap the one whose id is last in string order is kept. A
    nucleus becomes the rows of its box, a row its spans between the sorted
    crossings of the contour, and only covered cells are made;
    nuclei never meet each other before the per-cell choice.
    """
    ys = F.transform("contour", lambda p: p[1])
    rows = spread(nuclei.where(F.size("contour") > 0), "sample", "ids").select(
        "sample",
        id_order(F.col("ids")).alias("_key"),
        edges_of(F.col("contour")).alias("_edges"),
        F.explode(F.sequence(F.array_min(ys), F.array_max(ys))).alias("y"),
    )
    spans = F.transform(row_spans(F.col("_edges"), F.col("y")), lambda p: F.sequence(p["a"].cast("int"), p["b"].cast("int")))
    # Spans of a row overlap at the border only.
    cells = rows.select("sample", "_key", F.explode(F.array_distinct(F.flatten(spans))).alias("x"), "y")
    return last_writer(cells)


# An id has at most this many digits: its order, five bits of length included, must fit in a BIGINT.
ID_DIGITS = 17
_TENS = [10**i for i in range(ID_DIGITS + 1)]


def id_order(ids: Column) -> Column:
    """BIGINT that orders whole numbers given as text as their texts are ordered: digits from the left, then length.

    A NULL id stays NULL; one that is no whole number of up to 17 digits is an error.
    """
    text = ids.cast("string")
    size = F.length(text)
    tens = F.get(F.array(*[F.lit(t).cast("long") for t in _TENS]), ID_DIGITS - size)
    digits = text.rlike(f"^[0-9]{{1,{ID_DIGITS}}}$")
    order = F.shiftleft(F.when(digits, text).cast("long") * tens, 5) + size
    wrong = F.raise_error(F.concat(F.lit("not an id of whole digits: "), text)).cast("long")
    return F.when(text.isNull() | digits, order).otherwise(wrong)


def id_of_order(order: Column) -> Column:
    """The number :func:`id_order` was made from."""
    tens = F.array(*[F.lit(t).cast("long") for t in _TENS])
    return F.call_function("div", F.shiftright(order, 5), F.get(tens, (F.lit(ID_DIGITS) - order.bitwiseAND(31)).cast("int")))


def last_writer(cells: DataFrame) -> DataFrame:
    """One label per raster cell: the last id in string order (``_key`` of :func:`id_order`) as a number, plus one."""
    best = cells.groupBy("sample", "x", "y").agg(F.max("_key").alias("_key"))
    return best.select("sample", "x", "y", (id_of_order(F.col("_key")) + 1).alias("label"))


def auto_offset(nuclei: DataFrame) -> DataFrame:
    """Half window around a nucleus per sample, twice the 99% quantile of its size."""
    sized = nuclei.select("sample", F.sqrt("area").alias("_size"))
    q = exact_quantiles(sized, ["sample"], "_size", {"q99": 0.99})
    return q.select("sample", (F.col("q99") * 2).cast("int").alias("offset"))
