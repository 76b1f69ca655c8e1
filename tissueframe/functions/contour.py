"""Shape of closed contours given as ``array<array<number>>`` of ``[x, y]``."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _next_points(contour: Column) -> Column:
    """The contour shifted by one, so that point i meets point i + 1."""
    return F.concat(F.slice(contour, 2, F.greatest(F.size(contour) - 1, F.lit(0))), F.slice(contour, 1, 1))


def edges_of(contour: Column) -> Column:
    """Edges ``(x, y) -> (u, v)`` of the closed contour, as an array of structs."""
    return _once(contour, _edges_of)


def _edges_of(contour: Column) -> Column:
    return F.zip_with(
        contour,
        _next_points(contour),
        lambda p, q: F.struct(
            p[0].cast("double").alias("x"),
            p[1].cast("double").alias("y"),
            q[0].cast("double").alias("u"),
            q[1].cast("double").alias("v"),
        ),
    )


def _total(edges: Column, term) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + term(e))


def contour_perimeter(contour: Column) -> Column:
    """Length of the closed polygon."""
    return _total(
        edges_of(contour),
        lambda e: F.sqrt((e["u"] - e["x"]) * (e["u"] - e["x"]) + (e["v"] - e["y"]) * (e["v"] - e["y"])),
    )


def contour_moments(contour: Column) -> Column:
    """Raw moments up to order two by Green's formula, as a struct.

    Clockwise contours give the same moments as counter-clockwise ones.
    """
    edges = edges_of(contour)

    def cross(e):
        return e["x"] * e["v"] - e["u"] * e["y"]

    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("m00", "m10", "m01", "m20", "m11", "m02")])
    sums = F.aggregate(
        edges,
        zero,
        lambda s, e: F.struct(
            (s["m00"] + cross(e) / 2).alias("m00"),
            (s["m10"] + cross(e) * (e["x"] + e["u"]) / 6).alias("m10"),
            (s["m01"] + cross(e) * (e["y"] + e["v"]) / 6).alias("m01"),
            (s["m20"] + cross(e) * (e["x"] * e["x"] + e["x"] * e["u"] + e["u"] * e["u"]) / 12).alias("m20"),
            (
                s["m11"]
                + cross(e)
                * (2 * e["x"] * e["y"] + e["x"] * e["v"] + e["u"] * e["y"] + 2 * e["u"] * e["v"])
                / 24
            ).alias("m11"),
            (s["m02"] + cross(e) * (e["y"] * e["y"] + e["y"] * e["v"] + e["v"] * e["v"]) / 12).alias("m02"),
        ),
        lambda s: F.struct(
            *[
                (F.when(s["m00"] < 0, -s[n]).otherwise(s[n])).alias(n)
                for n in ("m00", "m10", "m01", "m20", "m11", "m02")
            ]
        ),
    )
    return sums


def contour_shape(moments: Column, perimeter: Column) -> Column:
    """Area, orientation in degrees, eccentricity and circularity as a struct.

    Quantities that divide by zero (points, lines, circles) are NULL.
    """
    return _once(moments, lambda m: _shape_of(m, perimeter))


def _shape_of(moments: Column, perimeter: Column) -> Column:
    m00 = F.when(moments["m00"] > 0, moments["m00"])
    mu20 = (moments["m20"] - moments["m10"] * moments["m10"] / m00) / m00
    mu11 = (moments["m11"] - moments["m10"] * moments["m01"] / m00) / m00
    mu02 = (moments["m02"] - moments["m01"] * moments["m01"] / m00) / m00
    half_sum = (mu20 + mu02) / 2
    half_gap = 0.5 * F.sqrt(4 * mu11 * mu11 + (mu20 - mu02) * (mu20 - mu02))
    spread = 1 - F.try_divide(half_sum - half_gap, half_sum + half_gap)
    return F.struct(
        moments["m00"].alias("area"),
        F.degrees(0.5 * F.atan(F.try_divide(2 * mu11, mu20 - mu02))).alias("orientation"),
        F.when(spread >= 0, F.sqrt(spread)).alias("eccentricity"),
        F.try_divide(4 * math.pi * moments["m00"], perimeter * perimeter).alias("circularity"),
    )


def _between(p: Column, q: Column, first: int) -> Column:
    """Whole points from step ``first`` to the end of the edge p -> q."""
    steps = F.greatest(F.abs(q[0] - p[0]), F.abs(q[1] - p[1])).cast("int")

    def at(t, i):
        walked = F.floor(p[i] + t * F.try_divide(q[i] - p[i], steps)).cast("int")
        return F.when(t == steps, q[i].cast("int")).otherwise(walked)

    def run(start):
        return F.transform(F.sequence(F.lit(start), steps), lambda t: F.array(at(t, 0), at(t, 1)))

    empty = F.array().cast("array<array<int>>")
    return F.when(steps >= first, run(first)).otherwise(empty)


def close_contour(contour: Column) -> Column:
    """All whole points along the contour, with the closing edge at the end."""
    return _once(contour, _close)


def _close(contour: Column) -> Column:
    count = F.size(contour)
    empty = F.array().cast("array<array<int>>")
    inner = F.when(
        count > 1,
        F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))),
                lambda i: _between(F.element_at(contour, i), F.element_at(contour, i + 1), 1),
            )
        ),
    ).otherwise(empty)
    closing = _between(F.element_at(contour, -1), F.element_at(contour, 1), 0)
    return F.when(count > 0, F.concat(inner, closing))


def minimize_contour(contour: Column) -> Column:
    """Drop points that lie on a straight or diagonal run of their neighbours."""
    return _once(contour, _minimize)


def _minimize(contour: Column) -> Column:
    count = F.size(contour)

    def kept(point, i):
        before = F.element_at(contour, F.when(i == 0, count).otherwise(i))
        after = F.element_at(contour, F.when(i + 1 == count, F.lit(1)).otherwise(i + 2))
        dx, dy = F.abs(before[0] - after[0]), F.abs(before[1] - after[1])
        diagonal = (dx == dy) & (dx >= 2)
        flat = (dx >= 2) & (before[1] == after[1]) & (before[1] == point[1])
        upright = (dy >= 2) & (before[0] == after[0]) & (before[0] == point[0])
        return ~(diagonal | flat | upright)

    return F.filter(contour, kept)


def covered(edges: Column, x: Column, y: Column) -> Column:
    """Whether the contour of these edges holds the whole point, its border included."""

    def side(e):
        return (e["u"] - e["x"]) * (y - e["y"]) - (e["v"] - e["y"]) * (x - e["x"])

    on_border = F.exists(
        edges,
        lambda e: (side(e) == 0)
        & (x >= F.least(e["x"], e["u"]))
        & (x <= F.greatest(e["x"], e["u"]))
        & (y >= F.least(e["y"], e["v"]))
        & (y <= F.greatest(e["y"], e["v"])),
    )
    crossings = F.size(
        F.filter(
            edges,
            lambda e: ((e["y"] > y) != (e["v"] > y))
            & (x < F.try_divide((e["u"] - e["x"]) * (y - e["y"]), e["v"] - e["y"]) + e["x"]),
        )
    )
    return on_border | (crossings % 2 == 1)


def row_spans(edges: Column, y: Column) -> Column:
    """Spans ``(a, b)`` of whole x that :func:`covered` holds in row ``y``, for contours of whole numbers.

    The edges that cross the row are cut once; between an odd crossing and the
    next one lies the inside. Whole points on the border, which a crossing may leave out on the right,
    are spans of their own, so spans may overlap.
    """

    def slope(e):
        return F.try_divide((e["u"] - e["x"]) * (y - e["y"]), e["v"] - e["y"]) + e["x"]

    crossing = F.filter(edges, lambda e: (e["y"] > y) != (e["v"] > y))
    cuts = F.sort_array(F.transform(crossing, slope))
    inside = _once(
        cuts,
        lambda c: F.transform(
            c,
            lambda at, i: F.struct(
                F.ceil(at).alias("a"), F.when(i % 2 == 0, F.ceil(F.get(c, i + 1)) - 1).alias("b")
            ),
        ),
    )
    touching = F.filter(edges, lambda e: (y >= F.least(e["y"], e["v"])) & (y <= F.greatest(e["y"], e["v"])))

    def border(e):
        over = (e["u"] - e["x"]) * (y - e["y"])
        rise = e["v"] - e["y"]
        whole = F.when(F.try_mod(over, rise) == 0, (F.try_divide(over, rise) + e["x"]).cast("long"))
        flat = rise == 0
        return F.struct(
            F.when(flat, F.least(e["x"], e["u"]).cast("long")).otherwise(whole).alias("a"),
            F.when(flat, F.greatest(e["x"], e["u"]).cast("long")).otherwise(whole).alias("b"),
        )

    # A span without cells has no end, or one before its start.
    return F.filter(F.concat(inside, F.transform(touching, border)), lambda p: p["a"] <= p["b"])
