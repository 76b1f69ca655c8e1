"""Optical density, stain mixing and colour spaces, channel by channel."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_od(channel: Column) -> Column:
    """Optical density of an 8-bit channel; 0 counts as 1."""
    return F.greatest(-F.log(F.greatest(channel, F.lit(1)) / F.lit(255.0)), F.lit(1e-6))


def od_to_rgb(density: Column) -> Column:
    """8-bit channel of an optical density, truncated."""
    return (F.lit(255) * F.exp(-F.greatest(density, F.lit(1e-6)))).cast("int")


def concentration_to_rgb(density: Column) -> Column:
    """As :func:`od_to_rgb` without the lower limit; keeps the low 8 bits, as a byte does."""
    return (F.lit(255) * F.exp(-density)).cast("int").bitwiseAND(F.lit(255))


def lasso2(od: list[Column], first: list[Column], second: list[Column], lam: float = 0.01) -> Column:
    """Non-negative two-stain lasso of one pixel: struct ``(c1, c2)``.

    Both stain rows have unit length, so the optimum of
    ``|od - c1 first - c2 second|^2 / 2 + lam (c1 + c2)`` is either the solution
    with both stains, or one stain alone, or nothing.
    """
    def dot(a, b):
        return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]

    c = dot(first, second)
    g1, g2 = dot(first, od) - lam, dot(second, od) - lam
    det = 1 - c * c
    a, b = F.try_divide(g1 - c * g2, det), F.try_divide(g2 - c * g1, det)
    only1 = F.greatest(g1, F.lit(0.0))
    both = (a >= 0) & (b >= 0)
    one = g2 - c * only1 <= 0
    return F.struct(
        F.when(both, a).when(one, only1).otherwise(F.lit(0.0)).alias("c1"),
        F.when(both, b).when(one, F.lit(0.0)).otherwise(F.greatest(g2, F.lit(0.0))).alias("c2"),
    )


# sRGB to XYZ (D65) matrix, white point, CIELAB constants.
RGB_TO_XYZ = (
    (0.412453, 0.357580, 0.180423),
    (0.212671, 0.715160, 0.072169),
    (0.019334, 0.119193, 0.950227),
)
WHITE_D65 = (0.95047, 1.0, 1.08883)


def rgb_to_lab(r: Column, g: Column, b: Column) -> Column:
    """CIELAB struct ``(l, a, b)`` of 8-bit sRGB channels."""

    def linear(channel):
        v = channel / F.lit(255.0)
        return F.when(v > 0.04045, F.pow((v + 0.055) / 1.055, F.lit(2.4))).otherwise(v / 12.92)

    lin = [linear(c) for c in (r, g, b)]

    def warped(row, white):
        t = (row[0] * lin[0] + row[1] * lin[1] + row[2] * lin[2]) / white
        return F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16.0 / 116.0)

    fx, fy, fz = [warped(row, w) for row, w in zip(RGB_TO_XYZ, WHITE_D65)]
    return F.struct(
        (116 * fy - 16).alias("l"), (500 * (fx - fy)).alias("a"), (200 * (fy - fz)).alias("b")
    )
