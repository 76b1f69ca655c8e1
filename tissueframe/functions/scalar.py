"""Rounding, identifiers, distances and other plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trunc_int(value: Column) -> Column:
    """Drop the fraction, towards zero."""
    return value.cast("int")


def round_even(value: Column) -> Column:
    """Round halves to the even neighbour."""
    return F.bround(value, 0)


def tile_id(number: Column) -> Column:
    """``tile-00000001`` for 1."""
    return F.concat(F.lit("tile-"), F.lpad(number.cast("string"), 8, "0"))


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(squared_distance(x1, y1, x2, y2).cast("double"))


def in_disk(dx: Column, dy: Column, radius: Column) -> Column:
    """Strictly inside the disk, as raster disks are drawn."""
    return dx * dx + dy * dy < radius * radius


def axis_scale(low_width: Column, low_height: Column, width: Column, height: Column) -> Column:
    """Mean of the two axis ratios between a small image and its slide."""
    return 0.5 * (low_height / height) + 0.5 * (low_width / width)


def base_name(path: Column) -> Column:
    """File name without folders and without its extensions."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^/]*)?$", 1)


def mate_of_path(path: Column) -> Column:
    """1 or 2 from a ``mate=R1`` / ``mate=R2`` folder, else from ``R1`` / ``R2`` in a file name, NULL if neither occurs."""
    keyed = F.regexp_extract(path, r"/mate=R([12])/", 1)
    found = F.when(keyed != "", keyed).otherwise(F.regexp_extract(path, r"R([12])[^/]*$", 1))
    return F.when(found != "", found.cast("int"))


def species_of_path(path: Column) -> Column:
    """``mouse`` or ``human`` when the file path names one of them."""
    found = F.regexp_extract(path, r"(mouse|human)", 1)
    return F.when(found != "", found)


def sample_of_path(path: Column) -> Column:
    """``X`` from a ``sample=X`` folder, else the name of the parent folder."""
    keyed = F.regexp_extract(path, r"/sample=([^/]+)/", 1)
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.when(keyed != "", keyed).otherwise(parent)


def binarise_half(value: Column, maximum: Column) -> Column:
    """1 from half of the maximum on, else 0."""
    return (value >= maximum / 2).cast("int")
