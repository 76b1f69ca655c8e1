"""JSON text of parameters, regions and slide properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tissueframe.schemas import ROI


def parse_params(text: Column) -> Column:
    """A flat JSON object as ``map<string,string>``."""
    return F.from_json(text, "map<string,string>")


def parse_roi(text: Column) -> Column:
    """Region text as a map from axis to location and size."""
    return F.from_json(text, ROI)


def format_params(value: Column) -> Column:
    """JSON text of a struct, map or array."""
    return F.to_json(value)
