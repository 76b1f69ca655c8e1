"""Joins of a large table with a keyed lookup table when keys may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16
_SALT = "_salt"
#: Rows of a lookup, repeated ones counted, that the driver may have to hold for a broadcast.
BROADCAST_ROWS = 100_000


def bounded(lookup: DataFrame, rows: int) -> DataFrame:
    """``lookup`` of about ``rows`` rows, which is joined by shuffle if that is more than :data:`BROADCAST_ROWS`.

    Spark's own size check takes a stored table for as large as its files, and a table added up or repeated behind the scan
    too; its rows in the driver's memory may be fifty times as large.
    """
    return lookup if rows <= BROADCAST_ROWS else lookup.hint("merge")


def attach(
    big: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` with ``lookup``, which holds at most one row per key.

    With ``spread`` columns given, the rows of one key are dealt over ``salts``
    join partitions by a hash of those columns and the lookup row is repeated
    for each of them, so a key holding a third of all rows does not end in one
    task. The hash is taken from the data, not from ``rand()``: a recomputed
    task deals its rows in the same way. No broadcast is forced; Spark picks one
    when its own size check allows.
    """
    on = list(on)
    if not spread:
        return big.join(lookup, on, how)
    dealt = big.withColumn(_SALT, F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    repeated = lookup.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return dealt.join(repeated, [*on, _SALT], how).drop(_SALT)
