"""Overlap joins of intervals whose lengths differ by orders of magnitude."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each level holds intervals up to so many times as long as the level before.
STEP = 4


def _reach(level: Column, base: int) -> Column:
    """Longest interval of a level."""
    return (F.lit(base) * F.pow(F.lit(STEP), level)).cast("long")


def _level(length: Column, base: int) -> Column:
    """The first level whose intervals are that long; settled on whole numbers, so no rounding decides."""
    steps, reach = F.lit(0), base
    while reach < 1 << 62:
        steps = steps + (length > reach).cast("int")
        reach *= STEP
    return steps


def _bin(at: Column, level: Column, base: int) -> Column:
    """Bins of a level are as wide as its longest interval."""
    return F.floor(at / _reach(level, base)).cast("long")


def interval_join(
    spans: DataFrame, ranges: DataFrame, by: Sequence[str], span: tuple[str, str], low: str, high: str, base: int
) -> DataFrame:
    """Rows of ``spans`` with the rows of ``ranges`` whose ``[low, high)`` overlaps ``[span)``.

    A range lies in one bin, that of its start on the level of its length: level 0 is for lengths up to
    ``base``, each further one for :data:`STEP` times as long. A span looks up, on every level that has ranges, the bins in which an
    overlapping range may start, two or three; so no range is repeated, however long, and a pair meets once. Only the numbers of the levels that occur (32 at most) pass the driver. Empty ranges overlap nothing.

    Spans should be short beside ``base``: a longer one looks up more bins. Hot bins are left to adaptive
    skew splitting, which applies as the result is not assumed to keep the join's partitioning.
    """
    begin, end = span
    one = spans.withColumn("_spans", F.array(F.struct(F.col(begin).alias("lo"), F.col(end).alias("hi"))))
    return spans_join(one, ranges, by, "_spans", low, high, base).drop("_spans")


def spans_join(
    rows: DataFrame, ranges: DataFrame, by: Sequence[str], spans: str, low: str, high: str, base: int
) -> DataFrame:
    """As :func:`interval_join`, for rows with several spans ``array<struct<lo, hi>>``; a pair meets once for all of them."""
    length = F.col(high) - F.col(low)
    binned = ranges.where(length > 0).withColumn("_level", _level(length, base))
    levels = sorted(r["_level"] for r in binned.select("_level").distinct().collect())
    right = binned.withColumn("_bin", _bin(F.col(low), F.col("_level"), base))

    def asked(span: Column, n: int) -> Column:
        first, last = span["lo"] - _reach(F.lit(n), base) + 1, span["hi"] - 1
        bins = F.sequence(_bin(first, F.lit(n), base), _bin(last, F.lit(n), base))
        return F.transform(bins, lambda b: F.struct(F.lit(n).alias("_level"), b.alias("_bin")))

    probes = F.flatten(F.transform(spans, lambda s: F.flatten(F.array(*[asked(s, n) for n in levels])))) if levels else None
    empty = F.expr("cast(array() as array<struct<_level:int,_bin:bigint>>)")
    left = rows.select(*[F.col(c) for c in rows.columns], F.inline(empty if probes is None else F.array_distinct(probes)))
    kept = [c for c in ranges.columns if c not in by]
    a, b = left.alias("a"), right.alias("b")
    match = (F.col("a._level") == F.col("b._level")) & (F.col("a._bin") == F.col("b._bin"))
    for key in by:
        match = match & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    match = match & F.exists(f"a.{spans}", lambda s: (s["lo"] < F.col(f"b.{high}")) & (F.col(f"b.{low}") < s["hi"]))
    return a.join(b, match).select(*[F.col(f"a.{c}") for c in rows.columns], *[F.col(f"b.{c}") for c in kept])
