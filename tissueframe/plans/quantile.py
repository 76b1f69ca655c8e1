"""Exact quantiles of groups that may be too large for one task.

Ranks are selected by range partition: rows of a group lie in value order over several
partitions, the number of rows in each tells which one holds a rank, and only there
values are ordered. No task takes more of a group than a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.plans.lineage import store
from tissueframe.plans.skew import attach

# Relative rank error of the sketch is 1 / SKETCH; the bracket keeps three times
# that on both sides, so about 6 / SKETCH of a group's rows reach the exact step.
SKETCH = 20_000


def select_ranks(counted: DataFrame, key: Sequence[str], ranks: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Values at zero-based ranks: ``(key, ids, rank, lo, hi)`` at the whole ranks below and above.

    ``counted`` has one row ``(key, v, c)`` for each distinct value, ``c`` counts its rows; a NULL value comes first.
    ``ranks`` has ``(key, ids, rank)``. The values are written once in their partitions, so a task that is
    repeated finds the same ones.
    """
    key, ids = list(key), list(ids)
    placed = store(counted.select(*key, "v", "c").repartitionByRange(*key, "v").withColumn("_part", F.spark_partition_id()), "ranked-values")
    sums = placed.groupBy(*key, "_part").agg(F.sum("c").alias("_own"))
    earlier = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_own").over(earlier), F.lit(0)))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("_side"), F.floor("rank").alias("_at")), F.struct(F.lit(1).alias("_side"), F.ceil("rank").alias("_at"))))
    wanted = ranks.select(*key, *ids, "rank", sides.alias("_s")).select(*key, *ids, "rank", "_s.*").join(sums, key)
    wanted = wanted.where((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_own"))).drop("_own")
    run = Window.partitionBy(*key, "_part", *ids, "_side").orderBy(F.col("v").asc_nulls_first())
    met = placed.join(wanted, [*key, "_part"]).withColumn("_upto", F.col("_before") + F.sum("c").over(run))

    def at(side: int) -> Column:
        # The value at a rank is the first with more rows up to it.
        return F.min(F.when((F.col("_side") == side) & (F.col("_upto") > F.col("_at")), F.col("v")))

    return met.groupBy(*key, *ids).agg(F.first("rank").alias("rank"), at(0).alias("lo"), at(1).alias("hi"))


def _between(low: Column, high: Column, rank: Column) -> Column:
    part = rank - F.floor(rank)
    return F.when(part > 0, (1 - part) * low + part * high).otherwise(low)


def weighted_quantiles(df: DataFrame, by: Sequence[str], value: str, weight: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles of ``value``, each row counting ``weight`` times, one column each.

    The result equals ``percentile(value, p, weight)``, which keeps all distinct values of a group in one buffer. NULL and
    NaN values and weights of 0 are skipped; a group without others is missing.
    """
    by = list(by)
    data = df.select(*by, F.col(value).cast("double").alias("v"), F.col(weight).cast("long").alias("c"))
    data = data.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("c") > 0))
    counted = data.groupBy(*by, "v").agg(F.sum("c").alias("c"))
    totals = data.groupBy(*by).agg(F.sum("c").alias("_n"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("q"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank")) for i, p in enumerate(probs.values())]))
    found = select_ranks(counted, by, totals.select(*by, wanted.alias("_w")).select(*by, "_w.*"), ["q"])
    point = _between(F.col("lo"), F.col("hi"), F.col("rank"))
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("q") == i, point)).alias(name) for i, name in enumerate(probs)])


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: dict[str, float],
    sketch: int = SKETCH,
) -> DataFrame:
    """Linear-interpolation quantiles of ``value`` by group, one column each.

    The built-in exact ``percentile`` keeps every distinct value of a group in
    one buffer. Here a bounded sketch first brackets each wanted rank; then only
    the values inside the brackets are counted and their ranks selected, while everything
    below them is a plain partial count. The result equals ``percentile``.
    NULL and NaN values are skipped; an empty group gives NULL.
    """
    by = list(by)
    key = by or ["_all"]
    data = df.select(*by, F.col(value).cast("double").alias("_v"))
    data = data.where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if not by:
        data = data.withColumn("_all", F.lit(0))
    margin = 3.0 / sketch
    edges = []
    for p in probs.values():
        edges += [max(0.0, p - margin), min(1.0, p + margin)]
    bounds = data.groupBy(*key).agg(
        F.percentile_approx("_v", edges, sketch).alias("_edges"),
        F.count("*").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    # Below this many rows the sketch's margin is less than one rank, and the bracket is the whole range.
    narrow = F.col("_n") * margin < 3
    wanted = F.array(
        *[
            F.struct(
                F.lit(i).alias("q"),
                (F.lit(float(p)) * (F.col("_n") - 1)).alias("rank"),
                F.when(narrow | F.lit(edges[2 * i] == 0.0), F.col("_min"))
                .otherwise(F.col("_edges")[2 * i])
                .alias("low"),
                F.when(narrow | F.lit(edges[2 * i + 1] == 1.0), F.col("_max"))
                .otherwise(F.col("_edges")[2 * i + 1])
                .alias("high"),
            )
            for i, p in enumerate(probs.values())
        ]
    )
    bounds = bounds.select(*key, "_n", wanted.alias("_w"))
    tagged = attach(data, bounds.select(*key, "_w"), key, "inner", spread=["_v"])
    # Values below a bracket keep no identity: they collapse to one NULL value.
    slots = tagged.select(
        *key,
        F.explode(
            F.transform(
                F.filter("_w", lambda w: F.col("_v") <= w["high"]),
                lambda w: F.struct(
                    w["q"].alias("q"),
                    F.when(F.col("_v") >= w["low"], F.col("_v")).alias("v"),
                ),
            )
        ).alias("_s"),
    )
    counted = (
        slots.groupBy(*key, F.col("_s.q").alias("q"), F.col("_s.v").alias("v"))
        .agg(F.count("*").alias("c"))
    )
    ranks = bounds.select(*key, F.explode("_w").alias("w")).select(
        *key, F.col("w.q").alias("q"), F.col("w.rank").alias("rank")
    )
    ends = select_ranks(counted, [*key, "q"], ranks, [])
    point = _between(F.col("lo"), F.col("hi"), F.col("rank"))
    # The bracket holds the rank, or the job fails.
    missed = F.raise_error(F.lit("a quantile lies outside the sketch's bracket")).cast("double")
    point = F.when(F.col("lo").isNull() | F.col("hi").isNull(), missed).otherwise(point)
    result = (
        ends.withColumn("_p", point)
        .groupBy(*key)
        .agg(
            *[
                F.max(F.when(F.col("q") == i, F.col("_p"))).alias(name)
                for i, name in enumerate(probs)
            ]
        )
    )
    return result if by else result.drop("_all")
