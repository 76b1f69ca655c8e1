"""Selected ranks against percentiles of whole groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tissueframe.plans import quantile


def make(n=4000, seed=2):
    rng = random.Random(seed)
    rows = [("hot", rng.choice([rng.gauss(0, 1), float(round(rng.gauss(0, 1))), 0.0]), rng.choice([0, 1, 1, 7, 1000])) for _ in range(n)]
    rows += [(f"g{i % 30}", rng.random(), 1 + i % 3) for i in range(200)]
    rows += [("one", 5.0, 1), ("two", 1.0, 1), ("two", 2.0, 1), ("nan", float("nan"), 4), ("nan", 3.0, 2), ("none", None, 3), ("zero", 1.0, 0)]
    return rows


PROBS = {"a": 0.0, "b": 0.01, "c": 0.5, "d": 0.99, "e": 1.0}


def test_weighted_equals_percentile_of_repeated_rows(spark):
    rows = make()
    frame = spark.createDataFrame(rows, "g string, v double, n long").repartition(5)
    found = {r.g: [r[p] for p in PROBS] for r in quantile.weighted_quantiles(frame, ["g"], "v", "n", PROBS).collect()}
    groups = {}
    for g, v, n in rows:
        if v is not None and v == v and n:
            groups.setdefault(g, []).append((v, n))
    assert set(found) == set(groups)
    for g, own in groups.items():
        whole = np.sort(np.repeat([v for v, _ in own], [n for _, n in own]))
        assert found[g] == pytest.approx(np.quantile(whole, list(PROBS.values())), abs=1e-12)


@pytest.mark.parametrize("sketch", [20_000, 100])
def test_exact_equals_percentile(spark, sketch):
    frame = spark.createDataFrame(make(), "g string, v double, n long").repartition(5)
    found = {r.g: [r[p] for p in PROBS] for r in quantile.exact_quantiles(frame, ["g"], "v", PROBS, sketch).collect()}
    plain = frame.where("v IS NOT NULL AND NOT isnan(v)").groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in PROBS.items()])
    expected = {r.g: [r[p] for p in PROBS] for r in plain.collect()}
    assert set(found) == set(expected)
    assert all(found[g] == pytest.approx(expected[g], abs=1e-12) for g in expected)


def test_a_group_lies_in_several_partitions(spark, monkeypatch):
    kept = []

    def keep(df, name):
        found = quantile_store(df, name)
        kept.append(found)
        return found

    quantile_store = quantile.store
    monkeypatch.setattr(quantile, "store", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(20_000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 20_011).cast("double").alias("v"), F.lit(3).alias("n"))
        (row,) = quantile.weighted_quantiles(frame, ["g"], "v", "n", {"m": 0.5, "q": 0.99}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["count"] for r in kept[0].groupBy("_part").count().collect()]
    assert len(parts) == 4 and max(parts) < 8_000
    whole = np.sort(np.repeat([i * 7919 % 20_011 for i in range(20_000)], 3))
    assert (row.m, row.q) == pytest.approx(tuple(np.quantile(whole, [0.5, 0.99])))


def test_empty(spark):
    none = spark.createDataFrame([], "g string, v double, n long")
    assert quantile.weighted_quantiles(none, ["g"], "v", "n", PROBS).count() == 0
