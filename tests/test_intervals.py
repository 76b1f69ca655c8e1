"""Interval joins against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tissueframe.operators import counts
from tissueframe.plans.intervals import interval_join


def make(seed=1):
    rng = random.Random(seed)
    ranges, spans = [], []
    for i in range(400):
        length = int(10 ** (rng.random() * 6.3)) if i else 2_000_000
        start = rng.randrange(-500, 3_000_000)
        ranges.append((rng.choice("ab"), start, start + (length if i % 40 else 0), i))
    edges = [v for r in ranges for v in r[1:3]]
    for i in range(1500):
        start = rng.choice([rng.randrange(-100, 3_000_000), rng.choice(edges) + rng.randrange(-100, 100)])
        spans.append((rng.choice("abc"), start, start + rng.choice([1, 1, 90, 150, 5000]), i))
    return spans, ranges


@pytest.mark.parametrize("base", [1, 64, 512, 1 << 22])
def test_pairs_equal_all_pairs(spark, base):
    spans, ranges = make()
    left = spark.createDataFrame(spans, "chrom string, lo long, hi long, i int")
    right = spark.createDataFrame(ranges, "chrom string, start long, end long, j int")
    got = interval_join(left, right, ["chrom"], ("lo", "hi"), "start", "end", base)
    found = sorted((r.i, r.j) for r in got.collect())
    assert found == sorted((i, j) for c, a, b, i in spans for d, s, e, j in ranges if c == d and a < e and s < b and s < e)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_spans_look_up_few_bins_a_level(spark):
    spans, ranges = make()
    left = spark.createDataFrame([s for s in spans if s[2] - s[1] <= 150], "chrom string, lo long, hi long, i int")
    right = spark.createDataFrame(ranges, "chrom string, start long, end long, j int")
    from tissueframe.plans import intervals

    length = F.col("end") - F.col("start")
    levels = right.where(length > 0).select(intervals._level(length, 512).alias("n")).distinct().collect()
    assert len(levels) == 7
    per_level = []
    for (n,) in levels:
        low = intervals._bin(F.col("lo") - intervals._reach(F.lit(n), 512) + 1, F.lit(n), 512)
        per_level.append(left.agg(F.avg(intervals._bin(F.col("hi") - 1, F.lit(n), 512) - low + 1)).first()[0])
    assert max(per_level) < 2.4


def test_empty_sides(spark):
    left = spark.createDataFrame([("a", 1, 5, 0)], "chrom string, lo long, hi long, i int")
    none = spark.createDataFrame([], "chrom string, start long, end long, j int")
    assert interval_join(left, none, ["chrom"], ("lo", "hi"), "start", "end", 64).count() == 0
    full = spark.createDataFrame([("a", 1, 5, 0)], none.schema)
    assert interval_join(left.limit(0), full, ["chrom"], ("lo", "hi"), "start", "end", 64).count() == 0


@pytest.mark.parametrize("size", [8, 512])
def test_jumping_reads_equal_all_pairs(spark, size):
    rng = random.Random(3)
    reads, pieces = [], {}
    for i in range(300):
        steps, at, parts = [], 0, []
        for k in range(rng.randrange(1, 4)):
            n, gap = rng.randrange(1, 60), rng.choice([0, 5, 900, 40_000])
            if k:
                steps.append(f"{gap + 1}N")
                at += gap + 1
            steps.append(f"{n}M")
            parts.append((at, at + n))
            at += n
        pos = rng.randrange(200_000)
        reads.append((f"r{i}", "human", "c", pos, "".join(steps) if i % 50 else rng.choice([None, "*", "5S"])))
        text = reads[-1][4]
        pieces[f"r{i}"] = [] if text == "5S" else [(pos + a, pos + b) for a, b in (parts if i % 50 else [(0, 1)])]
    spots = [(s := rng.randrange(240_000), s + rng.choice([3, 50, 2000, 100_000])) for _ in range(200)]
    intervals = [("human", "c", s, e, "exon", f"g{j}") for j, (s, e) in enumerate(spots)]
    got = counts.annotate_intervals(
        spark.createDataFrame(reads, "read_id string, species string, chrom string, pos long, cigar string"),
        spark.createDataFrame(intervals, "species string, chrom string, start long, end long, kind string, gene_id string"), size,
    )
    expected = sorted((r, f"g{j}") for r, own in pieces.items() for j, (s, e) in enumerate(spots) if any(a < e and s < b for a, b in own))
    assert sorted((r.read_id, r.hit_gene) for r in got.collect()) == expected


def test_an_alignment_asks_each_bin_once(spark):
    from tissueframe.operators import counts

    reads = spark.createDataFrame([("r1", "h", "c", 10, "2M1D2M"), ("r2", "h", "c", 10, "2M3N3M"), ("r3", "h", "c", 10, "*")], "read_id string, species string, chrom string, pos long, cigar string")
    genes = spark.createDataFrame([("h", "c", 8, 16, "exon", "G1"), ("h", "c", 12, 15, "intron", "G2"), ("h", "c", 12, 13, "exon", "G3")], "species string, chrom string, start long, end long, kind string, gene_id string")
    found = counts.annotate_intervals(reads, genes, size=8)
    assert "array_distinct" in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.read_id, r.hit_gene) for r in found.collect())
    assert got == [("r1", "G1"), ("r1", "G2"), ("r2", "G1"), ("r3", "G1")]
