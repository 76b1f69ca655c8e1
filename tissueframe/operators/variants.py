"""Base pileups and B-allele frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.functions.sequence import capital
from tissueframe.plans.skew import SALTS
from tissueframe.plans.spread import tasks_for

# Bases that a task of the pileup counts at a time, and positions whose alignments are dealt together.
SHARE = 1 << 20
REGION = 1024

# CIGAR letters by what they advance.
ALIGNED = ("M", "=", "X")
READ_ONLY = ("I", "S")
REFERENCE_ONLY = ("D", "N")


def aligned_segments(cigar: Column) -> Column:
    """Aligned stretches of a CIGAR: ``array<struct<q, r, n>>``.

    ``q`` and ``r`` are the zero-based offsets in the read and on the reference,
    ``n`` is the length.
    """
    parts = F.regexp_extract_all(cigar, F.lit(r"([0-9]+[MIDNSHP=X])"), F.lit(1))
    start = F.struct(
        F.lit(0).alias("q"),
        F.lit(0).alias("r"),
        F.expr("cast(array() as array<struct<q:int,r:int,n:int>>)").alias("done"),
    )

    def walk(state, part):
        n = F.substr(part, F.lit(1), F.length(part) - 1).cast("int")
        kind = F.substr(part, F.length(part), F.lit(1))
        both = kind.isin(*ALIGNED)
        here = F.struct(state["q"].alias("q"), state["r"].alias("r"), n.alias("n"))
        return F.struct(
            (state["q"] + F.when(both | kind.isin(*READ_ONLY), n).otherwise(0)).alias("q"),
            (state["r"] + F.when(both | kind.isin(*REFERENCE_ONLY), n).otherwise(0)).alias("r"),
            F.when(both, F.array_append(state["done"], here)).otherwise(state["done"]).alias("done"),
        )

    return F.aggregate(parts, start, walk, lambda s: s["done"])


def pileup(alignments: DataFrame, min_mapq: int = 50, min_bq: int = 0) -> DataFrame:
    """Reads per base at each position: ``sample, species, chrom, pos, base, n``.

    Reads below the mapping quality and bases below the base quality are left
    out. Alignments are dealt by region and salt over as many tasks as their
    bases need, and each task counts its bases before they are shuffled by
    position: deep positions do not gather in one place, and the counts that a
    task holds do not grow with the input.
    """
    good = alignments.where((F.col("mapq") >= min_mapq) & F.col("cigar").isNotNull() & (F.col("cigar") != "*"))
    parts = tasks_for(good, F.length("seq"), SHARE)
    place = ["sample", "species", "chrom"]
    deal = F.xxhash64(*place, F.floor(F.col("pos") / REGION), F.pmod(F.xxhash64("read_id"), F.lit(SALTS)))
    good = good.select(*place, "pos", "cigar", "seq", "qual", deal.alias("_deal")).repartition(parts, "_deal")
    segments = good.select(*place, "_deal", "pos", "seq", "qual", F.explode(aligned_segments(F.col("cigar"))).alias("_s"))
    bases = segments.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_s.n") - 1)))
    at = F.col("_s.q") + F.col("_i") + 1
    quality = F.ascii(F.substr(F.col("qual"), at, F.lit(1))) - 33
    bases = bases.select(
        *place,
        "_deal",
        (F.col("pos") + F.col("_s.r") + F.col("_i")).alias("pos"),
        capital(F.substr(F.col("seq"), at, F.lit(1))).alias("base"),
        quality.alias("_q"),
    )
    if min_bq > 0:
        bases = bases.where(F.col("_q") >= min_bq)
    counted = bases.groupBy("_deal", *place, "pos", "base").agg(F.count("*").alias("n")).drop("_deal")
    return counted.repartition(parts, *place, "pos").groupBy(*place, "pos", "base").agg(F.sum("n").alias("n"))


def pileup_with_ref(piles: DataFrame, contigs: DataFrame, size: int) -> DataFrame:
    """Reference base beside each pileup row.

    ``contigs`` are chunks of at most ``size`` letters (plus any overlap) whose
    offsets are multiples of ``size``; positions are one based. Contigs are told
    apart by species, as two genomes share names.
    """
    chunks = contigs.select(
        "species", F.col("name").alias("chrom"), F.floor(F.col("offset") / size).alias("_chunk"), F.col("offset"), F.col("seq").alias("_ref")
    )
    keyed = piles.withColumn("_chunk", F.floor((F.col("pos") - 1) / size))
    met = keyed.join(chunks, ["species", "chrom", "_chunk"], "left")
    base = capital(F.substr(F.col("_ref"), (F.col("pos") - F.col("offset")).cast("int"), F.lit(1)))
    return met.withColumn("ref", base).drop("_chunk", "offset", "_ref")


def locus_share(piles: DataFrame) -> DataFrame:
    """Coverage of the position and share of each base; a locus has a row per base."""
    locus = Window.partitionBy("sample", "species", "chrom", "pos")
    return piles.withColumn("cov", F.sum("n").over(locus)).withColumn("share", F.col("n") / F.col("cov"))


def snv_baf(piles: DataFrame, min_cov: int = 20, min_alt: int = 4, min_maf: float = 0.1) -> DataFrame:
    """Loci with a minor allele: ``ref, alt, cov, alt_cov, maf``.

    ``piles`` carries ``ref``. The alternative is the most frequent base that is
    not the reference, ties by letter; its share of the coverage is the
    frequency. All three limits are inclusive.
    """
    other = F.col("base") != F.col("ref")
    loci = piles.groupBy("sample", "species", "chrom", "pos").agg(
        F.sum("n").alias("cov"),
        F.max("ref").alias("ref"),
        F.min(F.when(other, F.struct((-F.col("n")).alias("m"), F.col("base").alias("base")))).alias("_a"),
    )
    called = loci.select(
        "sample",
        "species",
        "chrom",
        "pos",
        "ref",
        F.col("_a.base").alias("alt"),
        "cov",
        (-F.col("_a.m")).alias("alt_cov"),
        (-F.col("_a.m") / F.col("cov")).alias("maf"),
    )
    return called.where((F.col("cov") >= min_cov) & (F.col("alt_cov") >= min_alt) & (F.col("maf") >= F.lit(min_maf)))


def contig_sizes(contigs: DataFrame) -> DataFrame:
    """Length of each contig from its chunks."""
    return contigs.groupBy("species", "name").agg(F.max(F.col("offset") + F.length("seq")).alias("length"))
