"""Sorting reads by species of origin with a k-mer index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.functions.sequence import revcomp
from tissueframe.operators.superkmers import match_pieces, summed_kmers, super_kmers
from tissueframe.plans.spread import spread

# Texts are cut into pieces of this length before k-mers are taken, because a
# substring of a long string costs the length of the string.
PIECE = 64


def kmers(
    df: DataFrame, keys: list[str], k: int, seq: str = "seq", alphabet: str | None = None, keep_short: bool = False
) -> DataFrame:
    """All canonical k-mers of each sequence, one row per position.

    The whole sequence is used: pieces overlap by ``k - 1``. The reverse
    complement is taken once per piece and read from its other end. With
    ``alphabet`` given (``ACGT``), k-mers holding any other letter are left out.
    ``keep_short`` gives a sequence without any k-mer one row with NULL, and
    turns k-mers left out into NULL, so that every sequence stays in sight.
    """
    s = F.col(seq)
    starts = F.when(F.length(s) >= k, F.sequence(F.lit(1), F.length(s) - k + 1, F.lit(PIECE)))
    explode = F.explode_outer if keep_short else F.explode
    piece = spread(df, *keys, seq).select(
        *keys, explode(F.transform(starts, lambda at: F.substr(s, at, F.lit(PIECE + k - 1)))).alias("_piece")
    ).withColumn("_back", revcomp(F.col("_piece")))
    size = F.length("_piece")
    cut = piece.select(
        *keys, "_piece", "_back", size.alias("_size"), explode(F.sequence(F.lit(1), size - k + 1)).alias("_at")
    )
    ahead = F.substr(F.col("_piece"), F.col("_at"), F.lit(k))
    behind = F.substr(F.col("_back"), F.col("_size") - k + 2 - F.col("_at"), F.lit(k))
    found = cut.select(*keys, F.least(ahead, behind).alias("kmer"))
    if not alphabet:
        return found
    plain = F.translate(F.col("kmer"), alphabet, "") == ""
    if keep_short:
        return found.withColumn("kmer", F.when(plain, F.col("kmer")))
    return found.where(plain)


def build_kmer_index(contigs: DataFrame, k: int, host: str = "host", graft: str = "graft", alphabet: str | None = None) -> DataFrame:
    """Canonical k-mers of both genomes with presence flags ``in_host, in_graft``.

    Runs of k-mers travel as one piece by their minimizer; repeated pieces collapse first.
    """
    flag = F.when(F.col("species") == host, 1).otherwise(2).cast("long")
    pieces = super_kmers(contigs.where(F.col("species").isin(host, graft)), ["species"], k, "seq", alphabet)
    pieces = pieces.groupBy("bucket", "size", "piece").agg(F.bit_or(flag).alias("_flag"))
    found = summed_kmers(pieces, ["_flag"], k, alphabet, either=True)
    return found.select("kmer", (F.col("_flag").bitwiseAND(1) > 0).alias("in_host"), (F.col("_flag").bitwiseAND(2) > 0).alias("in_graft"))


def save_kmer_index(index: DataFrame, table: str, buckets: int, overwrite: bool = False) -> None:
    """Write the index once as a table bucketed by k-mer; an existing one is kept."""
    spark = index.sparkSession
    if spark.catalog.tableExists(table) and not overwrite:
        return
    index.write.bucketBy(buckets, "kmer").sortBy("kmer").mode("overwrite").saveAsTable(table)


def match_reads(reads: DataFrame, index: DataFrame, k: int, keys: list[str] | None = None, alphabet: str | None = None) -> DataFrame:
    """K-mer hits per read: ``n_graft, n_host, n_both, n_missing``.

    Reads and index meet piece by piece (see :mod:`superkmers`); a read gets the sum
    over its pieces. Reads without any k-mer get their row of zeros from the list of reads.
    """
    keys = keys or ["sample", "read_id"]
    hits = match_pieces(reads, index, keys, k, alphabet)
    names = [n for n in hits.columns if n not in keys]
    zeros = reads.select(*keys, *[F.lit(0).cast("long").alias(n) for n in names])
    return hits.unionByName(zeros).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])


def read_class(matches: DataFrame) -> DataFrame:
    """Origin of each read from its k-mer hits.

    Only graft (or only host) evidence decides; both kinds are ``ambiguous``,
    only shared k-mers are ``both``, no hit is ``neither``. The external
    classifiers are not reproduced hit by hit; this is the rule of this package.
    """
    g, h, b = F.col("n_graft") > 0, F.col("n_host") > 0, F.col("n_both") > 0
    kind = (
        F.when(g & ~h, "graft").when(h & ~g, "host").when(g & h, "ambiguous").when(b, "both").otherwise("neither")
    )
    return matches.withColumn("class", kind)


def classify_reads(
    reads: DataFrame, index: DataFrame, k: int, mates: str = "pair", alphabet: str | None = None
) -> DataFrame:
    """Class of each read of ``(sample, mate, read_id, seq)``.

    ``mates="pair"`` votes with both mates together, ``"r2"`` with the second
    mate only.
    """
    if mates not in ("pair", "r2"):
        raise ValueError("mates must be pair or r2")
    used = reads if mates == "pair" else reads.where("mate = 2")
    return read_class(match_reads(used, index, k, alphabet=alphabet))


def class_summary(classes: DataFrame) -> DataFrame:
    """Reads and share per class and sample."""
    counts = classes.groupBy("sample", "class").agg(F.count("*").alias("n_reads"))
    totals = counts.groupBy("sample").agg(F.sum("n_reads").alias("_total"))
    return counts.join(totals, "sample").withColumn("share", F.col("n_reads") / F.col("_total")).drop("_total")


# Species name of the two classes that are kept.
SPECIES = {"host": "mouse", "graft": "human"}


def split_reads(reads: DataFrame, classes: DataFrame) -> DataFrame:
    """Reads of the kept classes with their species; the other classes drop out."""
    named = classes.where(F.col("class").isin(*SPECIES)).select(
        "sample", "read_id", F.when(F.col("class") == "host", SPECIES["host"]).otherwise(SPECIES["graft"]).alias("species")
    )
    return reads.join(named, ["sample", "read_id"], "inner")


def mates_of(first: DataFrame, second: DataFrame) -> DataFrame:
    """First mates whose second mate is listed, matched by parsed read id."""
    return first.join(second.select("sample", "read_id").distinct(), ["sample", "read_id"], "left_semi")


def sort_reads(reads: DataFrame, parts: int | None = None) -> DataFrame:
    """Reads in order of sample, mate and id, over range partitions."""
    return _ranged(reads, ["sample", "mate", "read_id"], parts)


def sort_by_barcode(alignments: DataFrame, parts: int | None = None) -> DataFrame:
    """Alignments in order of cell barcode; a crowded barcode spans several tasks."""
    return _ranged(alignments, ["sample", "cb", "chrom", "pos", "read_id"], parts)


def _ranged(df: DataFrame, columns: list[str], parts: int | None) -> DataFrame:
    if parts:
        return df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    return df.orderBy(*columns)
