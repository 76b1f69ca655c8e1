"""Nucleotide strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revcomp(seq: Column) -> Column:
    """Reverse complement; letters other than ACGT stay as they are."""
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def canonical(kmer: Column) -> Column:
    """The smaller of a k-mer and its reverse complement."""
    return F.least(kmer, revcomp(kmer))


def capital(base: Column) -> Column:
    """Nucleotide letters in upper case; other letters stay as they are."""
    return F.translate(base, "acgtn", "ACGTN")
