"""Sparse gene by spot matrices in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.plans.ranking import consecutive


def merge_matrices(mouse: DataFrame, human: DataFrame) -> DataFrame:
    """Counts of both species in one table, genes keyed by species and id."""
    return mouse.withColumn("species", F.lit("mouse")).unionByName(human.withColumn("species", F.lit("human")))


def merged_barcodes(merged: DataFrame) -> DataFrame:
    """Barcodes of either species: the rows of the merged matrix."""
    return merged.select("sample", "barcode").distinct()


def dense_view(merged: DataFrame, genes: Sequence[str]) -> DataFrame:
    """Chosen genes as columns, absent counts as 0."""
    # One sum a gene: a pivot would first add up every gene of every barcode.
    sums = [F.coalesce(F.sum(F.when(F.col("gene_id") == g, F.col("count"))), F.lit(0)).alias(g) for g in genes]
    return merged.groupBy("sample", "barcode").agg(*sums)


def union_genes(*dims: DataFrame) -> DataFrame:
    """Gene tables of several species below each other."""
    result = dims[0]
    for other in dims[1:]:
        result = result.unionByName(other)
    return result.distinct()


def assign_ordinals(dim: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """One-based matrix ordinals of a dimension table, in key order per matrix."""
    return consecutive(dim, by, [F.col(c).asc() for c in order], name)


def union_patches(*parts: DataFrame) -> DataFrame:
    """Results of patches below each other."""
    result = parts[0]
    for other in parts[1:]:
        result = result.unionByName(other)
    return result
