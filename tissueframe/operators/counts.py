"""Molecule counts: genes by spot, sequencing metrics, splicing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.operators.variants import aligned_segments
from tissueframe.plans.intervals import spans_join
from tissueframe.plans.spread import spread


def _tagged(alignments: DataFrame) -> DataFrame:
    return alignments.where(F.col("cb").isNotNull() & F.col("ub").isNotNull() & F.col("gene_id").isNotNull())


def count_umis(alignments: DataFrame, barcodes: DataFrame | None = None) -> DataFrame:
    """Distinct molecules per barcode and gene: ``sample, barcode, gene_id, count``.

    Distinctness is settled on (barcode, gene, molecule), so a crowded barcode is
    spread by its molecules. With ``barcodes`` (``sample, barcode``) every listed
    barcode appears, those without molecules with NULL gene and 0.
    """
    molecules = _tagged(alignments).select("sample", F.col("cb").alias("barcode"), "gene_id", "ub").distinct()
    counts = molecules.groupBy("sample", "barcode", "gene_id").agg(F.count("*").cast("int").alias("count"))
    if barcodes is None:
        return counts
    listed = barcodes.select("sample", "barcode").join(counts, ["sample", "barcode"], "left")
    return listed.withColumn("count", F.coalesce("count", F.lit(0)))


def seq_metrics(alignments: DataFrame, by: tuple[str, ...] = ("sample", "species")) -> DataFrame:
    """Reads, molecules, genes and spots per sample and species.

    Each distinct count is its own two-step aggregation on narrow keys; nothing
    is expanded per metric.
    """
    by = list(by)
    tagged = _tagged(alignments)
    reads = alignments.groupBy(*by).agg(F.count("*").alias("n_reads"), F.count_if(F.col("cb").isNotNull()).alias("n_tagged"))
    molecules = tagged.select(*by, "cb", "gene_id", "ub").distinct().groupBy(*by, "cb", "gene_id").agg(F.count("*").alias("n"))
    umis = molecules.groupBy(*by).agg(F.sum("n").alias("n_umis"))
    genes = molecules.select(*by, "gene_id").distinct().groupBy(*by).agg(F.count("*").alias("n_genes"))
    spots = molecules.select(*by, "cb").distinct().groupBy(*by).agg(F.count("*").alias("n_spots"))
    result = reads.join(umis, by, "left").join(genes, by, "left").join(spots, by, "left")
    return result.na.fill(0, ["n_umis", "n_genes", "n_spots"])


def annotate_intervals(alignments: DataFrame, intervals: DataFrame, size: int = 512) -> DataFrame:
    """Alignments with the exon and intron intervals their aligned segments overlap.

    ``intervals`` has ``species, chrom, start, end, kind, gene_id``, half open,
    and ``strand`` if strands are to agree (alignments need it too). A read whose
    alignment jumps (``N``) overlaps what its segments cover and not the gap;
    ``junction`` marks it. An alignment meets an interval once, however many of its
    segments cover it: it looks up each bin once for all of them. Intervals up to ``size`` long share the first level of bins
    (see :func:`interval_join`); the result does not depend on it.
    """
    named = intervals.withColumnRenamed("gene_id", "hit_gene")
    by = ["species", "chrom"]
    if "strand" in named.columns:
        by = by + ["strand"] if "strand" in alignments.columns else by
        named = named if "strand" in by else named.drop("strand")
    start = F.col("pos").cast("long")
    mapped = F.col("cigar").isNotNull() & (F.col("cigar") != "*")
    # The generator keeps the segments from being parsed again for each of their uses.
    parts = F.transform(
        F.array(aligned_segments(F.when(mapped, F.col("cigar")).otherwise("1M"))),
        lambda p: F.struct(F.transform(p, lambda s: F.struct(
            (start + s["r"]).alias("lo"), (start + s["r"] + s["n"]).alias("hi"))).alias("_spans")),
    )
    junction = F.coalesce(F.col("cigar").contains("N"), F.lit(False))
    dealt = spread(alignments, *[c for c in ("sample", "read_id") if c in alignments.columns] or by)
    placed = dealt.select(*[F.col(c) for c in alignments.columns], junction.alias("junction"), F.inline(parts))
    return spans_join(placed, named, by, "_spans", "start", "end", size).drop("_spans")


def splice_counts(annotated: DataFrame, barcodes: DataFrame | None = None) -> DataFrame:
    """Spliced, unspliced and ambiguous molecules per barcode and gene.

    A molecule touching an intron is unspliced, one seen in exons only is
    spliced; a molecule (barcode and UMI) seen in several genes is ambiguous in
    each of them. With ``barcodes`` (``sample, barcode``) only molecules of
    listed barcodes count.
    """
    if barcodes is not None:
        listed = barcodes.select("sample", F.col("barcode").alias("cb")).distinct()
        annotated = annotated.join(listed, ["sample", "cb"], "left_semi")
    molecules = annotated.groupBy("sample", "cb", "ub", "hit_gene").agg(
        F.bool_or(F.col("kind") == "intron").alias("_intron")
    )
    gathered = molecules.groupBy("sample", "cb", "ub").agg(
        F.count("*").alias("_genes"), F.collect_set(F.struct("hit_gene", "_intron")).alias("_m")
    )
    # One molecule touches few genes, so its set is small.
    flat = gathered.select("sample", "cb", F.explode("_m").alias("_g"), (F.col("_genes") > 1).alias("_many"))
    intron = F.col("_g._intron")
    return flat.groupBy("sample", F.col("cb").alias("barcode"), F.col("_g.hit_gene").alias("gene_id")).agg(
        F.count_if(~F.col("_many") & ~intron).alias("spliced"),
        F.count_if(~F.col("_many") & intron).alias("unspliced"),
        F.count_if(F.col("_many")).alias("ambiguous"),
    )
