"""Reads, counts, variants and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from tissueframe.functions.sequence import canonical, revcomp
from tissueframe.operators import assignment, counts, matrix, reads, superkmers, variants
from workload.imaging import rounded
from workload.views import Data, num, sql

QUERIES: dict = {}
CHECKS: dict = {}


def query(name: str, check: str | None = None):
    def keep(fn):
        QUERIES[name] = lambda spark, folder: fn(Data(spark, folder))
        if check:
            CHECKS[name] = check
        return fn

    return keep


# ----------------------------------------------------------------------- reads

# The k of the k-mer index; passages of that many letters occur in the reads.
K = 25


def kmers_sql(source: str, keys: str, k: int = K) -> str:
    raw = f"substr(seq, CAST(i AS INT), {k})"
    return f"""(SELECT {keys}, least({raw}, reverse(translate({raw}, 'ACGT', 'TGCA'))) AS kmer
        FROM (SELECT {keys}, seq, unnest(range(1, length(seq) - {k} + 2)) AS i FROM {source} WHERE length(seq) >= {k}))"""


INDEX_SQL = f"""idx AS (SELECT kmer, bool_or(species = 'host') AS in_host, bool_or(species = 'graft') AS in_graft
    FROM {kmers_sql('genomes', 'species')} GROUP BY 1)"""
HITS_SQL = f"""{INDEX_SQL},
  hits AS (SELECT sample, read_id,
      count(*) FILTER (WHERE coalesce(in_graft, false) AND NOT coalesce(in_host, false)) AS n_graft,
      count(*) FILTER (WHERE coalesce(in_host, false) AND NOT coalesce(in_graft, false)) AS n_host,
      count(*) FILTER (WHERE coalesce(in_host, false) AND coalesce(in_graft, false)) AS n_both,
      count(*) FILTER (WHERE in_host IS NULL) AS n_missing
    FROM {kmers_sql('reads', 'sample, read_id')} k LEFT JOIN idx USING (kmer) GROUP BY 1, 2),
  votes AS (SELECT r.sample, r.read_id, coalesce(n_graft, 0) AS n_graft, coalesce(n_host, 0) AS n_host, coalesce(n_both, 0) AS n_both,
      coalesce(n_missing, 0) AS n_missing FROM (SELECT DISTINCT sample, read_id FROM reads) r LEFT JOIN hits USING (sample, read_id)),
  classes AS (SELECT *, CASE WHEN n_graft > 0 AND n_host = 0 THEN 'graft' WHEN n_host > 0 AND n_graft = 0 THEN 'host'
      WHEN n_graft > 0 AND n_host > 0 THEN 'ambiguous' WHEN n_both > 0 THEN 'both' ELSE 'neither' END AS class FROM votes)"""


def index(d):
    return reads.build_kmer_index(d.genomes, K)


def classes(d):
    return reads.classify_reads(d.reads, index(d), K)


@query("revcomp", sql("genomes", """SELECT species, name, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc,
    least(seq, reverse(translate(seq, 'ACGT', 'TGCA'))) AS canon FROM genomes"""))
def _(d):
    return d.genomes.select("species", "name", revcomp(F.col("seq")).alias("rc"), canonical(F.col("seq")).alias("canon"))


@query("kmer_index", sql("genomes", f"WITH {INDEX_SQL} SELECT * FROM idx"))
def _(d):
    return index(d)


@query("kmer_index_documents", sql("reads", f"SELECT kmer, count(*) AS n FROM {kmers_sql('reads', 'sample')} GROUP BY 1"))
def _(d):
    return superkmers.count_kmers(d.reads, ["sample"], K)


@query("kmer_composition", sql("reads", f"SELECT kmer, count(*) AS n FROM {kmers_sql('reads', 'sample', 5)} GROUP BY 1"))
def _(d):
    # Short k-mers repeat, so this is the counting of a composition.
    return reads.kmers(d.reads, ["sample"], 5).groupBy("kmer").agg(F.count("*").alias("n"))


@query("read_hits", sql("reads genomes", f"WITH {HITS_SQL} SELECT * FROM votes"))
def _(d):
    return reads.match_reads(d.reads, index(d), K)


@query("read_class", sql("reads genomes", f"WITH {HITS_SQL} SELECT sample, read_id, class FROM classes"))
def _(d):
    return classes(d).select("sample", "read_id", "class")


@query("read_class_r2", sql("reads genomes", f"""WITH {HITS_SQL.replace("FROM (SELECT DISTINCT sample, read_id FROM reads)", "FROM (SELECT DISTINCT sample, read_id FROM r2)").replace("FROM reads WHERE length", "FROM r2 WHERE length")}
    SELECT sample, read_id, class FROM classes""".replace("WITH idx", "WITH r2 AS (SELECT * FROM reads WHERE mate = 2), idx")))
def _(d):
    return reads.classify_reads(d.reads, index(d), K, mates="r2").select("sample", "read_id", "class")


@query("class_summary", sql("reads genomes", f"""WITH {HITS_SQL} SELECT sample, class, count(*) AS n_reads,
    round(count(*) / sum(count(*)) OVER (PARTITION BY sample), 6) AS share FROM classes GROUP BY 1, 2"""))
def _(d):
    return rounded(reads.class_summary(classes(d)), "share")


# Only some k-mers decide, so that several classes are kept.
SPLIT_SQL = """named AS (SELECT sample, read_id, CASE WHEN n_chars % 3 = 0 THEN 'host' WHEN n_chars % 3 = 1 THEN 'graft' ELSE 'both' END AS class
    FROM (SELECT sample, read_id, max(length(seq)) AS n_chars FROM reads GROUP BY 1, 2))"""


def named(d):
    longest = d.reads.groupBy("sample", "read_id").agg(F.max(F.length("seq")).alias("n"))
    return longest.select("sample", "read_id", F.when(F.col("n") % 3 == 0, "host").when(F.col("n") % 3 == 1, "graft").otherwise("both").alias("class"))


@query("split_reads", sql("reads", f"""WITH {SPLIT_SQL} SELECT sample, read_id, mate, CASE class WHEN 'host' THEN 'mouse' ELSE 'human' END AS species
    FROM reads JOIN named USING (sample, read_id) WHERE class <> 'both'"""))
def _(d):
    return reads.split_reads(d.reads, named(d)).select("sample", "read_id", "mate", "species")


@query("mates", sql("reads", f"""WITH {SPLIT_SQL} SELECT sample, read_id, seq FROM reads r WHERE mate = 1 AND EXISTS (
    SELECT 1 FROM reads s JOIN named n USING (sample, read_id) WHERE s.mate = 2 AND n.class = 'graft' AND s.sample = r.sample AND s.read_id = r.read_id)"""))
def _(d):
    second = d.reads.where("mate = 2").join(named(d).where("class = 'graft'"), ["sample", "read_id"])
    return reads.mates_of(d.reads.where("mate = 1"), second).select("sample", "read_id", "seq")


@query("sort_reads", sql("reads", "SELECT sample, mate, read_id, length(seq) AS n FROM reads ORDER BY sample, mate, read_id"))
def _(d):
    return reads.sort_reads(d.reads.select("sample", "mate", "read_id", F.length("seq").alias("n")))


@query("sort_by_barcode", sql("alignments", "SELECT sample, cb, chrom, pos, read_id FROM alignments ORDER BY ALL"))
def _(d):
    return reads.sort_by_barcode(d.alignments.select("sample", "cb", "chrom", "pos", "read_id"))


# ---------------------------------------------------------------------- counts


@query("umi_counts", sql("alignments", """SELECT b.sample, b.barcode, u.gene_id, CAST(coalesce(n, 0) AS INT) AS count
    FROM (SELECT concat('A', s_nationkey % 2) AS sample, concat('B', s_suppkey) AS barcode FROM supplier) b
    LEFT JOIN (SELECT sample, cb, gene_id, count(DISTINCT ub) AS n FROM alignments GROUP BY 1, 2, 3) u ON u.sample = b.sample AND u.cb = b.barcode"""))
def _(d):
    listed = d.supplier.select(
        F.concat(F.lit("A"), (F.col("s_nationkey") % 2).cast("string")).alias("sample"),
        F.concat(F.lit("B"), F.col("s_suppkey").cast("string")).alias("barcode"),
    )
    return counts.count_umis(d.alignments, listed)


@query("seq_metrics", sql("alignments", """SELECT sample, species, count(*) AS n_reads, count(cb) AS n_tagged,
    count(DISTINCT concat(cb, ' ', gene_id, ' ', ub)) AS n_umis, count(DISTINCT gene_id) AS n_genes, count(DISTINCT cb) AS n_spots FROM alignments GROUP BY 1, 2"""))
def _(d):
    return counts.seq_metrics(d.alignments)


# Genes: one exon and one intron per part, on the documents' coordinates.
INTERVALS_SQL = """intervals AS (SELECT concat('d', CAST(floor(p_partkey / 20) AS INT)) AS chrom, 5 * (p_partkey % 19) + k * (3 + p_size % 6) AS lo,
      5 * (p_partkey % 19) + (k + 1) * (3 + p_size % 6) AS hi, CASE k WHEN 0 THEN 'exon' ELSE 'intron' END AS kind, concat('G', p_partkey) AS gene
        , CASE WHEN p_size % 3 = 0 THEN 'mouse' ELSE 'human' END AS species
    FROM part, (VALUES (0), (1)) v(k)),
  segs(cigar, r, n) AS (VALUES ('2M1D2M', 0, 2), ('2M1D2M', 3, 2), ('1S3M1I', 0, 3), ('2M3N3M', 0, 2), ('2M3N3M', 5, 3), ('5M', 0, 5)),
  overlap AS (SELECT a.sample, a.read_id, a.cb, a.ub, a.pos, i.kind, i.gene AS hit_gene, a.cigar LIKE '%N%' AS junction
    FROM alignments a JOIN intervals i ON a.species = i.species AND a.chrom = i.chrom
    WHERE EXISTS (SELECT 1 FROM segs s WHERE s.cigar = a.cigar AND a.pos + s.r < hi AND lo < a.pos + s.r + s.n))"""


def intervals(d):
    wide = d.part.select("p_partkey", "p_size", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    step = 3 + F.col("p_size") % 6
    start = 5 * (F.col("p_partkey") % 19)
    return wide.select(
        F.when(F.col("p_size") % 3 == 0, "mouse").otherwise("human").alias("species"),
        F.concat(F.lit("d"), F.floor(F.col("p_partkey") / 20).cast("string")).alias("chrom"),
        (start + F.col("k") * step).alias("start"),
        (start + (F.col("k") + 1) * step).alias("end"),
        F.when(F.col("k") == 0, "exon").otherwise("intron").alias("kind"),
        F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("gene_id"),
    )


@query("annotate_intervals", sql("alignments", f"WITH {INTERVALS_SQL} SELECT sample, read_id, ub, pos, kind, hit_gene, junction FROM overlap"))
def _(d):
    found = counts.annotate_intervals(d.alignments, intervals(d), size=8)
    return found.select("sample", "read_id", "ub", "pos", "kind", "hit_gene", "junction")


@query("splice_counts", sql("alignments", f"""WITH {INTERVALS_SQL},
    mol AS (SELECT sample, cb, ub, hit_gene, bool_or(kind = 'intron') AS intron FROM overlap GROUP BY 1, 2, 3, 4),
    many AS (SELECT *, count(*) OVER (PARTITION BY sample, cb, ub) > 1 AS many FROM mol)
    SELECT sample, cb AS barcode, hit_gene AS gene_id, count(*) FILTER (WHERE NOT many AND NOT intron) AS spliced,
        count(*) FILTER (WHERE NOT many AND intron) AS unspliced, count(*) FILTER (WHERE many) AS ambiguous FROM many GROUP BY 1, 2, 3"""))
def _(d):
    return counts.splice_counts(counts.annotate_intervals(d.alignments, intervals(d), size=8))


# -------------------------------------------------------------------- variants

PILE_SQL = """steps(cigar, q, r) AS (VALUES ('2M1D2M', 0, 0), ('2M1D2M', 1, 1), ('2M1D2M', 2, 3), ('2M1D2M', 3, 4),
      ('1S3M1I', 1, 0), ('1S3M1I', 2, 1), ('1S3M1I', 3, 2),
      ('2M3N3M', 0, 0), ('2M3N3M', 1, 1), ('2M3N3M', 2, 5), ('2M3N3M', 3, 6), ('2M3N3M', 4, 7), ('5M', 0, 0), ('5M', 1, 1), ('5M', 2, 2), ('5M', 3, 3), ('5M', 4, 4)),
  pile AS (SELECT sample, species, chrom, pos + r AS pos, translate(substr(seq, q + 1, 1), 'acgtn', 'ACGTN') AS base, count(*) AS n
    FROM alignments JOIN steps USING (cigar) WHERE mapq >= 10 AND ascii(substr(qual, q + 1, 1)) - 33 >= 21 GROUP BY 1, 2, 3, 4, 5),
  withref AS (SELECT p.*, translate(nullif(substr(text, CAST(pos AS INT), 1), ''), 'acgtn', 'ACGTN') AS ref FROM pile p LEFT JOIN (SELECT 'human' AS genome, doc_id, text FROM documents UNION ALL SELECT 'mouse', doc_id, reverse(text) FROM documents) d
      ON p.chrom = concat('d', doc_id) AND p.species = genome)"""


def piles(d):
    return variants.pileup(d.alignments, min_mapq=10, min_bq=21)


def referenced(d):
    met = variants.pileup_with_ref(piles(d), d.contigs, 1 << 20)
    return met.withColumn("ref", F.nullif("ref", F.lit("")))


@query("pileup", sql("alignments", f"WITH {PILE_SQL} SELECT * FROM pile"))
def _(d):
    return piles(d)


@query("pileup_ref", sql("alignments", f"WITH {PILE_SQL} SELECT * FROM withref"))
def _(d):
    return referenced(d)


@query("locus_share", sql("alignments", f"""WITH {PILE_SQL} SELECT *, CAST(sum(n) OVER w AS BIGINT) AS cov, round(n / sum(n) OVER w, 6) AS share FROM pile
    WINDOW w AS (PARTITION BY sample, species, chrom, pos)"""))
def _(d):
    return rounded(variants.locus_share(piles(d)), "share")


@query("snv_baf", sql("alignments", f"""WITH {PILE_SQL},
    loci AS (SELECT sample, species, chrom, pos, max(ref) AS ref, CAST(sum(n) AS BIGINT) AS cov FROM withref GROUP BY 1, 2, 3, 4),
    alts AS (SELECT *, row_number() OVER (PARTITION BY sample, species, chrom, pos ORDER BY n DESC, base) AS rn FROM withref WHERE base <> ref)
    SELECT sample, species, chrom, pos, l.ref, base AS alt, cov, n AS alt_cov, round(n / cov, 6) AS maf FROM loci l JOIN alts a USING (sample, species, chrom, pos)
    WHERE rn = 1 AND cov >= 8 AND n >= 4 AND n / cov >= {num(0.3)}"""))
def _(d):
    return rounded(variants.snv_baf(referenced(d), min_cov=8, min_alt=4, min_maf=0.3), "maf")


@query("contig_sizes", "SELECT species, concat('d', doc_id) AS name, max(length(text)) AS length FROM documents, (VALUES ('human'), ('mouse')) v(species) GROUP BY 1, 2")
def _(d):
    # Chunks of 500 letters, as the sequence reader gives them.
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(500)))
    chunks = d.contigs.select("species", "name", "seq", at.alias("offset"))
    cut = chunks.select("species", "name", "offset", F.substr(F.col("seq"), F.col("offset") + 1, F.lit(500)).alias("seq"))
    return variants.contig_sizes(cut)


# ---------------------------------------------------------------------- matrix


def by_species(d):
    long = d.matrix
    return [long.where(F.col("species") == s).drop("species") for s in ("mouse", "human")]


@query("matrix_merge", sql("matrix", "SELECT sample, species, barcode, gene_id, count FROM matrix"))
def _(d):
    return matrix.merge_matrices(*by_species(d))


@query("matrix_barcodes", sql("matrix", "SELECT DISTINCT sample, barcode FROM matrix"))
def _(d):
    return matrix.merged_barcodes(matrix.merge_matrices(*by_species(d)))


@query("matrix_dense", sql("matrix", """SELECT sample, barcode, CAST(coalesce(sum(count) FILTER (WHERE gene_id = 'A-1'), 0) AS BIGINT) AS "A-1",
    CAST(coalesce(sum(count) FILTER (WHERE gene_id = 'N-2'), 0) AS BIGINT) AS "N-2", CAST(coalesce(sum(count) FILTER (WHERE gene_id = 'R-3'), 0) AS BIGINT) AS "R-3"
    FROM matrix GROUP BY 1, 2"""))
def _(d):
    return matrix.dense_view(matrix.merge_matrices(*by_species(d)), ["A-1", "N-2", "R-3"])


@query("matrix_ordinals", sql("matrix", """SELECT sample, gene_id, row_number() OVER (PARTITION BY sample ORDER BY gene_id) AS ordinal
    FROM (SELECT DISTINCT sample, gene_id FROM matrix)"""))
def _(d):
    return matrix.assign_ordinals(d.matrix.select("sample", "gene_id").distinct(), ["sample"], ["gene_id"])


@query("gene_union", sql("matrix", "SELECT DISTINCT species, gene_id FROM matrix"))
def _(d):
    mouse, human = by_species(d)
    return matrix.union_genes(
        mouse.select(F.lit("mouse").alias("species"), "gene_id"), human.select(F.lit("human").alias("species"), "gene_id")
    )


@query("pair_species", sql("matrix", """SELECT sample, sum(count) FILTER (WHERE species = 'mouse')::BIGINT AS mouse_n_umis,
    sum(count) FILTER (WHERE species = 'human')::BIGINT AS human_n_umis FROM matrix GROUP BY 1"""))
def _(d):
    mouse, human = (m.groupBy("sample").agg(F.sum("count").alias("n_umis")) for m in by_species(d))
    return assignment.pair_species(mouse, human)


@query("union_patches", sql("pixels", "SELECT sample, x, y, r FROM pixels"))
def _(d):
    halves = (d.pixels.where("x < 50"), d.pixels.where("x >= 50"))
    return matrix.union_patches(*[h.select("sample", "x", "y", "r") for h in halves])
