import pytest
from pyspark.sql import functions as F

from tissueframe.operators import counts, matrix, reads, variants


def test_read_classes(spark):
    contigs = spark.createDataFrame([("host", "h", "AAAACCCCGG"), ("graft", "g", "TTGATTGATT")], "species string, name string, seq string")
    index = reads.build_kmer_index(contigs, 6, alphabet="ACGT")
    rows = [
        ("s", 1, "host", "AAAACC"), ("s", 1, "graft", "TTGATT"), ("s", 1, "rc", "AATCAA"), ("s", 1, "mixed", "AAAACCNTTGATT"),
        ("s", 1, "none", "GCGCGCGC"), ("s", 1, "short", "AC"), ("s", 2, "short", "AAAACC"),
    ]
    df = spark.createDataFrame(rows, "sample string, mate int, read_id string, seq string")
    found = {r.read_id: r["class"] for r in reads.classify_reads(df, index, 6, alphabet="ACGT").collect()}
    assert found == {"host": "host", "graft": "graft", "rc": "graft", "mixed": "ambiguous", "none": "neither", "short": "host"}
    second = {r.read_id: r["class"] for r in reads.classify_reads(df, index, 6, mates="r2", alphabet="ACGT").collect()}
    assert second == {"short": "host"}
    with pytest.raises(ValueError):
        reads.classify_reads(df, index, 6, mates="r1")


def test_kmers_of_long_texts_are_whole(spark):
    text = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(1500))
    df = spark.createDataFrame([("a", text), ("b", text[:256]), ("c", text[:260])], "name string, seq string")
    found = reads.kmers(df, ["name"], 5).groupBy("name").count().collect()
    assert {r.name: r["count"] for r in found} == {"a": 1496, "b": 252, "c": 256}


def test_cigar_segments(spark):
    rows = spark.createDataFrame([("3S4M1I2M2D1M5H",), ("10M",), ("2M100N2M",)], "c string")
    found = [[tuple(s) for s in r.s] for r in rows.select(variants.aligned_segments(F.col("c")).alias("s")).collect()]
    assert found == [[(3, 0, 4), (8, 4, 2), (10, 8, 1)], [(0, 0, 10)], [(0, 0, 2), (2, 102, 2)]]


def test_allele_limits_are_inclusive(spark):
    rows = []
    for pos, ref, alt in ((1, 16, 4), (2, 15, 4), (3, 17, 3), (4, 36, 4), (5, 37, 4)):
        rows += [("s", "human", "c", pos, "A", ref, "A"), ("s", "human", "c", pos, "G", alt, "A")]
    rows += [("s", "human", "c", 6, b, 10, "T") for b in "CA"]
    df = spark.createDataFrame(rows, "sample string, species string, chrom string, pos long, base string, n long, ref string")
    found = {r.pos: (r.alt, r.cov, r.alt_cov) for r in variants.snv_baf(df).collect()}
    assert found == {1: ("G", 20, 4), 4: ("G", 40, 4), 6: ("A", 20, 10)}


def test_reference_base_from_chunks(spark):
    contigs = spark.createDataFrame([("human", "c", 0, "ACGTA"), ("human", "c", 4, "AGGGC")], "species string, name string, offset long, seq string")
    contigs = contigs.union(spark.createDataFrame([("mouse", "c", 0, "TTTTT")], contigs.schema))
    piles = spark.createDataFrame([("human", "c", p) for p in (1, 4, 5, 8)] + [("mouse", "c", 1)], "species string, chrom string, pos long")
    found = {(r.species, r.pos): r.ref for r in variants.pileup_with_ref(piles, contigs, 4).collect()}
    assert found == {("human", 1): "A", ("human", 4): "T", ("human", 5): "A", ("human", 8): "G", ("mouse", 1): "T"}


def test_intervals_meet_aligned_segments(spark):
    schema = "read_id string, species string, chrom string, pos long, cigar string"
    reads_ = spark.createDataFrame(
        [("near", "human", "c", 95, "10M"), ("jump", "human", "c", 95, "5M100N5M"), ("other", "mouse", "c", 95, "10M"), ("plain", "human", "c", 50, None)], schema
    )
    intervals = spark.createDataFrame(
        [("human", "c", 40, 100, "exon", "g"), ("human", "c", 100, 200, "intron", "g"), ("human", "c", 200, 230, "exon", "g")],
        "species string, chrom string, start long, end long, kind string, gene_id string",
    )
    for size in (16, 1000):
        found = sorted((r.read_id, r.kind, r.start, r.junction) for r in counts.annotate_intervals(reads_, intervals, size).collect())
        assert found == [("jump", "exon", 40, True), ("jump", "exon", 200, True), ("near", "exon", 40, False), ("near", "intron", 100, False), ("plain", "exon", 40, False)]


def test_umis_count_once_and_empty_barcodes_stay(spark):
    df = spark.createDataFrame(
        [("s", "b1", "g", "u"), ("s", "b1", "g", "u"), ("s", "b1", "g", "v"), ("s", None, "g", "w"), ("s", "b2", None, "x")],
        "sample string, cb string, gene_id string, ub string",
    )
    listed = spark.createDataFrame([("s", "b1"), ("s", "b2")], "sample string, barcode string")
    found = {(r.barcode, r.gene_id): r["count"] for r in counts.count_umis(df, listed).collect()}
    assert found == {("b1", "g"): 2, ("b2", None): 0}


def test_splicing_rules(spark):
    df = spark.createDataFrame(
        [("s", "b", "u1", "g", "exon"), ("s", "b", "u2", "g", "exon"), ("s", "b", "u2", "g", "intron"), ("s", "b", "u3", "g", "exon"), ("s", "b", "u3", "h", "exon")],
        "sample string, cb string, ub string, hit_gene string, kind string",
    )
    found = {r.gene_id: (r.spliced, r.unspliced, r.ambiguous) for r in counts.splice_counts(df).collect()}
    assert found == {"g": (1, 1, 1), "h": (0, 0, 1)}
    listed = spark.createDataFrame([("s", "z")], "sample string, barcode string")
    assert counts.splice_counts(df, listed).count() == 0


def test_interval_join_plans_as_equality(spark):
    a = spark.range(2000).select(F.lit("human").alias("species"), F.lit("c").alias("chrom"), F.col("id").alias("pos"), F.lit("1M").alias("cigar"))
    i = spark.createDataFrame([("human", "c", 5, 9, "exon", "g"), ("human", "c", 95, 205, "intron", "h")], "species string, chrom string, start long, end long, kind string, gene_id string")
    met = counts.annotate_intervals(a, i, size=64)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert met.count() == 4 + 110


def test_merged_matrix_keeps_species_apart(spark):
    schema = "sample string, barcode string, gene_id string, count int"
    m = spark.createDataFrame([("s", "b1", "g", 2)], schema)
    h = spark.createDataFrame([("s", "b2", "g", 3)], schema)
    merged = matrix.merge_matrices(m, h)
    assert merged.count() == 2 and matrix.merged_barcodes(merged).count() == 2
    dense = {r.barcode: (r.g, r.z) for r in matrix.dense_view(merged, ["g", "z"]).collect()}
    assert dense == {"b1": (2, 0), "b2": (3, 0)}


def test_pileup_takes_as_many_tasks_as_its_bases_need(spark, monkeypatch):
    """The counts that a task holds stay bounded however many alignments there are; deep positions are counted before they meet."""
    rows = [("s", "human", f"r{i}", "c" if i % 3 else f"c{i % 40}", 1 + i % 3 * 1022, 60, "2M1D3M" if i % 2 else "5M", "ACgTA", "IIIII") for i in range(3000)]
    rows += [("s", "human", "null", "c", 5, 60, "5M", None, None), (None, None, "none", None, 5, 60, "2M", "AC", "II"), (None, None, "none", None, 5, 60, "2M", "AC", "II")]
    schema = "sample string, species string, read_id string, chrom string, pos long, mapq int, cigar string, seq string, qual string"
    df = spark.createDataFrame(rows, schema)
    want = {}
    for sample, species, _, chrom, pos, _, cigar, seq, _ in rows:
        steps = {"5M": [0, 1, 2, 3, 4], "2M1D3M": [0, 1, 3, 4, 5], "2M": [0, 1]}[cigar]
        for q, r in enumerate(steps):
            key = (sample, species, chrom, pos + r, seq and seq[q].upper())
            want[key] = want.get(key, 0) + 1
    for share in (variants.SHARE, 1000):
        monkeypatch.setattr(variants, "SHARE", share)
        piles = variants.pileup(df)
        assert {(r.sample, r.species, r.chrom, r.pos, r.base): r.n for r in piles.collect()} == want
    assert variants.locus_share(piles).rdd.getNumPartitions() == 16  # 15,004 bases, 1,000 a task; the window needs no shuffle
