"""File formats: results written to the shared folder and read back.

Each query writes rows of the given tables in the pipeline's own format and
returns what the reader makes of them.
"""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from tissueframe.operators import grid, reads
from tissueframe.operators.features import blocks_to_pixels, pixels_to_blocks
from tissueframe.plans.lineage import scratch_path, store
from tissueframe.plans.spread import spread_evenly
from tissueframe.sources import images, mtx, sequences, tables
from workload.imaging import HEX, HEX_SQL, hex_info, rounded, shapes
from workload.sequencing import SPLIT_SQL, named
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


@query("file_samplesheet", sql("slides", "SELECT sample, NULL::VARCHAR AS fastq, concat('/slides/', sample) AS image, mpp FROM slides"))
def _(d):
    path = scratch_path(d.spark, "sheet")
    sheet = d.slides.select("mpp", "sample", F.lit("").alias("fastq"), F.concat(F.lit("/slides/"), "sample").alias("image"), F.lit("x").alias("note"))
    sheet.write.csv(path, header=True)
    return tables.read_samplesheet(d.spark, path).select("sample", "fastq", "image", "mpp")


@query("file_positions", sql("slides", f"WITH {HEX_SQL} SELECT sample, barcode, in_tissue, array_row, array_col, pxl_row_in_fullres, pxl_col_in_fullres FROM grid"))
def _(d):
    path = scratch_path(d.spark, "positions")
    spots = grid.make_grid(spread_evenly(d.slides, "sample"), "hex")
    tables.folder_writer(spots.select("sample", *tables.schemas.OBS_COLUMNS)).csv(path)
    return tables.read_positions(d.spark, path).drop("grid_ord")


@query("file_grid_info", sql("slides", f"SELECT sample, x, y, round({num(HEX['tile'])}, 6) AS diameter FROM slides"))
def _(d):
    path = scratch_path(d.spark, "grid-info")
    tables.write_grid_info(hex_info(d), path)
    return tables.read_grid_info(d.spark, path).select("sample", "x", "y", F.round("spot_diameter_fullres", 6).alias("diameter"))


@query("file_roi", sql("slides", "SELECT sample, CAST(CASE WHEN x % 2 = 0 THEN 1.0 / 4 ELSE 0 END AS DOUBLE) AS location, CAST(CASE WHEN x % 2 = 0 THEN 1.0 / 2 ELSE 1 END AS DOUBLE) AS size FROM slides"))
def _(d):
    path = scratch_path(d.spark, "roi")
    text = F.lit('{"0":{"location":0.25,"size":0.5},"1":{"location":0,"size":1}}')
    tables.folder_writer(spread_evenly(d.slides.where("x % 2 = 0").select("sample", text.alias("value")), "sample")).text(path)
    roi = tables.with_full_roi(d.slides, tables.read_roi(d.spark, path))
    return roi.select("sample", F.col("roi")["0"]["location"].alias("location"), F.col("roi")["0"]["size"].alias("size"))


@query("file_nuclei_json", """SELECT concat('S', user_id % 10) AS sample, concat('', event_id) AS ids, CAST(event_id % 6 AS INT) AS type,
    round((event_id * 37) % 101 / 100, 6) AS type_prob, [4, 4, 3, 5, 1][event_id % 5 + 1]::INT AS points FROM events""")
def _(d):
    path = scratch_path(d.spark, "nuclei")
    tables.write_nuclei_json(shapes(d), path)
    back = tables.read_nuclei_lines(d.spark, path)
    return rounded(back.select("sample", "ids", "type", "type_prob", F.size("contour").alias("points")), "type_prob")


@query("file_nuclei_map", """SELECT concat('S', user_id % 10) AS sample, concat('', event_id) AS ids, CAST(event_id % 6 AS INT) AS type FROM events""")
def _(d):
    # The one-object form: a map of nuclei per tile of at most a thousand events.
    path = scratch_path(d.spark, "nuclei-map")
    one = F.struct("centroid", "contour", "type_prob", "type")
    tile = F.floor(F.col("ids").cast("long") / 1000)
    whole = shapes(d).groupBy("sample", tile.alias("tile")).agg(F.map_from_entries(F.collect_list(F.struct("ids", one))).alias("nuc"))
    lines = whole.select("sample", F.to_json(F.struct(F.lit(40).alias("mag"), "nuc")).alias("value"))
    lines.write.partitionBy("sample").option("maxRecordsPerFile", 1).text(path)
    return tables.read_nuclei(d.spark, path).select("sample", "ids", "type")


# Counts with gene names, and the genes and barcodes that have none.
@query("file_mtx", sql("matrix", """SELECT sample, species, barcode, gene_id, concat('part ', gene_id) AS gene_name, 'Gene Expression' AS gene_type, count FROM matrix
    UNION ALL SELECT DISTINCT sample, species, NULL, concat('none-', gene_id), 'spare', 'Antibody', 0 FROM matrix
    UNION ALL SELECT DISTINCT sample, species, concat('empty-', barcode), NULL, NULL, NULL, 0 FROM matrix"""))
def _(d):
    path = scratch_path(d.spark, "mtx")
    key = ["sample", "species"]
    counts = store(d.matrix, "matrix")
    own = counts.select(*key, "gene_id").distinct()
    genes = own.select(*key, "gene_id", F.concat(F.lit("part "), "gene_id").alias("gene_name"), F.lit("Gene Expression").alias("gene_type"))
    spare = own.select(*key, F.concat(F.lit("none-"), "gene_id").alias("gene_id"), F.lit("spare").alias("gene_name"), F.lit("Antibody").alias("gene_type"))
    empty = counts.select(*key, F.concat(F.lit("empty-"), "barcode").alias("barcode")).distinct()
    mtx.write_mtx(counts, path, genes.unionByName(spare), empty)
    found = store(mtx.read_mtx(d.spark, path, written=True), "mtx-read")
    kinds = mtx.read_mtx_genes(d.spark, path, written=True).drop("ordinal")
    full = found.drop("gene_name").join(kinds, [*key, "gene_id"], "full").withColumn("count", F.coalesce("count", F.lit(0)))
    listed = mtx.read_mtx_barcodes(d.spark, path, written=True).select(*key, "barcode")
    unseen = listed.join(found.select(*key, "barcode").distinct(), [*key, "barcode"], "left_anti")
    return full.unionByName(unseen.withColumn("count", F.lit(0)), allowMissingColumns=True)


def fastq_rows(d):
    """Reads with one line per sequence and a quality that may begin with @."""
    flat = F.regexp_replace("seq", r"[\r\n]+", " ")
    return d.reads.withColumn("seq", flat).withColumn("qual", F.repeat(F.lit("@"), F.length(flat)))


@query("file_fastq", sql("reads", f"""WITH {SPLIT_SQL} SELECT mate, read_id, regexp_replace(seq, '[\\r\\n]+', ' ', 'g') AS seq,
    repeat('@', length(regexp_replace(seq, '[\\r\\n]+', ' ', 'g'))) AS qual, CASE class WHEN 'host' THEN 'mouse' ELSE 'human' END AS species
    FROM reads JOIN named USING (sample, read_id) WHERE class <> 'both'"""))
def _(d):
    path = scratch_path(d.spark, "fastq")
    kept = reads.split_reads(fastq_rows(d), named(d))
    record = F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_id")), "seq", F.lit("+"), "qual")
    # Written once, in a folder for each species and mate; plain files are cut into ranges by the reader.
    parts = kept.where(F.col("mate").isin(1, 2)).select(F.col("species").alias("sample"), F.concat(F.lit("R"), "mate").alias("mate"), record.alias("value"))
    parts.write.partitionBy("sample", "mate").option("compression", "none").text(path)
    found = sequences.read_fastq(d.spark, path, split_bytes=1 << 16, endings=(".txt",))
    return found.select("mate", "read_id", "seq", "qual", F.col("sample").alias("species"))


@query("file_fasta", sql("genomes", """SELECT name, length(seq) AS length,
    translate(substr(seq, length(seq) - 4, 5), 'acgtn', 'ACGTN') AS tail FROM (SELECT name, replace(replace(seq, chr(10), ''), chr(13), '') AS seq FROM genomes)"""))
def _(d):
    path = scratch_path(d.spark, "fasta")
    record = F.concat(F.lit(">"), "name", F.lit(" passage\n"), F.regexp_replace("seq", "(.{60})", "$1\n"))
    d.genomes.select(record.alias("value")).write.text(path)
    chunks = sequences.read_fasta(d.spark, path, chunk=50, overlap=4, endings=(".txt",))
    whole = chunks.groupBy("name").agg(
        F.max(F.col("offset") + F.length("seq")).alias("length"), F.max_by("seq", "offset").alias("_last")
    )
    return whole.select("name", "length", F.expr("right(_last, 5)").alias("tail"))


@query("file_sam", sql("alignments", "SELECT read_id, chrom, pos, mapq, cigar, seq, qual, cb, ub, CASE WHEN pos % 2 = 0 THEN gene_id END AS gene_id FROM alignments"))
def _(d):
    path = scratch_path(d.spark, "sam")
    a = d.alignments
    gene = F.when(F.col("pos") % 2 == 0, F.concat(F.lit("GX:Z:"), "gene_id"))
    fields = ["read_id", F.lit("0"), "chrom", "pos", "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual"]
    line = F.concat_ws("\t", *fields, F.concat(F.lit("CB:Z:"), "cb"), F.concat(F.lit("UB:Z:"), "ub"), gene)
    header = d.supplier.select(F.concat(F.lit("@SQ\tSN:d"), F.col("s_suppkey").cast("string")).alias("value"))
    header.unionByName(a.select(line.alias("value"))).write.text(path)
    return sequences.read_sam(d.spark, path).drop("sample", "species")


@query("file_features", "SELECT concat('t', vec_id) AS barcode, CAST(vec_id AS INT) AS array_row, round(embedding[1]::DOUBLE, 5) AS first, round(embedding[64]::DOUBLE, 5) AS last FROM embeddings")
def _(d):
    path = scratch_path(d.spark, "features")
    v = d.vectors.select("sample", F.concat(F.lit("t"), F.col("tile").cast("string")).alias("barcode"), F.col("tile").cast("int").alias("array_row"), "features")
    tables.write_features(v, path, "uni", 64)
    back = tables.read_features(d.spark, path, "uni", 1.0)
    f = F.col("features")
    return back.select("barcode", "array_row", F.round(f[0].cast("double"), 5).alias("first"), F.round(f[63].cast("double"), 5).alias("last"))


@query("file_obs_store", sql("vectors", "SELECT sample, tile, 'uni' AS model FROM vectors WHERE label % 2 = 0"))
def _(d):
    path = scratch_path(d.spark, "obs")
    v = d.vectors.select("sample", "tile", "features", F.lit(1.0).alias("expansion_factor"))
    both = v.withColumn("model", F.lit("uni")).unionByName(v.withColumn("model", F.lit("conch")))
    tables.write_obs_store(both, path)
    stored = tables.read_obs_store(d.spark, path)
    return stored.where("model = 'uni' AND sample = 'E0'").select("sample", "tile", "model")


@query("file_publish", sql("nuclei", "SELECT sample, ids, CASE WHEN sample IN ('S0', 'S1') THEN 'first' ELSE 'second' END AS run FROM nuclei"))
def _(d):
    path = scratch_path(d.spark, "published")
    first = d.nuclei.select("sample", "ids", F.lit("first").alias("run")).where("sample IN ('S0', 'S1')")
    tables.publish(first, path, "nuclei")
    tables.publish(d.nuclei.select("sample", "ids", F.lit("second").alias("run")), path, "nuclei", overwrite=False)
    return d.spark.read.parquet(f"{path}/nuclei").select("sample", "ids", "run")


@query("file_matrix", sql("matrix", "SELECT sample, species, count(*) AS n, CAST(sum(count) AS BIGINT) AS total FROM matrix GROUP BY 1, 2"))
def _(d):
    path = scratch_path(d.spark, "matrices")
    tables.publish_matrix(d.matrix, path, merge=False)
    back = d.spark.read.parquet(f"{path}/raw_feature_bc_matrix")
    return back.groupBy("sample", "species").agg(F.count("*").alias("n"), F.sum("count").alias("total"))


@query("file_table", sql("nuclei", "SELECT sample, ids, round(area, 4) AS area FROM nuclei"))
def _(d):
    path = scratch_path(d.spark, "table")
    tables.write_table(d.nuclei.select("sample", "ids", "area"), path)
    back = d.spark.read.schema("ids STRING, area DOUBLE, sample STRING").csv(path, header=True)
    return rounded(back.select("sample", "ids", "area"), "area", digits=4)


@query("file_run", sql("slides", "SELECT sample, x, '0.25' AS target_mpp, 'hex' AS grid_type FROM slides"))
def _(d):
    path = scratch_path(d.spark, "run")
    tables.export_run(d.spark, {"target_mpp": 0.25, "grid_type": "hex"}, d.slides, path)
    params = d.spark.read.schema("target_mpp STRING, grid_type STRING").json(f"{path}/parameters")
    with tables.folder_reader(d.spark) as reader:
        info = reader.schema("sample STRING, x INT").json(f"{path}/info")
    return info.crossJoin(params)


@query("file_reads_by_class", sql("reads", f"""WITH {SPLIT_SQL} SELECT sample, mate, read_id, regexp_replace(seq, '[\\r\\n]+', ' ', 'g') AS seq,
    CASE class WHEN 'host' THEN 'mouse' ELSE 'human' END AS species FROM reads JOIN named USING (sample, read_id) WHERE class <> 'both'"""))
def _(d):
    path = scratch_path(d.spark, "classes")
    kept = reads.split_reads(fastq_rows(d), named(d))
    # One folder for each species and mate, so that each is read as such.
    for species, mate in itertools.product(("mouse", "human"), (1, 2)):
        tables.write_reads_by_class(kept.where((F.col("species") == species) & (F.col("mate") == mate)), f"{path}/{species}/{mate}")
    found = None
    for species, mate in itertools.product(("mouse", "human"), (1, 2)):
        part = sequences.read_fastq(d.spark, f"{path}/{species}/{mate}", endings=(".txt.gz",))
        part = part.select("sample", F.lit(mate).alias("mate"), "read_id", "seq", F.lit(species).alias("species"))
        found = part if found is None else found.unionByName(part)
    return found


@query("file_gtf", """WITH exons AS (SELECT CASE WHEN p_size % 2 = 0 THEN 'mouse' ELSE 'human' END AS species, concat('chr', p_partkey % 7) AS chrom,
        concat('G', p_partkey) AS gene_id, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 10 * p_partkey + k * (p_size + 4) AS lo, 10 * p_partkey + k * (p_size + 4) + 5 AS hi, k
      FROM part, (VALUES (0), (1), (2)) v(k) WHERE k <= p_size % 3)
    SELECT species, chrom, lo AS start, hi AS "end", 'exon' AS kind, gene_id, strand FROM exons
    UNION ALL SELECT a.species, a.chrom, a.hi, b.lo, 'intron', a.gene_id, a.strand FROM exons a JOIN exons b ON a.gene_id = b.gene_id AND b.k = a.k + 1 AND b.lo > a.hi""")
def _(d):
    # Transcript T repeats the first exon of the gene's main transcript.
    path = scratch_path(d.spark, "gtf")
    start = F.expr("10 * p_partkey + k * (p_size + 4)")
    exon = d.part.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("p_size") % 3)))
    twice = exon.withColumn("t", F.explode(F.when(F.col("k") == 0, F.array(F.lit("M"), F.lit("T"))).otherwise(F.array(F.lit("M")))))
    strand = F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-")
    note = F.format_string('gene_id "G%s"; transcript_id "%s%s";', F.col("p_partkey").cast("string"), F.col("t"), F.col("p_partkey").cast("string"))
    line = F.concat_ws("\t", F.concat(F.lit("chr"), (F.col("p_partkey") % 7).cast("string")), F.lit("x"), F.lit("exon"), start.cast("string"), (start + 4).cast("string"), F.lit("."), strand, F.lit("."), note)
    species = F.when(F.col("p_size") % 2 == 0, "mouse").otherwise("human")
    twice.select(species.alias("species"), line.alias("value")).write.partitionBy("species").text(path)
    return sequences.read_gtf(d.spark, path)


@query("file_images", sql("pixels", """SELECT s.sample, CAST(i AS INT) AS x, CAST(j AS INT) AS y, CAST(s.width AS INT) AS width, CAST(s.height AS INT) AS height,
      coalesce(r, 255) AS r, coalesce(g, 255) AS g, coalesce(b, 255) AS b
    FROM (SELECT sample, max(x) + 1 AS width, max(y) + 1 AS height FROM pixels GROUP BY 1) s
    JOIN range(0, 100) a(i) ON i < s.width JOIN range(0, 100) c(j) ON j < s.height
    LEFT JOIN pixels p ON p.sample = s.sample AND p.x = i AND p.y = j"""))
def _(d):
    path = scratch_path(d.spark, "images")
    images.write_images(pixels_to_blocks(d.pixels, 32), path)
    pixels = blocks_to_pixels(images.read_image_blocks(d.spark, f"{path}/*", 48))
    return pixels.join(images.read_image_meta(d.spark, f"{path}/*").drop("channels"), "sample")
