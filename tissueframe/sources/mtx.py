"""Matrix-market count matrices with their gene and barcode tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tissueframe.functions.scalar import sample_of_path
from tissueframe.operators.matrix import assign_ordinals
from tissueframe.plans.lineage import drop_stored, store

HEADER = "%%MatrixMarket matrix coordinate integer general"
GENE_TYPE = "Gene Expression"

# A matrix is known by sample and, where two genomes are counted, species.
KEYS = ["sample", "species"]
_NO_SPECIES = "none"


def _key(path: Column) -> list[Column]:
    species = F.regexp_extract(path, "species=([^/]+)", 1)
    return [sample_of_path(path).alias("sample"), F.coalesce(F.nullif(species, F.lit("")), F.lit(_NO_SPECIES)).alias("species")]


def _dimension(spark: SparkSession, path: str, written: bool) -> DataFrame:
    """Lines of dimension tables with their one-based number.

    A table is one file, or with ``written`` the parts of a matrix in the order of their numbers. Tasks number
    the lines of their own block; what lies before it is added from the counts of all blocks.
    """
    where = F.col("_metadata.file_path")
    lines = spark.read.text(path, lineSep="\n").select(
        where.alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value"
    )
    counts = lines.groupBy("_file", "_block").agg(F.min("_line").alias("_first"), F.count("*").alias("_rows")).select("*", *_key(F.col("_file")))
    part = F.expr(r"try_cast(regexp_extract(_file, r'part-(\d+)[^/]*$', 1) AS long)")
    ahead = Window.partitionBy(*KEYS, *([] if written else ["_file"])).orderBy(part, "_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.select(*KEYS, "_file", "_block", (F.coalesce(F.sum("_rows").over(ahead), F.lit(0)) - F.col("_first")).alias("_ahead"))
    # One row for each block of a file, which the driver has listed: a shuffle by block would bring a whole table to one task.
    met = lines.join(F.broadcast(blocks), ["_file", "_block"])
    value = F.when(F.col("value").endswith("\r"), F.expr("substr(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    return met.select(*KEYS, (F.col("_line") + F.col("_ahead") + 1).alias("ordinal"), value.alias("value")).where("value <> ''")


def _genes(spark: SparkSession, path: str, written: bool) -> DataFrame:
    part = F.split("value", "\t")
    return _dimension(spark, path, written).select(
        *KEYS, "ordinal", part[0].alias("gene_id"), F.get(part, F.lit(1)).alias("gene_name"), F.get(part, F.lit(2)).alias("gene_type")
    )


def _barcodes(spark: SparkSession, path: str, written: bool) -> DataFrame:
    return _dimension(spark, path, written).select(*KEYS, "ordinal", F.col("value").alias("barcode"))


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates and counts. The size line is the first plain line of a file with a header."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    plain = ~F.col("value").startswith("%") & (F.col("value") != "")
    files = lines.groupBy("file").agg(
        F.bool_or(F.col("value").startswith("%%")).alias("headed"), F.min(F.when(plain & (F.col("block") == 0), F.col("line"))).alias("first")
    )
    sizes = files.select("file", *_key(F.col("file")), F.when(F.col("headed"), F.col("first")).alias("size"))
    field = F.split(F.trim("value"), r"\s+")
    # One row for each file, which the driver has listed; the entries stay where they were read.
    return lines.where(plain).join(F.broadcast(sizes), "file").where("size IS NULL OR line <> size").select(
        *KEYS, field[0].cast("long").alias("g"), field[1].cast("long").alias("c"), field[2].cast("int").alias("count")
    )


def _paths(root: str, written: bool) -> tuple[str, str, str]:
    base = root.rstrip("/")
    if written:
        return tuple(f"{base}/{n}.gz/*/*/*" for n in ("matrix.mtx", "features.tsv", "barcodes.tsv"))
    return tuple(f"{base}/*/{n}*" for n in ("matrix.mtx", "features.tsv", "barcodes.tsv"))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("species", F.nullif("species", F.lit(_NO_SPECIES)))


def read_mtx(spark: SparkSession, root: str, written: bool = False) -> DataFrame:
    """Long counts ``sample, species, barcode, gene_id, gene_name, count`` of all matrices below ``root``.

    Each matrix is a folder with ``matrix.mtx*``, ``features.tsv*`` and
    ``barcodes.tsv*``; the folder (or ``sample=`` part of the path) names the
    sample, a ``species=`` part the species. ``written`` reads what
    :func:`write_mtx` wrote, where each table is a folder by sample and species.
    """
    matrix, genes, barcodes = _paths(root, written)
    dims = _genes(spark, genes, written).withColumnRenamed("ordinal", "g"), _barcodes(spark, barcodes, written).withColumnRenamed("ordinal", "c")
    met = _entries(spark, matrix).join(dims[0], [*KEYS, "g"]).join(dims[1], [*KEYS, "c"])
    return _named(met.select(*KEYS, "barcode", "gene_id", "gene_name", "count"))


def read_mtx_genes(spark: SparkSession, root: str, written: bool = False) -> DataFrame:
    """All genes ``sample, species, ordinal, gene_id, gene_name, gene_type``, with counts or not."""
    return _named(_genes(spark, _paths(root, written)[1], written))


def read_mtx_barcodes(spark: SparkSession, root: str, written: bool = False) -> DataFrame:
    """All barcodes ``sample, species, ordinal, barcode``, with counts or not."""
    return _named(_barcodes(spark, _paths(root, written)[2], written))


def write_mtx(counts: DataFrame, root: str, genes: DataFrame | None = None, barcodes: DataFrame | None = None) -> None:
    """Write ``sample, species, barcode, gene_id, count`` as one matrix per sample and species.

    ``species`` may be missing. ``genes`` (``sample, species, gene_id, gene_name,
    gene_type``) and ``barcodes`` (``sample, species, barcode``) list dimension rows
    that have no counts as well; ids without a row there are added, their name is
    the id. Ordinals follow key order. Entries and dimension rows are range
    partitioned in file order, so a large table is several gzip parts whose
    concatenation is the file. Header and size line come first. Counts and
    ordinals are used several times and are stored once each.
    """
    base = root.rstrip("/")

    def keyed(df: DataFrame) -> DataFrame:
        species = F.coalesce("species", F.lit(_NO_SPECIES)) if "species" in df.columns else F.lit(_NO_SPECIES)
        return df.withColumn("species", species)

    counts = store(keyed(counts).select(*KEYS, "barcode", "gene_id", "count"), "mtx-counts")
    # Distinct first: the greatest of a text is found by sorting.
    gene_rows = counts.select(*KEYS, "gene_id").distinct().select(*KEYS, "gene_id", F.lit(None).cast("string").alias("gene_name"), F.lit(None).cast("string").alias("gene_type"))
    if genes is not None:
        gene_rows = gene_rows.unionByName(keyed(genes).select(*gene_rows.columns))
    gene_rows = gene_rows.groupBy(*KEYS, "gene_id").agg(F.max("gene_name").alias("gene_name"), F.max("gene_type").alias("gene_type"))
    barcode_rows = counts.select(*KEYS, "barcode")
    if barcodes is not None:
        barcode_rows = barcode_rows.unionByName(keyed(barcodes).select(*KEYS, "barcode"))
    g = store(assign_ordinals(gene_rows, KEYS, ["gene_id"], "g"), "mtx-genes")
    c = store(assign_ordinals(barcode_rows.distinct(), KEYS, ["barcode"], "c"), "mtx-barcodes")
    text = F.concat_ws("\t", "gene_id", F.coalesce("gene_name", "gene_id"), F.coalesce("gene_type", F.lit(GENE_TYPE)))
    _write_dimension(g.select(*KEYS, F.col("g").alias("n"), text.alias("value")), f"{base}/features.tsv.gz")
    _write_dimension(c.select(*KEYS, F.col("c").alias("n"), F.col("barcode").alias("value")), f"{base}/barcodes.tsv.gz")
    entries = counts.where("count <> 0").join(g.select(*KEYS, "gene_id", "g"), [*KEYS, "gene_id"]).join(c, [*KEYS, "barcode"])
    sizes = (
        g.groupBy(*KEYS).agg(F.max("g").alias("ng"))
        .join(c.groupBy(*KEYS).agg(F.max("c").alias("nc")), KEYS)
        .join(counts.where("count <> 0").groupBy(*KEYS).agg(F.count("*").alias("nn")), KEYS, "left").na.fill(0, ["nn"])
    )
    head = F.explode(
        F.array(
            F.struct(F.lit(-1).cast("long").alias("g"), F.lit(HEADER).alias("value")),
            F.struct(F.lit(0).cast("long").alias("g"), F.concat_ws(" ", "ng", "nc", "nn").alias("value")),
        )
    )
    rows = entries.select(*KEYS, "g", "c", F.concat_ws(" ", "g", "c", "count").alias("value")).unionByName(
        sizes.select(*KEYS, head.alias("_h")).select(*KEYS, "_h.g", F.lit(0).cast("long").alias("c"), "_h.value")
    )
    rows = store(rows, "mtx-rows")  # a range partition reads its input twice
    placed = rows.repartitionByRange(*KEYS, "g", "c").sortWithinPartitions(*KEYS, "g", "c")
    placed.select(*KEYS, "value").write.partitionBy(*KEYS).mode("overwrite").option("compression", "gzip").text(f"{base}/matrix.mtx.gz")
    for kept in (counts, g, c, rows):
        drop_stored(kept)


def _write_dimension(rows: DataFrame, path: str) -> None:
    placed = rows.repartitionByRange(*KEYS, "n").sortWithinPartitions(*KEYS, "n")
    placed.select(*KEYS, "value").write.partitionBy(*KEYS).mode("overwrite").option("compression", "gzip").text(path)
