"""Sample sheets, grids, regions, nuclei, feature tables: text formats."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tissueframe import schemas
from tissueframe.functions.jsonx import format_params
from tissueframe.functions.scalar import base_name, sample_of_path
from tissueframe.plans.spread import spread_evenly

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _path() -> Column:
    return F.col("_metadata.file_path")


@contextmanager
def folder_reader(spark: SparkSession) -> Iterator[DataFrameReader]:
    """Reader for a folder per sample, however many there are.

    Folders are listed by as many tasks as a shuffle has, not by one task each, and
    their names are not tried as values of every type.
    """
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield spark.read.option("recursiveFileLookup", True)
    finally:
        spark.conf.set(_LISTING, before)


def folder_writer(df: DataFrame) -> DataFrameWriter:
    """Writer of a folder per sample; tasks move their own folders into place, not the driver all of them."""
    return df.write.partitionBy("sample").option("mapreduce.fileoutputcommitter.algorithm.version", "2")


def read_samplesheet(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Sample sheet with a header in any column order; empty text is NULL.

    Columns outside the fixed set are ignored. ``check`` refuses repeated
    samples.
    """
    raw = spark.read.option("header", True).csv(path)
    known = [f.split()[0] for f in schemas.SAMPLESHEET.split(", ")]
    cols = []
    for name in known:
        value = F.nullif(F.trim(F.col(name)), F.lit("")) if name in raw.columns else F.lit(None)
        cols.append(value.cast("double" if name == "mpp" else "string").alias(name))
    sheet = raw.select(*cols)
    if check:
        twice = sheet.groupBy("sample").count().where("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"sample {twice[0]['sample']} is listed more than once")
    return sheet


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Spot positions, with or without a header row; the sample is the file's folder.

    ``grid_ord`` keeps the order of the rows in their file.
    """
    with folder_reader(spark) as reader:
        lines = reader.schema(schemas.POSITIONS).csv(path)
    rows = lines.withColumn("sample", sample_of_path(_path())).withColumn("grid_ord", F.monotonically_increasing_id())
    return rows.where(F.col("barcode") != "barcode").select("sample", *schemas.OBS_COLUMNS, "grid_ord")


def read_grid_info(spark: SparkSession, path: str) -> DataFrame:
    """Scale factors / grid info, one JSON object per file."""
    with folder_reader(spark) as reader:
        info = reader.schema(schemas.GRID_INFO).option("multiLine", True).json(path)
    return info.withColumn("sample", sample_of_path(_path()))


def write_grid_info(info: DataFrame, path: str) -> None:
    """One JSON object per sample folder."""
    folder_writer(spread_evenly(info, "sample")).mode("overwrite").json(path)


def read_roi(spark: SparkSession, path: str) -> DataFrame:
    """Regions ``sample, roi``; the JSON object is read as a map of axes."""
    with folder_reader(spark) as reader:
        text = reader.option("wholetext", True).text(path)
    return text.select(sample_of_path(_path()).alias("sample"), F.from_json("value", schemas.ROI).alias("roi"))


def with_full_roi(samples: DataFrame, roi: DataFrame) -> DataFrame:
    """Region of every sample, the whole slide where none is given."""
    whole = F.from_json(
        F.lit('{"0":{"location":0,"size":1},"1":{"location":0,"size":1}}'), schemas.ROI
    )
    return samples.select("sample").join(roi, "sample", "left").withColumn("roi", F.coalesce("roi", whole))


def read_nuclei(spark: SparkSession, path: str) -> DataFrame:
    """Nuclei of segmentation JSON, one row each: ``sample, tile, ids, centroid, ...``.

    Accepts the single object with a map of nuclei as well as the lines written
    by :func:`write_nuclei_json`. A line file carries its sample in its folder.
    """
    found = spark.read.schema(schemas.NUCLEI_JSON).option("multiLine", True).json(path)
    return found.select(
        sample_of_path(_path()).alias("sample"), base_name(_path()).alias("tile"), F.explode("nuc").alias("ids", "_n")
    ).select("sample", "tile", "ids", "_n.*")


def read_nuclei_lines(spark: SparkSession, path: str) -> DataFrame:
    """Nuclei written one per line."""
    return spark.read.schema(f"sample STRING, ids STRING, {schemas.NUCLEUS}").json(path)


def write_nuclei_json(nuclei: DataFrame, path: str) -> None:
    """Compressed JSON lines, one nucleus each, by sample."""
    nuclei.write.partitionBy("sample").mode("overwrite").option("compression", "gzip").json(path)


def read_features(spark: SparkSession, path: str, model: str, factor: float) -> DataFrame:
    """Feature table (comma separated whatever its name) with packed vectors."""
    raw = spark.read.option("header", True).option("sep", ",").csv(path)
    packed = [c for c in raw.columns if "feat" in c]
    kept = [c for c in raw.columns if "feat" not in c]
    numbers = {c: F.col(c).cast("int") for c in kept if c != "barcode"}
    return raw.withColumn("sample", sample_of_path(_path())).withColumns(numbers).select(
        "sample",
        *kept,
        F.array(*[F.col(c).cast("float") for c in packed]).alias("features"),
        F.lit(model).alias("model"),
        F.lit(float(factor)).alias("expansion_factor"),
    )


def write_features(df: DataFrame, path: str, model: str, width: int) -> None:
    """Feature table with one ``feat_<model>_<i>`` column per vector entry."""
    wide = [F.col("features")[i].alias(f"feat_{model}_{i}") for i in range(width)]
    kept = [c for c in df.columns if c not in ("features", "model", "expansion_factor")]
    write_table(df.select(*kept, *wide), path)


def write_table(df: DataFrame, path: str) -> None:
    """Compressed CSV with a header, by sample."""
    df.write.partitionBy("sample").mode("overwrite").option("compression", "gzip").csv(path, header=True)


def write_obs_store(df: DataFrame, path: str) -> None:
    """Feature store in Parquet by sample, model and expansion factor."""
    df.write.partitionBy("sample", "model", "expansion_factor").mode("overwrite").parquet(path)


def read_obs_store(spark: SparkSession, path: str) -> DataFrame:
    """The feature store; filters on its three folder columns prune files."""
    return spark.read.parquet(path)


def publish(df: DataFrame, outdir: str, name: str, overwrite: bool = True, by: tuple[str, ...] = ("sample",)) -> None:
    """Write a result by sample under ``outdir/name``.

    With ``overwrite`` the samples present are replaced and others stay; without
    it samples written before are kept and only new ones are added.
    """
    path = f"{outdir.rstrip('/')}/{name}"
    spark = df.sparkSession
    if overwrite:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(path)
        return
    try:
        done = spark.read.parquet(path).select(*[F.col(c).cast(dict(df.dtypes)[c]).alias(c) for c in by]).distinct()
        df = df.join(done, list(by), "left_anti")
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
    df.write.mode("append").partitionBy(*by).parquet(path)


def publish_matrix(counts: DataFrame, outdir: str, merge: bool) -> None:
    """Count tables of all species, in one folder per sample or one per species."""
    by = ("sample",) if merge else ("sample", "species")
    publish(counts, outdir, "raw_feature_bc_matrix", by=by)


def write_reads_by_class(reads: DataFrame, path: str) -> None:
    """FASTQ text of the kept reads by sample, species and mate."""
    record = F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_id")), "seq", F.lit("+"), "qual")
    shaped = reads.select("sample", "species", "mate", record.alias("value"))
    shaped.write.partitionBy("sample", "species", "mate").mode("overwrite").option("compression", "gzip").text(path)


def export_run(spark: SparkSession, params: Mapping[str, Any], samples: DataFrame, outdir: str) -> None:
    """Run parameters and one record per sample as JSON."""
    pairs = F.create_map(*[F.lit(v) for k, val in params.items() for v in (k, str(val))])
    root = outdir.rstrip("/")
    line = spark.range(1).select(format_params(pairs).alias("value"))
    line.write.mode("overwrite").text(f"{root}/parameters")
    record = spread_evenly(samples, "sample").select("sample", format_params(F.struct("*")).alias("value"))
    folder_writer(record).mode("overwrite").text(f"{root}/info")
