"""A corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tissueframe.llm import decontaminate, linedup, packing, quality, simhash
from tissueframe.llm.queries import tokenizer_path
from tissueframe.plans.lineage import store


#: Documents of an Arrow batch at most. Spark's default of 10,000 whole texts stands in the JVM and in each Python worker at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python at most ``BATCH_ROWS`` at a time; a session that asks for fewer keeps its setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


def judge_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the attention model, fitted on this stage's input, does not reject."""
    small_batches(spark)
    return quality.keep_good(docs, _labels(spark, folder))


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without later copies of line runs."""
    return linedup.clean_lines(docs)


#: Differing fingerprint bits of near copies here, one more than the operator's default: most copies with a
#: changed word or two differ by three.
COPY_BITS = 3
#: Jaccard similarity of 5-word shingles from which documents are near copies here, whatever their fingerprints.
COPY_SIMILAR = 0.8


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    small_batches(spark)
    return simhash.one_of_each(docs, budget=COPY_BITS, bound=COPY_SIMILAR)


def drop_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet"))


def pack_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token sequences: one row per piece, with its ids."""
    small_batches(spark)
    return packing.pack(docs, tokenizer_path(), ids=True)


STAGES = [
    ("quality", judge_quality),
    ("lines", drop_lines),
    ("copies", drop_copies),
    ("leaks", drop_leaks),
    ("packing", pack_tokens),
]

#: A trained model, random walks and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and reread."""
    docs = spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if at + 1 < len(STAGES):
            docs = store(docs, f"stage-{name}")
    return docs
