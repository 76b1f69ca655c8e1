"""Shards that all match the mixture: proportional stratified interleaving.

Rows are shuffled within each source by a seeded hash and ranked; a row's
fractional rank is its rank over the size of its source. Sorting by it
interleaves the sources in proportion, and equal cuts of that order are shards
in which every source has its share. Shard sizes in rows differ by one at most.

Both orders are range partitioned, so a source with a third of all rows spreads
over as many tasks as it fills; ranks are running numbers inside a partition
plus the counts of the partitions before it. Texts stay out of the shuffles.

Defined cases: a null source is a source of its own, a null text has size 1 and
the checksum of no bytes; rows alike in id, source and text are interchangeable;
with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.plans.lineage import store

SHARDS = 16
SEED = 20

_INDEX_BITS = 33


def _numbered(rows: DataFrame, group: list[str], order: list, name: str, total: str) -> DataFrame:
    """``rows`` with a number from 0 in ``order`` inside ``group`` and the size of the group.

    ``monotonically_increasing_id`` holds the partition and the place in it. The
    placement is written down before it is counted, so that it cannot change.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in group]
    placed = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = store(placed.withColumn("_at", F.monotonically_increasing_id()), "order")
    placed = placed.withColumn("_part", F.shiftright("_at", _INDEX_BITS))
    by = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    # One row per partition and group.
    counts = placed.groupBy(*by, F.col("_part").alias("_p")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = [f"_g{i}" for i in range(len(group))] or [F.lit(0)]
    before = Window.partitionBy(*own).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[c for c in own if isinstance(c, str)], "_p", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"), F.sum("_n").over(Window.partitionBy(*own)).alias("_total"),
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    joined = placed.join(counts, same)
    number = (F.col("_at") - F.col("_first") + F.col("_ahead")).cast("long")
    return joined.select(*rows.columns, number.alias(name), F.col("_total").cast("long").alias(total))


def assign_shards(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` (``doc_id, source, size, text_crc32``) with ``shard`` and ``slot``, its place in the shard from 0."""
    ties = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc(), F.col("size").asc()]
    mixed = rows.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    ranked = _numbered(mixed, ["source"], [F.col("_hash").asc(), *ties], "_rank", "_of")
    # Half a rank in, so that sources of any size spread evenly over (0, 1).
    ranked = ranked.withColumn("_fraction", (F.col("_rank") + 0.5) / F.col("_of"))
    order = [F.col("_fraction").asc(), F.xxhash64(F.lit(seed), "source").asc(), F.col("source").asc_nulls_first(), F.col("_rank").asc()]
    placed = _numbered(ranked, [], order, "_place", "_all")
    # Shard s holds the places from ceil(s * all / shards) on; whole-number division throughout.
    shard = F.expr(f"CAST((_place * {shards}) DIV _all AS INT)")
    first = F.expr(f"(_shard * _all + {shards - 1}) DIV {shards}")
    placed = placed.withColumn("_shard", shard)
    return placed.select("doc_id", "source", "size", "text_crc32", F.col("_shard").alias("shard"), (F.col("_place") - first).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Shard and slot of every document row, without its text."""
    text = F.coalesce("text", F.lit(""))
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    light = docs.select(
        "doc_id", source.alias("source"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return assign_shards(store(light, "shard-rows"), shards, seed)
