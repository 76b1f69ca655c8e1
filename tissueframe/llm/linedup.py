"""Removal of repeated runs of lines, with DataFrame operations only.

The corpus is read as sequences of line ids. A suffix array over them is built
by prefix doubling: the rank of the ``2k`` lines from a position follows from
the pair of ranks of its two halves, and only positions whose rank is shared go
on. Positions of equal rank form an interval of the suffix array whose common
prefix is at least that long, so an interval is a repeated run and its smallest
position the copy that stays.

The rule: a position is (document, line) and documents are ordered by
``doc_id``. Every line of a run of consecutive lines that holds at least
``min_words`` words and also occurs at an earlier position is deleted. It is
enough to look at the shortest such run beginning and the shortest ending at
each line: each line of a longer repeated run lies in one of these, and each of
these lies inside the longer run.

Defined cases: a null or empty text has no line and stays as it is; rows with
one ``doc_id`` count as one document (a row's line ``i`` precedes line ``j > i``
of the other, and equal lines at equal places stay in both); a null ``doc_id``
comes after every other id; copies may overlap, in one text too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.llm.textops import WORD
from tissueframe.plans.lineage import store

#: Words that a repeated run needs. Runs below it (headings, single words) are left alone.
MIN_WORDS = 5

_LAST = (1 << 63) - 1
_STRIDE = 1 << 31
_ROW = ["_doc", "_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return docs.withColumns({"_doc": doc, "_hash": F.xxhash64("text")})


def _position(line) -> F.Column:
    return (F.col("_doc").cast("decimal(20,0)") * F.lit(_STRIDE).cast("decimal(11,0)") + line).cast("decimal(38,0)")


def _named(occurrences: DataFrame, by: list[str]) -> DataFrame:
    """One row per repeated key: its rank in key order and its smallest position.

    Keys are range partitioned and sorted, and the running number keeps that
    order, so ranks compare as the runs they stand for do. Written down, as a
    new sampling of the ranges would number anew.
    """
    spark = occurrences.sparkSession
    shared = (
        occurrences.groupBy(*by).agg(F.min("_at").alias("_first"), F.count("*").alias("_copies")).where("_copies > 1").drop("_copies")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = store(shared, "line-classes")
    return store(shared.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_rank", F.monotonically_increasing_id()), "line-ranks")


def _shortest_runs(first: DataFrame, min_words: int) -> DataFrame:
    """Shortest runs of repeated lines with ``min_words`` words that begin or end at each line."""
    doc = Window.partitionBy(*_ROW)
    lines = first.withColumn("_run", F.col("_line") - F.row_number().over(doc.orderBy("_line")))
    run = Window.partitionBy(*_ROW, "_run")
    lines = lines.withColumn("_upto", F.sum("_words").over(run.orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumns({
        "_before": F.col("_upto") - F.col("_words"), "_total": F.sum("_words").over(run),
        "_begin": F.min("_line").over(run), "_end": F.max("_line").over(run),
    })
    # Both frames grow by rows as the window moves on, so a document costs time in proportion to its lines.
    ahead = F.min("_line").over(run.orderBy(F.desc("_before")).rangeBetween(Window.unboundedPreceding, -min_words))
    behind = F.max("_line").over(run.orderBy("_upto").rangeBetween(Window.unboundedPreceding, -min_words))
    lines = lines.withColumns({"_ahead": ahead, "_behind": behind})
    forward = F.when(F.col("_total") >= F.col("_before") + min_words, F.coalesce(F.col("_ahead") - 1, "_end"))
    backward = F.when(F.col("_upto") >= min_words, F.coalesce(F.col("_behind") + 1, "_begin"))
    spans = F.array(
        F.struct(F.col("_line").alias("_start"), (forward - F.col("_line") + 1).cast("int").alias("_size")),
        F.struct(backward.alias("_start"), (F.col("_line") - backward + 1).cast("int").alias("_size")),
    )
    return lines.select(*_ROW, F.explode(F.array_distinct(spans)).alias("_s")).select(*_ROW, "_s.*").where("_size IS NOT NULL AND _start IS NOT NULL")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Line numbers (from 0) to delete by document key, as ``(_doc, _hash, _removed)``."""
    lines = _keyed(docs.select("doc_id", "text")).where("text <> ''").select(
        *_ROW, F.posexplode(F.split("text", "\n")).alias("_line", "_text")
    )
    lines = lines.select(
        *_ROW, "_line", F.xxhash64("_text").alias("_a"), F.xxhash64(F.lit(7), "_text").alias("_b"),
        F.regexp_count("_text", F.lit(WORD)).cast("long").alias("_words"),
    )
    lines = store(lines, "lines").withColumn("_at", _position(F.col("_line")))
    # Rows equal in id and text are the same lines at the same positions.
    level = lines.join(_named(lines, ["_a", "_b"]), ["_a", "_b"]).drop("_a", "_b").dropDuplicates([*_ROW, "_line"])
    level = store(level, "suffixes")
    spans = store(_shortest_runs(level, min_words).distinct(), "runs")
    longest = spans.agg(F.max("_size")).first()[0] or 0
    single = level.where("_first < _at").withColumnRenamed("_line", "_start").select(*_ROW, "_start")
    later = [spans.where("_size = 1").join(single, [*_ROW, "_start"]).select(*_ROW, "_start", "_size")]
    step = 1  # ranks of ``level`` stand for this many lines
    while 2 * step <= longest:
        half = level.select(*_ROW, (F.col("_line") - step).alias("_line"), F.col("_rank").alias("_right"))
        pairs = level.select(*_ROW, "_line", F.col("_rank").alias("_left"), "_at").join(half, [*_ROW, "_line"])
        pairs = store(pairs, "pairs")
        level = store(pairs.join(_named(pairs, ["_left", "_right"]), ["_left", "_right"]).drop("_left", "_right", "_first"), "suffixes")
        step *= 2
        # The ranks at both ends name a run of up to twice as many lines.
        tested = spans.where((F.col("_size") >= step) & (F.col("_size") < 2 * step))
        head = level.select(*_ROW, F.col("_line").alias("_start"), F.col("_rank").alias("_left"), "_at")
        tail = level.select(*_ROW, F.col("_line").alias("_tail"), F.col("_rank").alias("_right"))
        tested = tested.join(head, [*_ROW, "_start"]).withColumn("_tail", F.col("_start") + F.col("_size") - step)
        tested = store(tested.join(tail, [*_ROW, "_tail"]).drop("_tail"), "tested")
        by = ["_left", "_right", "_size"]
        later.append(tested.join(_named(tested, by), by).where("_first < _at").select(*_ROW, "_start", "_size"))
    covered = later[0]
    for part in later[1:]:
        covered = covered.unionByName(part)
    covered = covered.select(*_ROW, F.explode(F.sequence("_start", F.col("_start") + F.col("_size") - 1)).alias("_line"))
    return covered.groupBy(*_ROW).agg(F.collect_set("_line").alias("_removed"))


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` stripped of later copies, and the columns ``n_lines`` and ``n_removed``.

    Lines that stay are joined by a line feed. Input columns ``n_lines`` and
    ``n_removed`` are replaced; the lines are counted before the removal.
    """
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    inner = {c: f"_own{i}" for i, c in enumerate(names) if c not in ("doc_id", "text")}
    own = docs.select(*[F.col(f"`{c}`").alias(inner.get(c, c)) for c in names])
    rows = _keyed(own).join(repeated_lines(own, min_words), _ROW, "left")
    rows = rows.withColumn("_lines", F.when(F.col("text") != "", F.split("text", "\n")).otherwise(F.array().cast("array<string>")))
    every = F.when(F.size("_lines") > 0, F.sequence(F.lit(0), F.size("_lines") - 1))
    rows = rows.withColumn("_left", F.array_except(every, "_removed"))
    text = F.array_join(F.transform("_left", lambda i: F.get("_lines", i)), "\n")
    removed = F.col("_removed").isNotNull()
    rows = rows.withColumns({
        "text": F.when(removed, text).otherwise(F.col("text")),
        "n_lines": F.size("_lines").cast("long"),
        "n_removed": F.when(removed, F.size("_removed")).otherwise(0).cast("long"),
    })
    return rows.select(*[F.col(inner.get(c, c)).alias(c) for c in names], "n_lines", "n_removed")


def clean_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without later copies of line runs: same columns, ``n_chars`` (if there) counted anew.

    A document of which no line stays is dropped; one without text from the start stays.
    """
    inner = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    own = docs.select(*[F.col(f"`{c}`").alias(inner.get(c, c)) for c in docs.columns])
    rows = drop_repeated_lines(own, min_words).where("n_removed = 0 OR n_removed < n_lines")
    out = {c: F.col(inner.get(c, c)).alias(c) for c in docs.columns}
    if "n_chars" in out:
        own_type = docs.schema["n_chars"].dataType
        counted = F.when(F.col("n_removed") > 0, F.length("text").cast(own_type)).otherwise(F.col(inner["n_chars"]))
        out["n_chars"] = counted.alias("n_chars")
    return rows.select(*out.values())
