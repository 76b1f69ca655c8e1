"""Dealing rows over the cluster before each of them is multiplied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` hash partitioned by ``keys``, which should tell its rows apart.

    One row of a text or a contour becomes thousands of rows, yet a file of a few
    megabytes is read by one task. Shuffling the rows while they are few costs
    little against what they become; adaptive execution merges partitions that
    turn out small.
    """
    return df.repartition(*keys)


def spread_evenly(df: DataFrame, *keys: str) -> DataFrame:
    """As :func:`spread`, in a fixed number of partitions that adaptive execution does not merge.

    For rows of few bytes that each cost much: a folder, a canvas, a tile.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def tasks_for(df: DataFrame, size: Column, share: int) -> int:
    """Tasks that ``df`` needs if each is to hold ``share`` of the sum of ``size``; at least one for each core.

    A shuffle has a fixed number of partitions, so without this the share of a task would grow with its input.
    """
    total = df.agg(F.sum(size).alias("total")).first().total or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-int(total) // share))
