"""Joins whose sides are both large, or whose keys may be crowded on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner join that is never a broadcast.

    Spark takes the compressed bytes of a Parquet file for the size of a table;
    sorted columns that repeat take 2 to 3 bytes a row there and far more in
    memory, so a "small" side can fill the driver that has to build it.
    """
    return left.join(right.hint("merge"), keys if isinstance(keys, str) else list(keys))


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_by: str, right_by: str, crowd: int = 2000) -> DataFrame:
    """Inner join on ``keys``; the pairs of a crowded key are spread over chunk pairs.

    A key with more than ``crowd`` rows on a side is cut into chunks on that
    side by a hash of ``left_by`` or ``right_by``; every chunk of one side meets
    every chunk of the other in a group of its own, so no task makes more than
    about ``crowd`` squared pairs of one key.  The rows are those of the plain
    join.  Keys are counted with map-side combination.
    """
    size = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    parts = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / crowd).cast("int")
    both = merge_join(size(left, "_l"), size(right, "_r"), keys).where((F.col("_l") > crowd) | (F.col("_r") > crowd))
    crowded = both.select(*keys, parts(F.col("_l")).alias("_nl"), parts(F.col("_r")).alias("_nr"))

    def place(df: DataFrame, by: str, own: str, other: str, mine: str, theirs: str) -> DataFrame:
        sized = df.join(crowded, list(keys), "left")
        chunk = F.coalesce(F.pmod(F.xxhash64(by), F.col(own)).cast("int"), F.lit(0))
        meets: Column = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        return sized.withColumn(mine, chunk).withColumn(theirs, meets).drop("_nl", "_nr")

    if crowded.isEmpty():
        return merge_join(left, right, keys)
    a = place(left, left_by, "_nl", "_nr", "_cl", "_cr")
    b = place(right, right_by, "_nr", "_nl", "_cr", "_cl")
    return merge_join(a, b, [*keys, "_cl", "_cr"]).drop("_cl", "_cr")
