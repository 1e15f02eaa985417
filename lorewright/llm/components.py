"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorewright.session import materialize


def _settled(e: DataFrame) -> bool:
    """Whether the edges ``u -> v`` are stars: no node points twice, and none that is pointed to points on."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    per = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return per.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 30, join: Callable[[DataFrame, DataFrame, str], DataFrame] = DataFrame.join) -> DataFrame:
    """``node, component``: every node of ``edges`` (``a, b``) with the least node it can reach.

    Large-star and small-star rounds turn each component into one star; each
    round is written to the shared folder, so lineage stays short.  A hub's
    neighbours are never gathered: the minimum is an aggregate and the new
    links come from a ``join``.  Raises when ``max_rounds`` do not suffice.
    """
    e = materialize(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(e):
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join(both.where("v > u"), least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: the smaller neighbours of u, and u itself, point to the least of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join(large, down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        e = materialize(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
