"""Value-frequency compression: results per key without a task per key.

Rows are first counted per (key, value).  Map-side combining shrinks a hot key
to its distinct values before anything is shuffled, and the values of one key
spread over all tasks.  Counts, distinct counts and modes of a key are then
algebraic sums over its weighted values; percentiles are found by cutting the
values into ranges; lists are written in chunks of bounded length.

NULL and blank keys are keys like any other (callers filter them); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_frequencies(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key, value, n``: one row per distinct pair with its number of rows."""
    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{value}`").alias("value")).groupBy("key", "value").agg(F.count("*").alias("n"))


def key_statistics(frequencies: DataFrame) -> DataFrame:
    """Rows, distinct non-null values, and the mode with its count.

    Of equally frequent values the smallest is the mode; a key whose values
    are all NULL has mode NULL and mode_rows 0.
    """
    known = F.col("value").isNotNull()
    best = F.max(F.when(known, F.col("n")))
    first = frequencies.groupBy("key").agg(F.sum("n").alias("rows"), F.count(F.when(known, 1)).alias("distinct_values"), F.coalesce(best, F.lit(0)).alias("mode_rows"), F.min_by("value", F.when(known, F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))).alias("mode"))
    return first.select("key", "rows", "distinct_values", "mode", "mode_rows")


def heavy_keys(frequencies: DataFrame, share: float = 0.01) -> DataFrame:
    """``key, rows`` of the keys holding at least ``share`` of all rows.

    At most ``1 / share`` rows come out, so the result is safe to broadcast.
    All rows count in the total, those with NULL keys too.
    """
    per_key = frequencies.groupBy("key").agg(F.sum("n").alias("rows"))
    total = frequencies.groupBy(F.lit(1).alias("_one")).agg(F.sum("n").alias("_total"))
    joined = per_key.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    return joined.where(F.col("rows") >= F.lit(share) * F.col("_total")).where("key IS NOT NULL").select("key", "rows")


def weighted_percentiles(frequencies: DataFrame, probabilities: Sequence[float], ranges: int = 256) -> DataFrame:
    """Exact discrete percentiles per key: ``key, probability, value``.

    The percentile is the smallest value at which the share of rows reaches the
    probability.  The values of a key are cut into ``ranges`` equal ranges
    between its least and greatest value; sums per range find the range of each
    percentile, and only the values of that range are ordered.  A range that is
    still crowded (many values close together) is ordered by a shuffle of its
    own distinct values, never of its rows.
    """
    f = frequencies.where("value IS NOT NULL")
    bounds = f.groupBy("key").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("n").alias("total"))
    width = (F.col("hi").cast("double") - F.col("lo").cast("double")) / ranges
    slot = F.when(width > 0, F.least(F.lit(ranges - 1), F.floor((F.col("value").cast("double") - F.col("lo").cast("double")) / width))).otherwise(0).cast("int")
    placed = f.join(bounds, "key").select("key", "value", "n", "total", slot.alias("slot"))
    sums = placed.groupBy("key", "slot", "total").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("key").orderBy("slot")
    upto = sums.withColumn("before", F.sum("n").over(w) - F.col("n"))
    wanted = upto.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
    need = F.greatest(F.lit(1), F.ceil(F.round(F.col("probability") * F.col("total"), 9)))
    hit = wanted.withColumn("need", need).where((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("n"))).select("key", "slot", "probability", "need", "before")
    inside = placed.select("key", "slot", "value", "n").join(hit.select("key", "slot").distinct(), ["key", "slot"], "left_semi")
    running = inside.withColumn("upto", F.sum("n").over(Window.partitionBy("key", "slot").orderBy("value")))
    found = hit.join(running, ["key", "slot"]).where(F.col("before") + F.col("upto") >= F.col("need"))
    return found.groupBy("key", "probability").agg(F.min("value").alias("value"))


def chunked_lists(frequencies: DataFrame, chunk: int = 1000) -> DataFrame:
    """Complete lists of the values per key, in chunks: ``key, chunk, values, weights``.

    A key of d distinct values has about ``d / chunk`` chunks, each built by its
    own group, so no task carries the whole list of a hot key.
    """
    sizes = frequencies.groupBy("key").agg(F.count("*").alias("_d"))
    placed = frequencies.join(sizes.withColumnRenamed("key", "_key"), F.col("key").eqNullSafe(F.col("_key"))).drop("_key")
    slot = F.pmod(F.xxhash64("value"), F.ceil(F.col("_d") / chunk)).cast("int").alias("chunk")
    pairs = placed.select("key", slot, F.struct("value", "n").alias("_v")).groupBy("key", "chunk").agg(F.array_sort(F.collect_list("_v")).alias("_l"))
    return pairs.select("key", "chunk", F.transform("_l", lambda x: x["value"]).alias("values"), F.transform("_l", lambda x: x["n"]).alias("weights"))
