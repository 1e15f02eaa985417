"""Incremental merge: rows whose key is not yet in the full table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lorewright.functions.ids import normalize_row_ids
from lorewright.sources.flat import rename_columns


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NULL keys equal empty ones."""
    return df.withColumns({f"_k{i}": F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for i, k in enumerate(keys)})


def net_new(incremental: DataFrame, full: DataFrame | None, keys: Sequence[str], mapping: Mapping[str, str] | None = None, normalize: bool = True) -> DataFrame:
    """Left anti join on one or several columns.

    The incremental side's ids are normalised first.  Rows with a known key
    are dropped even where other values changed; repeated new keys all stay.
    Without a full table every row is new.  Only the key columns of the full
    side are read; AQE turns the join into a broadcast when the key side is small.
    """
    inc = normalize_row_ids(incremental) if normalize else incremental
    if full is None:
        return inc
    known = rename_columns(full, mapping) if mapping else full
    names = [f"_k{i}" for i in range(len(keys))]
    known = _keyed(known.select(*[F.col(f"`{k}`") for k in keys]), keys).select(*names)
    return _keyed(inc, keys).join(known, names, "left_anti").drop(*names)


def merge_stats(incremental: DataFrame, full: DataFrame, keys: Sequence[str], normalize: bool = True) -> DataFrame:
    """One row: rows read, new rows, duplicates and the duplicate rate in percent."""
    names = [f"_k{i}" for i in range(len(keys))]
    inc = _keyed(normalize_row_ids(incremental) if normalize else incremental, keys).groupBy(*names).agg(F.count("*").alias("_n"))
    known = _keyed(full, keys).select(*names).distinct().withColumn("_hit", F.lit(1))
    j = inc.join(known, names, "left")
    total, dup = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("_hit") == 1, F.col("_n"))), F.lit(0))
    return j.agg(total.alias("total_rows"), (total - dup).alias("new_rows"), dup.alias("duplicate_rows")).withColumn(
        "duplicate_rate", F.round(F.when(F.col("total_rows") > 0, 100.0 * F.col("duplicate_rows") / F.col("total_rows")).otherwise(0.0), 4)
    )


def key_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, and the rows beyond the first of each key."""
    names = [f"_k{i}" for i in range(len(keys))]
    per = _keyed(df, keys).groupBy(*names).agg(F.count("*").alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count("*").alias("distinct_keys")).withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))


def shard_histogram(df: DataFrame, keys: Sequence[str], shards: int = 100) -> DataFrame:
    """Rows per hash shard: the first 32 bits of the key's md5, modulo ``shards``."""
    key = F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`"), F.lit("")) for k in keys])
    shard = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % shards
    return df.groupBy(shard.alias("shard")).agg(F.count("*").alias("rows"))


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``, remaining ties by all columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in [*order, *rest]])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
