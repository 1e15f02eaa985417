"""Flat CSV tables: every value is text, missing is empty."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lorewright.schemas import FLAT_COLUMNS

_CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_flat(spark: SparkSession, paths: str | Sequence[str], table: str | None = None, recursive: bool = False) -> DataFrame:
    """One frame over all files; quoted line breaks and doubled quotes are honoured.

    With ``table`` the schema is fixed (all strings) and nothing is inferred.
    """
    r = spark.read.options(**_CSV, multiLine="true", recursiveFileLookup=str(recursive).lower())
    if table:
        r = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in FLAT_COLUMNS[table]])).option("enforceSchema", "false")
    df = r.csv(list(paths) if not isinstance(paths, str) else paths)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def write_flat(df: DataFrame, path: str, columns: Sequence[str] | None = None, strict: bool = False, gzip: bool = True, mode: str = "errorifexists") -> None:
    """Write a flat table; ``strict`` refuses columns outside ``columns``."""
    if columns is not None:
        unknown = [c for c in df.columns if c not in columns]
        if strict and unknown:
            raise ValueError(f"unknown columns: {unknown}")
        df = df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
    w = df.write.mode(mode).options(**_CSV, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", quoteAll="true")
    w.option("compression", "gzip" if gzip else "none").csv(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    """Fan one parsed scan out into its tables, with the columns that flattening gave them (a catalogue's own id included)."""
    for name, df in tables.items():
        known = FLAT_COLUMNS[name]
        write_flat(df, f"{root}/{name}", df.columns if name.endswith("_ids") else known, mode=mode)


def output_exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished output stands at ``path`` (its ``_SUCCESS`` mark)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Bring a full table with other column names to ours: ``{our: theirs}``."""
    return df.withColumnsRenamed({theirs: ours for ours, theirs in mapping.items()})


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """A typed view of text columns; what does not parse becomes NULL."""
    return df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")).try_cast(t) for c, t in types.items() if c in df.columns})
