"""Partitioned JSON-lines snapshots: ``<root>/<entity>/updated_date=YYYY-MM-DD/*.gz``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorewright.schemas import raw_schema

LATEST = "latest"


def read_lines(spark: SparkSession, root: str, entity: str, glob: str = "*.gz") -> DataFrame:
    """Raw lines with their partition date and file.

    Lines are read as text: read as JSON, the partition column would replace
    the record's own ``updated_date``.  Gzip files do not split, so one file is
    one task; spread the lines afterwards if files are few and large.
    """
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(f"{root}/{entity}")
        .select(
            F.col("updated_date").cast("date").alias("partition_date"),
            F.col("_metadata.file_path").alias("file_name"),
            F.col("value").alias("line"),
        )
    )


def parse_lines(lines: DataFrame, entity: str, column: str = "line", strict: bool = False) -> DataFrame:
    """Parse JSON lines; extra columns of the input are carried along.

    Blank lines never count.  A broken line is dropped, or fails the query when
    ``strict``.  Records without an id are dropped.
    """
    mode = {"mode": "FAILFAST" if strict else "PERMISSIVE"}
    parsed = lines.where(F.length(F.trim(column)) > 0).withColumn("_record", F.from_json(column, raw_schema(entity), mode))
    return parsed.where(F.length(F.trim("_record.id")) > 0)


def read_snapshot(spark: SparkSession, root: str, entity: str, start: str | None = None, end: str = LATEST) -> DataFrame:
    """Parsed records of the partitions from ``start`` to ``end``, both included."""
    lines = read_lines(spark, root, entity)
    if start is not None:
        stop = latest_date(lines) if end.lower() == LATEST else end
        lines = lines.where(F.col("partition_date").between(F.lit(start).cast("date"), F.lit(stop).cast("date")))
    return parse_lines(lines, entity)


def latest_date(lines: DataFrame) -> str | None:
    """One value: the newest partition date; partition metadata answers it."""
    return lines.agg(F.max("partition_date").cast("string")).first()[0]


def partition_dates(df: DataFrame, column: str = "partition_date") -> DataFrame:
    """The distinct dates, newest first."""
    return df.select(F.col(column).try_cast("date").alias("date")).where("date IS NOT NULL").distinct().orderBy(F.desc("date"))


def dates_in_range(df: DataFrame, column: str, start: str, end: str = LATEST) -> DataFrame:
    """Distinct dates from ``start`` to ``end``, both included, ascending.

    ``end='latest'`` (in any letter case) is the greatest date there is; texts
    that are no dates are skipped.
    """
    days = df.select(F.col(column).try_cast("date").alias("date")).where("date IS NOT NULL").distinct()
    lower = F.col("date") >= F.lit(start).cast("date")
    if end.lower() != LATEST:
        lower = lower & (F.col("date") <= F.lit(end).cast("date"))
    return days.where(lower).orderBy("date")


def nearest_date(df: DataFrame, column: str, target: str) -> DataFrame:
    """The date nearest to ``target``; of two equally near the later one.

    A target that is no date gives the latest date.
    """
    days = df.select(F.col(column).try_cast("date").alias("date")).where("date IS NOT NULL")
    gap: Column = F.abs(F.datediff("date", F.lit(target).try_cast("date")))
    return days.select("date", gap.alias("_gap")).orderBy(F.col("_gap").asc_nulls_last(), F.desc("date")).limit(1).select("date")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """File names of a newline-separated manifest, blank lines left out."""
    return spark.read.text(path).select(F.trim("value").alias("file_name")).where("file_name <> ''")


def listed_files(spark: SparkSession, root: str, entity: str, manifest: str = "manifest", glob: str = "*.gz") -> DataFrame:
    """``file_name`` of a snapshot's files: what its manifest names, or the folder's listing where there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{entity}/{manifest}")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return read_manifest(spark, f"{root}/{entity}/{manifest}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(f"{root}/{entity}")
    return files.select(F.col("path").alias("file_name"))


def pending_files(listed: DataFrame, done: DataFrame, column: str = "file_name") -> DataFrame:
    """Listed files that are not yet processed: resume by anti join."""
    return listed.join(done.select(column).distinct(), column, "left_anti")
