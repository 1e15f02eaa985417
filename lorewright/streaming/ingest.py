"""Files that arrive while the pipeline runs: each new record is accepted once.

``availableNow`` reads what has arrived since the last checkpoint and stops,
so a periodic run resumes by file, as a download that skips present files does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lorewright.functions.ids import normalize_row_ids
from lorewright.operators.merge import first_wins, net_new
from lorewright.sources.flat import output_exists


def stream_lines(spark: SparkSession, root: str, glob: str = "*.gz", max_files: int = 100) -> DataFrame:
    """A stream of the raw lines under ``root``, with the file each came from."""
    return (
        spark.readStream.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(max_files))
        .text(root)
        .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file_name"))
    )


def accept_new(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], order: Sequence[str] = ()) -> StreamingQuery:
    """Append rows whose key the Parquet table at ``table`` does not hold yet.

    Within a micro-batch the first row of a key in ``order`` wins.  A repeated
    micro-batch appends nothing, because its keys are then known: the write is
    idempotent whatever the checkpoint says.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = first_wins(normalize_row_ids(batch), list(keys), list(order))
        full = spark.read.schema(batch.schema).parquet(table) if output_exists(spark, table) else None
        net_new(new, full, list(keys), normalize=False).write.mode("append").parquet(table)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, window: str, late: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per event-time window; rows later than ``late`` behind the newest are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("rows"))
