"""Session construction and the shared scratch folder.

Intermediate results that several consumers read are cut out of the lineage
by writing them to the folder named by ``spark.checkpoint.dir``; that folder
is shared by all executors, so the loss of one executor loses nothing.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

T = TypeVar("T")
CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "lorewright", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, UTC times and Arrow switched on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the path of the Python workers.

    The driver may have found the package by its own path or working folder.
    On machines without a shared file system the package is to be installed or
    shipped with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = f"{root}{os.pathsep}{known}" if known else root


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder; one of our own only where the session names none."""
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all machines share")
    own = tempfile.mkdtemp(prefix="lorewright-")
    spark.sparkContext.setCheckpointDir(own)
    return f"file://{own}"


def together(*jobs: Callable[[], T]) -> list[T]:
    """Run independent jobs at the same time: small ones leave most of a cluster idle.  The first error is raised."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inherit(j)) for j in jobs]]


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of a schema, as a plan that the optimizer removes; no Python rows are made."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where("false")


def tidy(spark: SparkSession) -> None:
    """Let go of the plans and shuffle files of finished jobs; for loops of many jobs, whose driver would keep them for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Few bytes, but much work in Python: over all cores, whatever the size says."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Like ``checkpoint()`` the result no longer depends on the lineage, but the
    columnar files keep column pruning and predicate pushdown for readers.  They
    are removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lorewright-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a ``materialize`` result that nothing reads any more."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
