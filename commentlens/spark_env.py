"""Session helpers: where shared scratch data goes."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, where every task
    sees the same disk, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="commentlens-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    For wide intermediate results that are read several times: later readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` returned, once nothing that is still to run reads them.

    Results that were written or checkpointed since then do not need them, lost executors included.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs that are over: it does so when the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the session's Python workers, once: their functions import it."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_shipped_package", None) != str(package):
        folder = tempfile.mkdtemp(prefix="package-")
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        context._shipped_package = str(package)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages survive lost executors without recomputing ``df``."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
