"""Tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where it is unset on one machine, as in tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="archivelens-")
        spark.sparkContext.setCheckpointDir(f"file://{_OWN[app]}")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)
    return f"file://{_OWN[app]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below a folder of this application."""
    return f"{shared_dir(spark)}/archivelens-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, which cuts its lineage.

    Later jobs read the table instead of repeating the work, also after executors were lost.
    What writing it left in the driver is freed, so that garbage of one query doesn't make the heap grow under the next.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(kept: DataFrame) -> None:
    """Delete a kept table that no later step reads."""
    spark = kept.sparkSession
    mine = f"/archivelens-{spark.sparkContext.applicationId}/"
    for path in {f.rsplit("/", 1)[0] for f in kept.inputFiles() if mine in f}:
        _delete(spark, path)


def tidy(spark: SparkSession) -> None:
    """Collect what finished jobs left in the driver: plans, broadcast tables and generated classes stay until the JVM does, and it then returns memory."""
    gc.collect()  # Python's handles keep plans alive
    spark._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete every table that this application has kept."""
    _delete(spark, f"{shared_dir(spark)}/archivelens-{spark.sparkContext.applicationId}")
