"""The session that the engine expects; a cluster's own session works as well."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: AQE splits skewed partitions and coalesces small ones; UTC keeps dates comparable; Arrow moves batches to Python.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with :data:`CONF`; ``master`` and ``shuffle_partitions`` for local use."""
    builder = SparkSession.builder.appName("archivelens")
    if master:
        builder = builder.master(master)
    for k, v in (CONF | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only where it is unset on one machine, as in tests."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='archivelens-')}")
    return context.getCheckpointDir()
