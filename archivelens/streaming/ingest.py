"""Incremental runs as streams (inventory T1-T3, T5, T6).

Near duplicates and versions need their whole group, so a micro-batch is resolved together with the stored
documents of the applications that it touches, in ``foreachBatch``; everything else is a row-wise plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import canonical, website
from ..session import shared_folder


def file_stream(spark: SparkSession, folder: str, schema: str, form: str = "parquet", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(form).schema(schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).load(folder)


def run_once(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Work off what has come so far, batch by batch; the checkpoint remembers it, so nothing comes twice."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def resolve_versions(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Statuses of all files of the applications that a batch touches, stored ones included."""
    keyed = lambda d: d.withColumn("k", canonical.group_key(F.col("filename")))
    touched = keyed(batch).select("k").distinct()
    known = keyed(stored).join(touched, "k", "left_semi").join(batch.select("filename"), "filename", "left_anti").select("filename", "content")
    return canonical.canonicalize(batch.select("filename", "content").unionByName(known))


def page_stream(pages: DataFrame, org: str, late: str = "7 days") -> DataFrame:
    """Scraped pages as staged documents; a page that comes again unchanged within the watermark is dropped."""
    staged = website.staged(pages, org).filter("status = 'staged'").withColumn("scraped", F.to_timestamp("scraped_at"))
    return staged.withWatermark("scraped", late).dropDuplicatesWithinWatermark(["source_url", "content_hash"])


def events_by_window(spark: SparkSession, path: str, window: str = "1 day") -> DataFrame:
    """Events and values by day and type, worked off as a stream; equals the batch aggregate.

    Each batch replaces the table of all windows so far, in the folder that executors share, where the stream's state is too.
    """
    schema = spark.read.parquet(path).schema
    folder, name = path.rsplit("/", 1)
    events = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder if path.endswith(".parquet") else path)
    events = events.withColumn("ts", events["ts"].cast("timestamp"))  # files may hold times without a zone
    by = events.withWatermark("ts", "1 hour").groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    place = f"{shared_folder(spark)}/events-{uuid.uuid4().hex}"
    query = by.writeStream.outputMode("complete").foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{place}/table")).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{place}/table").select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "events", F.round("value", 4).alias("value"))
