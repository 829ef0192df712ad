"""Connected components by label propagation (inventory J15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, in the cluster's checkpoint folder; a temporary one only where none is set, as in tests."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """node and cluster, the least node connected with it, from undirected edges a, b.

    Each step takes the least label of all neighbours, then that label's own label, so long chains
    shorten by half; steps end when no label changes.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("u", "v"))
    labels = checkpointed(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("cluster")))
    while True:
        least = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("cluster").alias("low"))
        near = labels.join(least, F.col("node") == F.col("u")).select("node", F.least("cluster", "low").alias("to"), F.col("cluster").alias("was"))
        own = labels.select(F.col("node").alias("via"), F.col("cluster").alias("far"))
        moved = checkpointed(near.join(own, F.col("to") == F.col("via")).select("node", F.least("to", "far").alias("cluster"), "was"))
        if moved.filter("cluster <> was").isEmpty():
            return moved.select("node", "cluster")
        labels = moved.select("node", "cluster")
