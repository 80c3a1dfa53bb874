"""Connected components by label spreading with pointer jumping, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from each node of ``edges`` (a, b).

    Every round takes the smallest label among a node and its neighbours, then
    the label of that label, so chains shorten geometrically.  Rounds end when
    no label changes; each round's labels are written, so lineage stays short.
    """
    spark = edges.sparkSession
    with scratch(spark) as keep:
        both = stored(
            edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
        )
        labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("moved")))
        while not labels.filter("moved").isEmpty():
            now = labels.select("node", "label")
            heard = both.join(now, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("heard"))
            near = now.join(heard, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
            parent = now.select(F.col("node").alias("p"), F.col("label").alias("up"))
            label = F.least("label", F.coalesce("up", "label"))
            labels = stored(near.join(parent, F.col("label") == F.col("p"), "left").select("node", label.alias("label"), (label < F.col("old")).alias("moved")))
        return keep(labels).select("node", "label")
