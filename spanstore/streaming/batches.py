"""Ingestion of a stream of items, one atomic run per micro-batch.

The engine's own increments (unchanged items are not extracted again) make a
replayed batch harmless: it changes nothing but ``last_seen`` and the ledger.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import ingest_entries
from ..plans.store import Store
from ..sources.tree import read_tree_changes


def as_entries(items: DataFrame) -> DataFrame:
    """Entries of items (path, content)."""
    return items.select(
        F.lit("file").alias("entry_kind"), F.col("path").alias("seq"), "path", F.octet_length("content").cast("long").alias("size"),
        F.col("path").alias("origin"), F.lit("").alias("revision"), F.lit(None).cast("string").alias("media_type"), "content",
    )


def ingest_stream(items: DataFrame, store: Store, uri: str, checkpoint: str, connector: str = "stream") -> StreamingQuery:
    """Starts ingestion of a streaming DataFrame of (path string, content binary)."""

    def batch(df: DataFrame, _: int) -> None:
        # One item a path: the greatest content, so that a replay chooses alike.
        last = df.groupBy("path").agg(F.max("content").alias("content"))
        if not last.isEmpty():
            ingest_entries(df.sparkSession, as_entries(last), store, connector, uri, uri, has_content=True)

    return items.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_tree_stream(spark: SparkSession, root: str, store: Store, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Starts ingestion of a tree's files as they appear and change: a batch opens only what differs from the last listing.

    ``interval``, such as "10 seconds", keeps the query running; without it the query ends when it has caught up.
    Deleted files leave their documents as they are, as in a batch run.
    """
    root = os.path.realpath(root)
    changes = read_tree_changes(spark, root, os.path.join(checkpoint, "listings"))

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            ingest_entries(df.sparkSession, df, store, "filesystem", root, os.path.basename(root))

    out = changes.writeStream.foreachBatch(batch).option("checkpointLocation", os.path.join(checkpoint, "query"))
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()
