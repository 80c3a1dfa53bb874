"""Stable sharding by jump consistent hashing (Lamping and Veach, 2014).

A key and the number of shards decide the shard; there is no ring table.  When
a shard is appended, only the rows that move into it change place.

Edge cases: a null key counts as key 0; a null text has size 8 and the CRC of
the empty string; repeated rows get slots of their own; a very long text is reduced to
its size and CRC where it is read; an empty table gives an empty result.  Extra columns
of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

N_SHARDS = 24
SLOT_BUCKETS = 1024


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each 64-bit key; vectorised over keys still jumping."""
    state = keys.astype(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    jump = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = jump[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[live] = ((shard[live] + 1).astype(np.float64) * step).astype(np.int64)
        live = live[jump[live] < n_shards]
    return shard.astype(np.int32)


def shard_of(key: Column, n_shards: int) -> Column:
    """Shard of a long key.  Keys are hashed first, so runs of ids spread evenly."""

    @F.pandas_udf("int")
    def run(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy(np.int64).view(np.uint64), n_shards))

    return run(F.xxhash64(F.coalesce(key, F.lit(0).cast("long"))))


def with_slots(df: DataFrame, order: list[str], buckets: int = SLOT_BUCKETS) -> DataFrame:
    """Adds ``slot``: the row's place in its ``shard``, gapless from 0.

    Rows are numbered inside ``buckets`` parts of each shard and shifted by the
    sizes of the parts before, so no task ever holds a whole shard.  The
    broadcast table has at most shards times buckets rows.
    """
    parts = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = parts.groupBy("shard", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = parts.withColumn("_rank", F.row_number().over(Window.partitionBy("shard", "_part").orderBy(*order)))
    return (
        ranked.join(F.broadcast(starts), ["shard", "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_rank") - 1).cast("long"))
        .drop("_part", "_start", "_rank")
    )


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """Assigns every document to a shard and a slot.

    Only narrow rows move: the text is reduced to its size and CRC in the scan.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id").cast("long"), n_shards).alias("shard"),
        shard_of(F.col("doc_id").cast("long"), n_shards + 1).alias("grown_shard"),
    )
    return with_slots(stored(narrow), ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return shard_documents(table(spark, sf_dir, "documents"))
