"""Helpers shared by the operators: reading, durable tables, let-binding."""

from __future__ import annotations

import math
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space of every contract: space and U+0009..U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.  Only a local session may do without one: it has one machine's disk."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.sparkContext.setCheckpointDir(named)
    return named


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open = threading.local()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably: a lost executor rereads the files instead of
    recomputing the work, and later branches share one result.  Spark drops the
    shuffle files of the write as it ends; the table itself goes with the
    :func:`scratch` block it was made in.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    for tables in getattr(_open, "scopes", [])[-1:]:
        tables.append(path)
    return out


@contextmanager
def scratch(spark: SparkSession):
    """A block whose stored tables are deleted at its end, but for what is passed to the function it gives."""
    scopes = _open.scopes = getattr(_open, "scopes", [])
    mine: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        mine.remove(df._stored_at)
        for outer in scopes[-2:-1]:
            outer.append(df._stored_at)
        return df

    scopes.append(mine)
    try:
        yield keep
    finally:
        scopes.pop()
        for path in mine:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated exactly once.

    The optimizer may inline a projected column into each place that uses it,
    also inside lambdas, where it would be evaluated per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(df: DataFrame, *keep: str) -> DataFrame:
    """``doc``, a struct of all of ``df``'s columns, and the columns in ``keep``: whatever else
    the table holds cannot clash with an operator's own names."""
    return df.select(F.struct("*").alias("doc"), *keep)


def unpacked(names: list[str], **fresh: Column) -> list[Column]:
    """The columns ``names`` of ``doc`` again, some of them ``fresh``."""
    return [fresh.get(c, F.col("doc").getField(c)).alias(c) for c in names]


FILTER_BITS = 1 << 24


def maybe_among(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose long ``key`` may be in ``ids`` (one column); a join must follow.

    A one-hash filter of ``FILTER_BITS`` bits, kept as at most a quarter million
    64-bit words, is what gets broadcast at any input size; with very many ids
    it only lets more rows through.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bit = lambda p: F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))
    words = (
        ids.select(place(ids[ids.columns[0]]).alias("_p"))
        .groupBy(F.floor(F.col("_p") / 64).cast("int").alias("_word"))
        .agg(F.bit_or(bit(F.col("_p"))).alias("_bits"))
    )
    marked = df.withColumn("_at", place(F.col(key))).withColumn("_word", F.floor(F.col("_at") / 64).cast("int"))
    hit = F.col("_bits").bitwiseAND(bit(F.col("_at"))) != 0
    return marked.join(F.broadcast(words), "_word").filter(hit).select(*df.columns)


HOT_KEYS = 1000


def join_skewed(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, anti: bool = False) -> DataFrame:
    """``rows`` joined with ``facts`` (unique ``keys``), or without those that ``facts`` has.

    ``count`` is a column of ``facts``: how many rows have the key.  Keys with more than a share of
    1 / HOT_KEYS of these rows are joined by broadcast, and there are fewer than HOT_KEYS of them; no
    other key weighs enough to hold up a task.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_KEYS > total
    hot, cold = facts.filter(is_hot), facts.filter(~is_hot)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    if anti:
        return rest.join(cold.select(*keys), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys))


def words_of(text: Column) -> Column:
    """Maximal runs of characters outside ASCII white space; null gives none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return let(
        trimmed,
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE)),
    )


def n_words(text: Column) -> Column:
    """Number of words as :func:`words_of` cuts them."""
    return F.size(words_of(text)).cast("long")


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of a partition sorted by ``key``, cut so that no key goes on in the next one."""
    held: list[pa.RecordBatch] = []

    def joined() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            held.append(batch.slice(0, cut))
            yield joined()
            held = []
        elif held and held[-1][key][-1].as_py() != keys[0]:
            yield joined()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield joined()


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Indices where any of the sorted columns changes, and the length at the end."""
    new = np.ones(len(columns[0]) + 1, bool)
    if len(columns[0]):
        new[1:-1] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new) if len(columns[0]) else np.zeros(1, np.int64)


def groups_for(rows: int, per_group: int) -> int:
    """How many groups keep each near ``per_group`` rows."""
    return max(1, math.ceil(rows / per_group))
