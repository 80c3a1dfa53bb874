"""Snapshot tables with one atomic commit a run.

Every commit writes what it changes to new directories and then moves one pointer
file; readers see all of a run or nothing.  ``blobs``, ``document_versions``,
``ingest_events`` and ``ingest_runs`` only grow: a commit adds a directory to their
list.  ``sources``, ``documents`` and ``text_units`` lie in hash buckets, and a commit
replaces the buckets it touches, so one edited file rewrites a small part of them.
Buckets grow in number with their table by linear hashing: a new one takes the rows
of one old one, which is split when a commit rewrites it anyway, or as one more for
each that it touches.  Large buckets are written by several tasks.
What a commit adds is checked before the pointer moves.  A lock file keeps writers
apart; it names its owner and can be broken when that one is gone.

The root is a folder that the driver and the executors share as a file system.
"""

from __future__ import annotations

import functools
import json
import math
import os
import shutil
import socket
import tempfile
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.locators import LOCATOR
from ..sources.sink import BlobSink

SCHEMAS = {
    "blobs": "sha256 string, size bigint, media_type string, first_seen string, shard string, content binary",
    "sources": "id string, connector string, uri string, label string, revision string, first_seen string, last_seen string",
    "documents": "id string, source_id string, path string, blob_sha string, media_type string, size bigint, relevance int, first_seen string, last_seen string",
    "document_versions": "document_id string, blob_sha string, revision string, seen_utc string, run_seq bigint, seq string",
    "text_units": f"id string, document_id string, blob_sha string, locator {LOCATOR}, locator_json string, ordinal int, text string, "
    "char_count int, verbatim boolean, extractor string, relevance int, sensitivity string, sensitivity_labels array<string>, "
    "meta map<string,string>, created_utc string",
    "ingest_runs": "id string, run_seq bigint, connector string, target string, source_id string, started_utc string, finished_utc string, status string, counters map<string,bigint>",
    "ingest_events": "run_id string, seq string, path string, document_id string, blob_sha string, media_type string, size bigint, outcome string, "
    "reason string, detail string, extractor string, units int, recorded_utc string",
}
GROWING = ("blobs", "document_versions", "ingest_events", "ingest_runs")
# The other tables by the key that decides a row's bucket.
BUCKETED = {"sources": "id", "documents": "id", "text_units": "document_id"}
# How many there are at first, how large they should become, and how much of a commit goes to one task.
BUCKETS = 64
BUCKET_BYTES = 4 << 30
TASK_BYTES = 256 << 20
# Rough bytes of a row, where rows are counted before they are written.
ROW_BYTES = {"sources": 256, "documents": 256}
# Units are also looked up by id, which says nothing of their bucket: small row groups with a Bloom filter each.
BLOOM = {
    "text_units": {
        "parquet.bloom.filter.enabled#id": "true", "parquet.bloom.filter.expected.ndv#id": "20000", "parquet.block.size": str(16 << 20),
        "parquet.page.row.count.limit": "2000",
    }
}

# Constraints of what a commit adds: keys, references, and conditions that no row may meet.
KEYS = {
    "blobs": ["sha256"], "sources": ["id"], "documents": ["id"], "document_versions": ["document_id", "blob_sha"],
    "text_units": ["id"], "ingest_runs": ["id"],
}
REFERENCES = [
    ("documents", "source_id", "sources", "id"), ("documents", "blob_sha", "blobs", "sha256"),
    ("document_versions", "document_id", "documents", "id"), ("document_versions", "blob_sha", "blobs", "sha256"),
    ("text_units", "document_id", "documents", "id"), ("text_units", "blob_sha", "blobs", "sha256"),
    ("ingest_events", "run_id", "ingest_runs", "id"), ("ingest_runs", "source_id", "sources", "id"),
]
FORBIDDEN = {
    "blobs": "sha256 is null or length(sha256) <> 64 or size is null",
    "sources": "connector is null or uri is null",
    "documents": "path is null or blob_sha is null or source_id is null or relevance not between 0 and 3",
    "document_versions": "document_id is null or blob_sha is null",
    "text_units": "char_count <= 0 or blob_sha is null or locator_json is null or document_id is null or sensitivity not in ('none', 'pii', 'secret')",
    "ingest_events": "run_id is null or path is null or outcome is null or outcome not in ('extracted', 'unchanged', 'skipped', 'failed')",
    "ingest_runs": "status is null",
}


def bucket_of(key: Column, width: int) -> Column:
    """The bucket of a key among ``width``: buckets split already, and those split off, go by one bit more than the others."""
    high = 1 << (width - 1).bit_length()
    hashed = F.xxhash64(key)
    fine = F.pmod(hashed, F.lit(high))
    return F.when(fine < width, fine).otherwise(F.pmod(hashed, F.lit(max(high // 2, 1)))).cast("int")


def origin(bucket: int, width: int) -> int:
    """The bucket among ``width`` that holds the rows of what will be ``bucket`` among more."""
    while bucket >= width:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


class Rewrite(NamedTuple):
    """Buckets of a table that a commit replaces, how many buckets there are then, and about how many bytes the commit writes."""

    buckets: set[int]
    width: int
    load: int = 0


class StoreError(Exception):
    """A commit that would break a constraint, or a busy store."""


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and the executors share, below the one the cluster names for checkpoints."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise StoreError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    scheme, colon, rest = (named or "").partition(":")
    if colon and scheme != "file":
        raise StoreError(f"{named}: the store needs a folder that driver and executors share as a file system, not a {scheme} address")
    root = "/" + (rest if colon else named).lstrip("/") if named else tempfile.mkdtemp(prefix="spark-store-")
    return os.path.join(root, f"store-{uuid.uuid4().hex}")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        os.makedirs(root, exist_ok=True)
        self.pointer = os.path.join(root, "CURRENT")

    def state(self) -> dict[str, dict]:
        """The committed snapshot: directories and number of buckets of each table, bytes of each directory of a bucket."""
        try:
            with open(self.pointer) as f:
                state = json.load(f)
        except FileNotFoundError:
            state = {}
        # A pointer written before buckets grew holds the directories alone.
        return state if "parts" in state else {"parts": state, "width": {}, "bytes": {}}

    def parts(self) -> dict[str, list[str]]:
        """Directories of each table in the committed snapshot."""
        return self.state()["parts"]

    def width(self, name: str) -> int:
        """How many buckets a table has."""
        return self.state()["width"].get(name, BUCKETS)

    def table(self, name: str, buckets: set[int] | None = None) -> DataFrame:
        """A table, or of a bucketed one only some buckets."""
        paths = self.parts().get(name, [])
        if buckets is not None:
            paths = [p for p in paths if _bucket(p) in buckets]
        return self._read(name, paths)

    def touched(self, name: str, keys: DataFrame) -> dict[int, int]:
        """Buckets of a table that hold or will hold ``keys`` (one column), and how many of the keys; at most a row a bucket is gathered."""
        return dict(keys.groupBy(bucket_of(F.col(keys.columns[0]), self.width(name)).alias("b")).count().collect())

    def rewrite(self, name: str, touched: dict[int, int], coming: int | None = None) -> Rewrite:
        """What a commit replaces that touches these buckets: them, and those whose turn it is to be split.

        coming: bytes that the commit adds; if it isn't given, they are told from the number of keys.
        A table without rows takes any number of buckets at once.  Later a bucket is split that is
        touched anyway, or for each touched one another that is not: so what an edit rewrites stays
        in proportion to the edit, whatever the table's size.
        """
        state = self.state()
        width, held = state["width"].get(name, BUCKETS), {}
        for p in state["parts"].get(name, []):
            held[_bucket(p)] = held.get(_bucket(p), 0) + state["bytes"].get(p, 0)
        coming = sum(touched.values()) * ROW_BYTES.get(name, 0) if coming is None else coming
        wanted = max(width, math.ceil((sum(held.values()) + coming) / BUCKET_BYTES))
        buckets, grown, more = set(touched), width, len(touched)
        while grown < wanted and held:
            parent = origin(grown, width)
            if parent not in buckets:
                if not more:
                    break
                more -= 1
                buckets.add(parent)
            grown += 1
        grown = grown if held else wanted
        # The keys were dealt to the old buckets; rows go to what these become.
        after = {b for b in range(width, grown) if origin(b, width) in buckets} | buckets
        return Rewrite(after, grown, sum(held.get(b, 0) for b in buckets) + coming)

    def staging(self, run: str, part: str) -> str:
        """Where a run keeps rows that it reads several times, until it is committed."""
        return os.path.join(self.root, "staging", run, part)

    def drop_staging(self, run: str) -> None:
        shutil.rmtree(os.path.join(self.root, "staging", run), ignore_errors=True)

    def of_unit(self, unit_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The unit, its document and its blob, each from the one bucket or shard that holds it.

        The first step finds the unit's document: row groups whose Bloom filter doesn't know the id
        are not read.  The others are read where the document and the hash say.
        """
        where = self.table("text_units").filter(F.col("id") == unit_id).select("document_id", "blob_sha").head()
        if where is None:
            return tuple(self.table(n, set()) if n in BUCKETED else self._read(n, []) for n in ("text_units", "documents", "blobs"))
        key = self.spark.range(1).select(F.lit(where["document_id"]).alias("id"))
        units = self.table("text_units", set(self.touched("text_units", key)))
        units = units.filter((F.col("document_id") == where["document_id"]) & (F.col("id") == unit_id))
        documents = self.table("documents", set(self.touched("documents", key))).filter(F.col("id") == where["document_id"])
        sha = where["blob_sha"]
        return units, documents, self.table("blobs").filter((F.col("shard") == sha[:2]) & (F.col("sha256") == sha))

    @contextmanager
    def writing(self):
        """Holds the store's lock."""
        lock = os.path.join(self.root, "LOCK")
        try:
            fd = os.open(lock, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError as e:
            raise StoreError(f"another run holds {lock}: {self.lock_owner()}; if it is gone, Store.break_lock() frees the store") from e
        with os.fdopen(fd, "w") as f:
            json.dump({"host": socket.gethostname(), "pid": os.getpid(), "since": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}, f)
        try:
            yield
        finally:
            self.break_lock()

    def lock_owner(self) -> dict:
        """Who holds the lock and since when; empty if nobody does."""
        try:
            with open(os.path.join(self.root, "LOCK")) as f:
                return json.load(f)
        except FileNotFoundError:
            return {}
        except ValueError:
            return {"host": "unknown"}

    def break_lock(self) -> None:
        """Frees the store.  Rows of a run that died are in no snapshot, so nothing else needs mending."""
        try:
            os.unlink(os.path.join(self.root, "LOCK"))
        except FileNotFoundError:
            pass

    def commit(self, changes: dict[str, DataFrame | Callable[[], DataFrame]], rewrites: dict[str, Rewrite] | None = None) -> None:
        """Writes all changes, checks them, then moves the pointer.

        A growing table's change is the rows to add.  A bucketed one's is all rows of the
        buckets named for it in ``rewrites`` (of all of them, if it isn't named there).  A function
        is called when the changes before it are written.
        """
        state, batch = self.state(), uuid.uuid4().hex[:12]
        parts, width, sizes = state["parts"], state["width"], state["bytes"]
        fresh: dict[str, list[str]] = {}
        for name, df in changes.items():
            where = os.path.join(name, f"batch={batch}")
            rows = (df() if callable(df) else df).select(*_columns(self.spark, name))
            if name in BUCKETED:
                at = width.get(name, BUCKETS)
                plan = (rewrites or {}).get(name) or Rewrite(set(range(at)), at)
                key = F.col(BUCKETED[name])
                rows = rows.withColumn("bucket", bucket_of(key, plan.width))
                tasks, slices = (max(1, math.ceil(plan.load / n / TASK_BYTES)) for n in (1, max(len(plan.buckets), 1)))
                if tasks <= int(self.spark.conf.get("spark.sql.shuffle.partitions")) and slices == 1:
                    rows = rows.repartition("bucket")
                else:
                    rows = rows.repartition(tasks, "bucket", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(slices)))
            # Blobs lie by the first two digits of their hash, so a lookup reads one shard.
            if name == "blobs":
                self.spark.dataSource.register(BlobSink)
                rows.sortWithinPartitions("shard").write.format("blobs").option("path", os.path.join(self.root, where)).mode("append").save()
            else:
                out = rows.write.partitionBy(*(["bucket"] if name in BUCKETED else []))
                for option, value in BLOOM.get(name, {}).items():
                    out = out.option(option, value)
                out.parquet(os.path.join(self.root, where))
            fresh[name] = [where]
            if name in BUCKETED:
                made = sorted(d for d in os.listdir(os.path.join(self.root, where)) if d.startswith("bucket="))
                fresh[name] = [os.path.join(where, d) for d in made]
                if any(_bucket(p) not in plan.buckets for p in fresh[name]):
                    raise StoreError(f"{name}: rows outside of the buckets to be replaced")
                for p in parts.get(name, []):
                    if _bucket(p) in plan.buckets:
                        sizes.pop(p, None)
                parts[name] = [p for p in parts.get(name, []) if _bucket(p) not in plan.buckets]
                width[name] = plan.width
                sizes |= {p: bytes_below(os.path.join(self.root, p)) for p in fresh[name]}
            parts[name] = [*parts.get(name, []), *fresh[name]]
        self._check(fresh, parts)
        pointer = f"{self.pointer}.{batch}"
        with open(pointer, "w") as f:
            json.dump(state, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(pointer, self.pointer)

    def _read(self, name: str, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[name])
        rows = self.spark.read.schema(SCHEMAS[name])
        if name == "blobs":  # the shard is in the path
            rows = rows.option("basePath", os.path.join(self.root, name))
        return rows.parquet(*[os.path.join(self.root, p) for p in paths]).select(*_columns(self.spark, name))

    def _check(self, fresh: dict[str, list[str]], parts: dict[str, list[str]]) -> None:
        """Looks at what the commit adds, in one job; of other tables only the columns that are referred to."""
        added = {n: self._read(n, p) for n, p in fresh.items() if p}
        whole = {n: self._read(n, p) for n, p in parts.items()}
        found = []

        def broken(rows: DataFrame, what: str) -> None:
            found.append(rows.limit(1).select(F.lit(what).alias("what")))

        for name, rows in added.items():
            key = KEYS.get(name)
            if key:
                # A bucket is written whole; what a growing table holds already can clash with what is added.
                known = whole[name].select(*key) if name in GROWING else rows.select(*key)
                near = known.join(rows.select(*key).distinct(), key, "left_semi") if name in GROWING else known
                broken(near.groupBy(*key).count().filter("count > 1"), f"{name}: {', '.join(key)} is not unique")
            broken(rows.filter(FORBIDDEN[name]), f"{name}: not allowed: {FORBIDDEN[name]}")
        for child, column, parent, key in REFERENCES:
            if child in added:
                there = whole[parent].select(F.col(key).alias("_k")) if parent in whole else self._read(parent, []).select(F.col(key).alias("_k"))
                asked = added[child].filter(F.col(column).isNotNull()).select(column).distinct()
                broken(asked.join(there, F.col(column) == F.col("_k"), "left_anti"), f"{child}: {column} is in no row of {parent}")
        wrong = [r["what"] for r in functools.reduce(DataFrame.unionByName, found).collect()] if found else []
        if wrong:
            raise StoreError("; ".join(wrong))


def _columns(spark: SparkSession, name: str) -> list[str]:
    return spark.createDataFrame([], SCHEMAS[name]).columns


def _bucket(path: str) -> int:
    return int(path.rsplit("bucket=", 1)[1])


def bytes_below(folder: str) -> int:
    """Bytes of the files of a folder."""
    with os.scandir(folder) as found:
        return sum(e.stat().st_size for e in found if e.is_file())


# Merges: set-based forms of insert-or-update.  All take and give plain rows.


def new_blobs(found: DataFrame, known: DataFrame) -> DataFrame:
    """Blobs not yet stored, once each; inside a run the first entry in walk order gives the media type.

    found: (sha256, size, media_type, first_seen, seq).  Content is joined on afterwards, so the
    choice shuffles no bytes.
    """
    first = found.groupBy("sha256").agg(
        F.min(F.struct("seq", "size", "media_type", "first_seen", "path")).alias("f")
    )
    return first.select("sha256", "f.size", "f.media_type", "f.first_seen", F.col("f.path").alias("from_path")).join(
        known.select("sha256"), "sha256", "left_anti"
    )


def merge_rows(old: DataFrame, new: DataFrame, key: str = "id", keep: tuple[str, ...] = ("first_seen",)) -> DataFrame:
    """Old rows updated by new ones with the same key; columns in ``keep`` stay as they were."""
    columns = old.columns
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in columns])
    both = old.join(n, F.col(key) == F.col(f"n_{key}"), "full_outer")
    pick = lambda c: F.coalesce(c, f"n_{c}") if c in (key, *keep) else F.when(F.col(f"n_{key}").isNotNull(), F.col(f"n_{c}")).otherwise(F.col(c))
    return both.select(*[pick(c).alias(c) for c in columns])


def new_versions(found: DataFrame, known: DataFrame) -> DataFrame:
    """(document, blob) pairs never seen before."""
    return found.join(known.select("document_id", "blob_sha"), ["document_id", "blob_sha"], "left_anti")


def replace_units(old: DataFrame, touched: DataFrame, new: DataFrame) -> DataFrame:
    """Units of touched documents (document_id) give way to the new ones."""
    return old.join(touched.select("document_id").distinct(), "document_id", "left_anti").unionByName(new)
