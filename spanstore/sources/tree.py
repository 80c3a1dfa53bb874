"""Directory trees as a Spark data source, batch and streaming, and the reader that fetches bytes.

``spark.read.format("tree").option("path", root)`` lists every file of a tree,
also hidden and empty ones, and every directory that is not entered.  The upper
folders are partitions of their own, also those inside one big folder.  Rows carry metadata only; bytes are read
in a second step, after the size gates.

Conditions on kind, size and path that are named when the tree is opened (:func:`read_tree`) are pushed into the
walk as filters: what they leave out is not listed, and folders that cannot hold a
wanted path are not opened.  Filters added later stay with Spark, since all scans of one DataFrame share what
its source has taken in.

``spark.readStream.format("tree")`` gives the files that are new or changed since the last
micro-batch.  Its offset names a listing (path, size, time of change) in the folder of option
``listings``; a batch is the difference of two listings.  The listing is made by one process on the
driver, which bounds a streamed tree to what that can walk between two batches.
"""

from __future__ import annotations

import hashlib
import json
import operator
import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from ..functions.fixed import SKIP_DIRS

PARTITIONS = 128
FILES_A_TASK = 1024
ENTRY = "entry_kind string, seq string, path string, size bigint, origin string, revision string, media_type string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Conditions that a walk can decide: what they are called, and as which filter Spark offers them.
CONDITIONS = {"=": EqualTo, ">": GreaterThan, ">=": GreaterThanOrEqual, "<": LessThan, "<=": LessThanOrEqual, "startswith": StringStartsWith}
Condition = tuple[str, str, str | int]


def _size(path: str) -> int:
    try:
        return os.stat(path).st_size
    except OSError:
        return 0  # an unreadable file is met again, and skipped, as empty


def _listed(folder: str) -> list[os.DirEntry]:
    """Entries in name order; an unreadable folder has none."""
    try:
        with os.scandir(folder) as it:
            return sorted(it, key=lambda e: e.name)
    except OSError:
        return []


def _entered(e: os.DirEntry) -> bool:
    return e.is_dir() and not e.is_symlink() and e.name not in SKIP_DIRS


@dataclass
class Wanted:
    """What conditions leave of a tree."""

    conditions: list[Condition] = field(default_factory=list)

    def fits(self, column: str, value: str | int) -> bool:
        return all(_HOLDS[op](value, x) for c, op, x in self.conditions if c == column)

    def below_folder(self, folder: str) -> bool:
        """Whether a wanted path can stand below ``folder``."""
        inside = folder + "/"
        return all(x.startswith(inside) or (op == "startswith" and inside.startswith(x)) for c, op, x in self.conditions if c == "path" and op in ("=", "startswith"))


_HOLDS = {"=": operator.eq, ">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le, "startswith": str.startswith}


def _walk(root: str, folder: str, deep: bool, wanted: Wanted) -> Iterator[tuple]:
    """Rows of one folder (relative, empty for the root), and of all below if ``deep``:
    pruned directories, then files, then subdirectories, each in name order.

    seq sorts as a walk from the root runs: one component per level, rank before name.
    """
    prefix = folder + "/" if folder else ""
    order = "".join(f"2{name}\1" for name in folder.split("/") if name)
    entries = _listed(os.path.join(root, folder))
    for e in entries:
        path = prefix + e.name
        if e.is_dir() and e.name in SKIP_DIRS:
            if wanted.fits("entry_kind", "pruned") and wanted.fits("path", path) and wanted.fits("size", 0):
                yield "pruned", f"{order}0{e.name}\1", path, 0, e.path
        elif not e.is_dir() and wanted.fits("entry_kind", "file") and wanted.fits("path", path):
            size = _size(e.path)
            if wanted.fits("size", size):
                yield "file", f"{order}1{e.name}\1", path, size, e.path
    if deep:
        for e in entries:
            if _entered(e) and wanted.below_folder(prefix + e.name):
                yield from _walk(root, prefix + e.name, True, wanted)


class _Folder(InputPartition):
    def __init__(self, folder: str, deep: bool):
        self.folder, self.deep = folder, deep


class _TreeReader(DataSourceReader):
    def __init__(self, root: str, revision: str, conditions: list[Condition]):
        self.root, self.revision, self.named = root, revision, conditions
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes the named conditions, gives back what Spark has to evaluate itself."""
        for f in filters:
            for column, op, value in self.named:
                if type(f) is CONDITIONS[op] and f.attribute == (column,) and f.value == value:
                    self.wanted.conditions.append((column, op, value))
                    break
            else:
                if not (isinstance(f, IsNotNull) and f.attribute in (("entry_kind",), ("path",), ("size",))):  # these never are
                    yield f

    def partitions(self) -> list[InputPartition]:
        """Folders level by level, each its own files, until there are ``PARTITIONS``; those then left, with all below."""
        parts, level = [], [""]
        while level and len(parts) + len(level) < PARTITIONS:
            parts += [_Folder(folder, False) for folder in level]
            names = (os.path.join(folder, e.name) for folder in level for e in _listed(os.path.join(self.root, folder)) if _entered(e))
            level = [folder for folder in names if self.wanted.below_folder(folder)]
        return [*parts, *(_Folder(folder, True) for folder in level)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for kind, seq, path, size, origin in _walk(self.root, partition.folder, partition.deep, self.wanted):
            yield kind, seq, path, size, origin, self.revision, None


class _Changed(InputPartition):
    def __init__(self, rows: list[list]):
        self.rows = rows


class _TreeStreamReader(DataSourceStreamReader):
    """Listings are files ``<number>-<digest>.json`` of [path, seq, size, time of change]; the name is the offset."""

    def __init__(self, root: str, revision: str, listings: str):
        self.root, self.revision, self.listings = root, revision, listings

    def _known(self) -> list[str]:
        return sorted(n for n in os.listdir(self.listings) if n.endswith(".json")) if os.path.isdir(self.listings) else []

    def _listing(self, name: str) -> list[list]:
        if not name:
            return []
        with open(os.path.join(self.listings, name)) as f:
            return json.load(f)

    def initialOffset(self) -> dict:
        return {"listing": ""}

    def latestOffset(self) -> dict:
        """The last listing again if nothing has changed since, else a new one."""
        rows = []
        for _, seq, path, size, origin in _walk(self.root, "", True, Wanted([("entry_kind", "=", "file")])):
            try:
                changed = os.stat(origin).st_mtime_ns
            except OSError:
                changed = 0
            rows.append([path, seq, size, changed])
        text = json.dumps(rows)
        digest = hashlib.sha256(text.encode()).hexdigest()[:16]
        known = self._known()
        if known and known[-1].endswith(f"-{digest}.json"):
            return {"listing": known[-1]}
        name = f"{int(known[-1].split('-')[0]) + 1 if known else 1:012d}-{digest}.json"
        os.makedirs(self.listings, exist_ok=True)
        hidden = os.path.join(self.listings, f".{name}")
        with open(hidden, "w") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(hidden, os.path.join(self.listings, name))
        return {"listing": name}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Files whose size or time differs from the earlier listing, or that it lacks; a file that is gone gives no row."""
        before = {path: (size, changed) for path, _, size, changed in self._listing(start["listing"])}
        rows = [r for r in self._listing(end["listing"]) if before.get(r[0]) != (r[2], r[3])]
        return [_Changed(rows[i : i + FILES_A_TASK]) for i in range(0, len(rows), FILES_A_TASK)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for path, seq, size, _ in partition.rows:
            yield "file", seq, path, size, os.path.join(self.root, path), self.revision, None

    def commit(self, end: dict) -> None:
        """Earlier listings are needed no more."""
        for name in self._known():
            if name < end["listing"]:
                os.unlink(os.path.join(self.listings, name))


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tree"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema) -> DataSourceReader:
        named = [tuple(c) for c in json.loads(self.options.get("where", "[]"))]
        return _TreeReader(self.options["path"], self.options.get("revision", ""), named)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TreeStreamReader(self.options["path"], self.options.get("revision", ""), self.options["listings"])


def read_tree(spark: SparkSession, root: str, revision: str = "", where: list[Condition] | None = None) -> DataFrame:
    """Entries of a tree, of those that meet all conditions in ``where`` (column, one of ``CONDITIONS``, value).

    Turns the session's pushdown into Python sources on, which Spark leaves off by default.
    """
    spark.dataSource.register(TreeSource)
    spark.conf.set(PUSHDOWN, "true")
    out = spark.read.format("tree").option("path", root).option("revision", revision).option("where", json.dumps(where or [])).load()
    for column, op, value in where or []:
        out = out.filter(F.col(column).startswith(value) if op == "startswith" else _HOLDS[op](F.col(column), value))
    return out


def read_tree_changes(spark: SparkSession, root: str, listings: str, revision: str = "") -> DataFrame:
    """A stream of the files of a tree as they appear and change; ``listings``: a folder that outlives the query."""
    spark.dataSource.register(TreeSource)
    return spark.readStream.format("tree").option("path", root).option("revision", revision).option("listings", listings).load()


def fetch(entries: DataFrame) -> DataFrame:
    """Adds ``content`` and ``read_error`` by opening each row's ``origin``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, origin in enumerate(batch["origin"].to_pylist()):
                content = error = None
                try:
                    with open(origin, "rb") as f:
                        content = f.read()
                except OSError as e:
                    error = str(e)
                row = batch.slice(i, 1)
                columns = [*row.columns, pa.array([content], pa.binary()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*row.schema.names, "content", "read_error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in entries.schema)
    return entries.mapInArrow(run, f"{fields}, content binary, read_error string")


def with_content(entries: DataFrame) -> DataFrame:
    """Entries whose bytes are already a column, shaped like :func:`fetch`'s rows; a ``read_error`` of their own stays."""
    return entries if "read_error" in entries.columns else entries.withColumn("read_error", F.lit(None).cast("string"))
