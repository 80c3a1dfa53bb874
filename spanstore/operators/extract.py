"""Routing documents to readers and running them: one status row per document.

Native readers are column expressions; parser readers run in Arrow batches.  A
reader that fails, lacks its package or finds nothing costs only its document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media
from ..functions.lines import bind, decode
from .csvs import csv_spans
from .native import NATIVE, csv_units, text_units
from .optional import REQUIREMENTS
from .trees import TREES, Degraded, NothingFound
from .units import UNITS

CSV_ERROR = "Error: a carriage return stands inside an unquoted field"
_OOXML = "application/vnd.openxmlformats-officedocument."


@dataclass(frozen=True)
class Reader:
    """What a reader claims: media types (a trailing ``/`` claims a family) or suffixes.

    ``read(text, path)`` yields units as :mod:`.trees` makes them; a ``binary`` reader is given the bytes.
    """

    name: str
    types: tuple[str, ...]
    suffixes: tuple[str, ...]
    read: Callable | None = None
    binary: bool = False


def _reader(name: str, types: str, suffixes: str = "") -> Reader:
    return Reader(name, tuple(types.split()), tuple(suffixes.split()))


# First claim wins, so the specific stand before the catch-all.
READERS: list[Reader] = [
    _reader("notebook", "application/x-ipynb+json", ".ipynb"),
    _reader("markdown", "text/markdown text/x-rst", ".md .markdown"),
    _reader("html", "text/html", ".html .htm"),
    _reader("drawio", "application/x-drawio", ".drawio .dio"),
    _reader("svg", "image/svg+xml", ".svg"),
    _reader("mermaid", "text/x-mermaid", ".mmd .mermaid"),
    _reader("plantuml", "text/x-plantuml", ".puml .plantuml .iuml"),
    _reader("json", "application/json", ".json"),
    _reader("toml", "application/toml", ".toml"),
    _reader("csv", "text/csv text/tab-separated-values", ".csv .tsv"),
    _reader("xml", "text/xml application/xml", ".xml .xsd .xsl .pom"),
    _reader("pdf", "application/pdf", ".pdf"),
    _reader("docx", _OOXML + "wordprocessingml.document", ".docx"),
    _reader("xlsx", _OOXML + "spreadsheetml.sheet", ".xlsx .xlsm"),
    _reader("pptx", _OOXML + "presentationml.presentation", ".pptx"),
    _reader("image-ocr", "image/png image/jpeg image/gif image/webp image/bmp image/tiff", ".png .jpg .jpeg .gif .webp .bmp .tiff"),
    _reader("text", "text/ application/x-yaml application/x-sh"),
]


def register(reader: Reader, before: str = "text") -> None:
    """Adds a reader ahead of ``before``, or puts it in the place of one with its name."""
    names = [r.name for r in READERS]
    if reader.name in names:
        READERS[names.index(reader.name)] = reader
    else:
        READERS.insert(names.index(before) if before in names else len(READERS), reader)


def available(reader: Reader) -> bool:
    return reader.read is not None or reader.name not in REQUIREMENTS


def route(media_type: Column, path: Column) -> Column:
    """Name of the first reader that claims the type or the suffix, or null."""

    def first(end: Column) -> Column:
        out = F.lit(None).cast("string")
        for r in reversed(READERS):
            exact = [t for t in r.types if not t.endswith("/")]
            claim = media_type.isin(*exact) if exact else F.lit(False)
            for family in (t for t in r.types if t.endswith("/")):
                claim = claim | media_type.startswith(family)
            if r.suffixes:
                claim = claim | end.isin(*r.suffixes)
            out = F.when(claim, F.lit(r.name)).otherwise(out)
        return out

    # Bound, so that the suffix is cut once and not for each reader.
    return bind(F.lower(media.suffix(media.file_name(path))), first)


def availability(spark: SparkSession) -> DataFrame:
    """(name, available, requirement, hint) of every reader, in order."""
    rows = [(r.name, available(r), *REQUIREMENTS.get(r.name, (None, None))) for r in READERS]
    return spark.createDataFrame(rows, "name string, available boolean, requirement string, hint string")


def missing_dependencies(spark: SparkSession) -> DataFrame:
    return availability(spark).filter(~F.col("available"))


_LOCATOR_TYPE = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("number", pa.int32()), ("bbox", pa.list_(pa.float64())),
     ("sheet", pa.string()), ("ref", pa.string()), ("shape", pa.string()), ("path", pa.string()), ("line", pa.int32())]
)
_UNITS_TYPE = pa.list_(
    pa.struct([("locator", _LOCATOR_TYPE), ("text", pa.string()), ("meta", pa.map_(pa.string(), pa.string())), ("verbatim", pa.bool_())])
)


def read_one(name: str, path: str, data: bytes, extra: dict[str, Reader]) -> tuple[str, str, str, list | None]:
    """(status, reason, detail, units) of one document."""
    own = extra.get(name)
    if own is None and name in REQUIREMENTS:
        package, hint = REQUIREMENTS[name]
        return "skipped", "missing_dependency", f"no reader that uses {package} is registered: {hint}", None
    try:
        given = data if own is not None and own.binary else data.decode("utf-8", "replace").removeprefix("﻿")
        got = list((own.read if own is not None else TREES[name])(given, path))
        units = []
        for u in got:
            u["text"].encode("utf-8")  # a lone surrogate fails its document here
            meta = [(k, str(v)) for k, v in u["meta"].items() if v is not None]
            units.append({**u, "meta": meta})
        return "ok", "", "", units
    except Degraded as e:
        return "degraded", "degraded_parse", str(e), None
    except NothingFound as e:
        return "skipped", e.reason, e.detail, None
    except Exception as e:  # noqa: BLE001  a reader's fault must not end the run
        return "failed", "extractor_error", f"{type(e).__name__}: {e}", None


def _windows_with(error: Column, text: Column) -> Column:
    """Line windows of a document that does not parse."""
    meta = F.map_from_arrays(F.array(F.lit("parse_error")), F.array(error))
    return F.transform(text_units(text), lambda u: u.withField("meta", meta)).cast(UNITS)


def _csv(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """Units of CSV documents, as :func:`extract` gives them."""
    rows = docs.select(F.col(key), text.alias("_text"), csv_spans(text, F.col("path")).alias("_s"))
    detail = F.when(F.col("_s.bad"), CSV_ERROR).otherwise("")
    status = F.when(F.col("_s.bad"), "degraded").otherwise("ok")
    units = F.when(F.col("_s.bad"), _windows_with(F.lit(CSV_ERROR), F.col("_text"))).otherwise(csv_units(F.col("_text"), F.col("_s")))
    reason = F.when(F.col("_s.bad"), "degraded_parse").otherwise("")
    return rows.select(key, status.alias("status"), reason.alias("reason"), detail.alias("detail"), units.alias("units"))


def extract(docs: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, status, reason, detail, units) for docs (key, extractor, path, content).

    status: ok, degraded (line windows that carry ``parse_error``), skipped, failed.
    """
    extra = {r.name: r for r in READERS if r.read is not None}
    text = decode(F.col("content"))
    units = F.lit(None).cast(UNITS)
    for name, build in NATIVE.items():
        units = F.when(F.col("extractor") == name, build(text)).otherwise(units)
    columns = [n for n in NATIVE if n not in extra]
    native = docs.filter(F.col("extractor").isin(*columns)).select(
        key, F.lit("ok").alias("status"), F.lit("").alias("reason"), F.lit("").alias("detail"), units.alias("units")
    )
    if "csv" not in extra:
        native = native.unionByName(_csv(docs.filter(F.col("extractor") == "csv"), key, text))
        columns.append("csv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            args = (batch[c].to_pylist() for c in ("extractor", "path", "content"))
            got = [read_one(n, p, bytes(d), extra) for n, p, d in zip(*args)]
            # Only a degraded document needs its bytes again.
            again = [d if g[0] == "degraded" else None for g, d in zip(got, batch["content"].to_pylist())]
            columns = [batch["key"], *(pa.array([g[i] for g in got], pa.string()) for i in range(3))]
            columns += [pa.array([g[3] for g in got], _UNITS_TYPE), pa.array(again, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "status", "reason", "detail", "units", "content"])

    kind = docs.schema[key].dataType.simpleString()
    parsed = docs.filter(F.col("extractor").isNotNull() & ~F.col("extractor").isin(*columns)).select(
        F.col(key).alias("key"), "extractor", "path", "content"
    )
    schema = f"key {kind}, status string, reason string, detail string, units {UNITS}, content binary"
    parsed = parsed.mapInArrow(run, schema).select(
        F.col("key").alias(key), "status", "reason", "detail",
        F.when(F.col("status") == "degraded", _windows_with(F.col("detail"), text)).otherwise(F.col("units")).alias("units"),
    )
    return native.unionByName(parsed)


@contextmanager
def small_batches(spark: SparkSession):
    """A block with small Arrow batches: a row may hold a 25 MiB file."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, min(64, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


__all__ = ["READERS", "Reader", "availability", "extract", "missing_dependencies", "read_one", "register", "route", "small_batches"]
