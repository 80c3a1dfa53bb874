"""Lookups over units, documents and blobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import sha256_hex
from ..functions.lines import decode, split_lines
from ..functions.locators import cite, label

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _AZ, _AZ.lower())


def contains(text: Column, needle: str) -> Column:
    """Substring test, A-Z case-blind; ``%`` and ``_`` in the needle are wildcards."""
    pattern = "%" + "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in needle) + "%"
    return F.like(ascii_lower(text), F.lit(pattern), F.lit("\x01"))


def with_paths(units: DataFrame, documents: DataFrame) -> DataFrame:
    """Units and the path and source of their document."""
    return units.join(documents.select(F.col("id").alias("document_id"), "path", "source_id"), "document_id")


def get_unit(units: DataFrame, documents: DataFrame, unit_id: str) -> DataFrame:
    return with_paths(units.filter(F.col("id") == unit_id), documents)


def units_of(units: DataFrame, documents: DataFrame, document_id: str) -> DataFrame:
    return with_paths(units.filter(F.col("document_id") == document_id), documents).orderBy("ordinal")


def find_units(units: DataFrame, documents: DataFrame, needle: str, limit: int = 20, index=None) -> DataFrame:
    """Units with the needle: most relevant first, then shortest; ``index``: a :class:`.substring.SubstringIndex` of them."""
    found = with_paths(units.filter(contains(F.col("text"), needle)) if index is None else index.matching(units, needle), documents)
    return found.orderBy(F.desc("relevance"), "char_count", "id").limit(limit)


def sensitive_units(units: DataFrame, documents: DataFrame, limit: int = 50) -> DataFrame:
    """Flagged units, secrets before personal data."""
    found = with_paths(units.filter(F.col("sensitivity") != "none"), documents)
    return found.orderBy(F.desc("sensitivity"), "id").limit(limit)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows) of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def unit_counts(units: DataFrame) -> DataFrame:
    return units.groupBy("document_id").agg(F.count("*").alias("units"))


def documents_by_path(documents: DataFrame) -> DataFrame:
    return documents.orderBy("path")


def sources_by_age(sources: DataFrame) -> DataFrame:
    return sources.orderBy(F.desc("last_seen"), "id")


def versions_of(versions: DataFrame, document_id: str) -> DataFrame:
    return versions.filter(F.col("document_id") == document_id).orderBy("run_seq", "seq")


def blob(blobs: DataFrame, sha: str) -> DataFrame:
    """One stored blob, from its shard alone; no row if there is none."""
    return blobs.filter((F.col("shard") == sha[:2]) & (F.col("sha256") == sha))


def verify_blobs(blobs: DataFrame) -> DataFrame:
    """(sha256, intact): the hash of the stored bytes against their name."""
    return blobs.select("sha256", (sha256_hex(F.col("content")) == F.col("sha256")).alias("intact"))


def resolve(units: DataFrame, blobs: DataFrame) -> DataFrame:
    """Adds what each unit's locator opens now: ``resolved``, ``exact``, ``note``, ``error``.

    Line and byte spans are cut from the stored bytes (a span past the end is
    an error, an end past it is cut off); other locators give the stored text.
    """
    loc, lines_ = F.col("locator"), F.col("_lines")
    joined = units.join(blobs.select(F.col("sha256").alias("blob_sha"), F.col("content").alias("_content")), "blob_sha", "left")
    joined = joined.withColumn("_lines", F.when(loc["kind"] == "lines", split_lines(decode(F.col("_content"), keep_bom=True))))
    n_bytes, kind = F.octet_length("_content"), loc["kind"]
    start, length = loc["start"].cast("int"), (loc["end"] - loc["start"]).cast("int")
    past = ((kind == "lines") & (loc["start"] > F.size(lines_))) | ((kind == "bytes") & (loc["start"] >= n_bytes))
    error = F.when(F.col("_content").isNull(), F.lit("blob not found")).when(past, F.lit("span starts past the end of the blob"))
    text = (
        F.when(kind == "lines", F.array_join(F.slice(lines_, start, length + 1), "\n"))
        .when(kind == "bytes", F.make_valid_utf8(F.substring(F.col("_content"), start + 1, length).cast("string")))
        .otherwise(F.col("text"))
    )
    exact = kind.isin("lines", "bytes")
    note = F.when(~exact, F.concat(F.lit("the exact fragment at "), label(loc), F.lit(" needs its reader; the blob is stored")))
    return (
        joined.withColumn("error", error)
        .withColumn("resolved", F.when(F.col("error").isNull(), text))
        .withColumn("exact", exact & F.col("error").isNull())
        .withColumn("note", note)
        .drop("_content", "_lines")
    )


def show(units: DataFrame, documents: DataFrame, blobs: DataFrame, unit_id: str) -> DataFrame:
    """A unit with its citation, what its locator opens and the verdict."""
    found = resolve(get_unit(units, documents, unit_id), blobs)
    verdict = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(~F.col("exact"), F.col("note"))
        .when(F.col("resolved") == F.col("text"), F.lit("identical to the bytes"))
        .when(F.col("verbatim"), F.lit("differs from the bytes"))
        .otherwise(F.lit("normalised text; the span is its source"))
    )
    return found.withColumn("cite", cite(F.col("path"), F.col("blob_sha"), F.col("locator"))).withColumn("verdict", verdict)


def verify_all(units: DataFrame, blobs: DataFrame) -> DataFrame:
    """Verbatim line units whose span no longer equals their text."""
    lines_ = units.filter("verbatim and locator.kind = 'lines'")
    return resolve(lines_, blobs).filter(~F.col("resolved").eqNullSafe(F.col("text")))
