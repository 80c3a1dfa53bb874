"""Content hashes and deterministic ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(content: Column) -> Column:
    """Full hex sha256 of a binary or string column."""
    return F.sha2(content, 256)


def digest(*parts: Column) -> Column:
    """First 32 hex digits of the sha256 of the NUL-joined parts."""
    return F.substring(F.sha2(F.concat_ws("\0", *parts), 256), 1, 32)


def source_id(connector: Column, uri: Column) -> Column:
    return digest(F.lit("source"), connector, uri)


def document_id(source: Column, path: Column) -> Column:
    return digest(F.lit("document"), source, F.translate(path, "\\", "/"))


def text_unit_id(document: Column, blob_sha: Column, locator_json: Column, ordinal: Column) -> Column:
    return digest(F.lit("unit"), document, blob_sha, locator_json, ordinal.cast("string"))
