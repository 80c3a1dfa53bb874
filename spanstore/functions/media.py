"""Media types from names and first bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def lookup(key: Column, table: dict[str, str]) -> Column:
    """``table[key]`` or null, as one map literal."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def file_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.regexp_extract(F.translate(path, "\\", "/"), r"(?s)([^/]*)/*$", 1)


def suffix(name: Column) -> Column:
    """From the last dot on; none for names that only start with a dot."""
    return F.regexp_extract(name, r"(?s)^\.*[^.].*?(\.[^.]+)$", 1)


def looks_binary(content: Column) -> Column:
    """A NUL among the first bytes."""
    head = F.decode(F.substring(content, 1, fixed.SNIFF_BYTES), "ISO-8859-1")
    return F.coalesce(F.locate("\0", head) > 0, F.lit(False))


def media_type(path: Column, content: Column | None = None) -> Column:
    """By file name, by suffix, by the standard table (compression suffixes looked through), else by bytes."""
    name = F.lower(file_name(path))
    end = suffix(name)
    plain = F.coalesce(lookup(end, fixed.STDLIB_ALIASES), end)
    inner = F.when(end.isin(*fixed.STDLIB_ENCODINGS), suffix(F.regexp_replace(name, r"\.[^.]+$", ""))).otherwise(plain)
    inner = F.coalesce(lookup(inner, fixed.STDLIB_ALIASES), inner)
    sniffed = F.lit("text/plain") if content is None else F.when(looks_binary(content), F.lit("application/octet-stream")).otherwise(F.lit("text/plain"))
    return F.coalesce(
        lookup(name, fixed.BY_FILENAME), lookup(end, fixed.BY_EXTENSION), lookup(inner, fixed.STDLIB_TYPES), sniffed
    )


def is_textual(kind: Column) -> Column:
    return kind.startswith("text/") | kind.isin(*fixed.TEXTUAL_TYPES)
