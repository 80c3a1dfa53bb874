"""The locator: where a unit of text stands in its document.

One sparse struct serves all kinds; a kind is added by naming its fields in
``KINDS`` (in the order its JSON lists them, which is alphabetical).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCATOR = (
    "struct<kind:string,start:bigint,end:bigint,number:int,bbox:array<double>,sheet:string,ref:string,shape:string,path:string,line:int>"
)
FIELDS = "kind start end number bbox sheet ref shape path line".split()
KINDS: dict[str, list[str]] = {
    "lines": ["end", "kind", "start"],
    "bytes": ["end", "kind", "start"],
    "page": ["bbox", "kind", "number"],
    "cell": ["kind", "ref", "sheet"],
    "slide": ["kind", "number", "shape"],
    "node": ["kind", "line", "path"],
}


def register_kind(kind: str, fields: list[str]) -> None:
    """Adds a kind whose payload uses the struct's ``fields``."""
    if not set(fields) <= set(FIELDS):
        raise ValueError(f"unknown fields: {sorted(set(fields) - set(FIELDS))}")
    KINDS[kind] = sorted({*fields, "kind"})


def locator(kind: str, **values: Column) -> Column:
    """A locator struct of ``kind``; fields that are not given are null."""
    types = dict(p.split(":", 1) for p in LOCATOR[7:-1].replace("array<double>", "array").split(","))
    types["bbox"] = "array<double>"
    columns = {"kind": F.lit(kind), **values}
    return F.struct(*[columns.get(f, F.lit(None)).cast(types[f]).alias(f) for f in FIELDS])


def lines(start: Column, end: Column) -> Column:
    return locator("lines", start=start, end=end)


def quoted(s: Column) -> Column:
    """A JSON string with non-ASCII text kept as it is."""
    # {"s":"..."} without the five characters before the string and the brace behind it
    return F.regexp_extract(F.to_json(F.struct(s.alias("s"))), r'(?s)^\{"s":(.*)\}$', 1)


def _json(loc: Column, kind: str, space: str) -> Column:
    def field(name: str) -> Column:
        value = loc[name]
        if name == "bbox":
            shown = F.concat(F.lit("["), F.array_join(F.transform(value, lambda v: v.cast("string")), "," + space), F.lit("]"))
        elif name in ("start", "end", "number", "line"):
            shown = value.cast("string")
        else:
            shown = quoted(value)
        return F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":{space}'), shown))

    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*[field(n) for n in KINDS[kind]])), "," + space), F.lit("}"))


def canonical_json(loc: Column, space: str = "") -> Column:
    """Sorted keys, compact; absent fields left out."""
    out = F.lit(None).cast("string")
    for kind in KINDS:
        out = F.when(loc["kind"] == kind, _json(loc, kind, space)).otherwise(out)
    return out


def is_valid(loc: Column) -> Column:
    """Whether a unit can be pointed at by this locator."""
    full = lambda c: F.coalesce(F.regexp_like(c, F.lit(r"(?U)\S")), F.lit(False))
    start, end = loc["start"], loc["end"]
    rules = {
        "lines": (start >= 1) & (end >= start),
        "bytes": (start >= 0) & (end > start),
        "page": (loc["number"] >= 1) & (loc["bbox"].isNull() | (F.size(loc["bbox"]) == 4)),
        "cell": full(loc["sheet"]) & full(loc["ref"]),
        "slide": loc["number"] >= 1,
        "node": full(loc["path"]) & (loc["line"].isNull() | (loc["line"] >= 1)),
    }
    out = F.lit(False)
    for kind in KINDS:
        out = F.when(loc["kind"] == kind, F.coalesce(rules.get(kind, F.lit(True)), F.lit(False))).otherwise(out)
    return out


def is_sha(sha: Column) -> Column:
    """64 hex digits once stripped and lower-cased."""
    return F.regexp_like(F.lower(F.trim(sha)), F.lit("^[0-9a-f]{64}$"))


def label(loc: Column) -> Column:
    """What a person reads: where the unit is."""
    span = lambda one, many: F.when(
        loc["start"] == loc["end"], F.format_string(f"{one} %d", loc["start"])
    ).otherwise(F.format_string(f"{many} %d-%d", loc["start"], loc["end"]))
    shown = {
        "lines": span("line", "lines"),
        "bytes": F.format_string("bytes %d-%d", loc["start"], loc["end"]),
        "page": F.format_string("page %d", loc["number"]),
        "cell": F.concat(loc["sheet"], F.lit("!"), loc["ref"]),
        "slide": F.concat(F.format_string("slide %d", loc["number"]), F.coalesce(F.format_string(" (%s)", F.nullif(loc["shape"], F.lit(""))), F.lit(""))),
        "node": F.concat(loc["path"], F.coalesce(F.concat(F.lit(" (line "), loc["line"].cast("string"), F.lit(")")), F.lit(""))),
    }
    out = loc["kind"]
    for kind, column in shown.items():
        out = F.when(loc["kind"] == kind, column).otherwise(out)
    return out


def cite(origin: Column, blob_sha: Column, loc: Column) -> Column:
    """Origin (or the hash's first 12 digits) and the label."""
    known = F.coalesce(F.nullif(origin, F.lit("")), F.substring(blob_sha, 1, 12))
    return F.concat(known, F.lit(" · "), label(loc))
