"""Decoding, line splitting and line windows, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import MAX_CHARS, MAX_LINES

# Every line boundary of Unicode text; \r\n counts once.
BOUNDARY = "\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85  ]"
_SPACE = r"(?U)^\s*$"


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def decode(content: Column, keep_bom: bool = False) -> Column:
    """UTF-8 with replacement characters; a leading byte order mark is dropped."""
    text = F.make_valid_utf8(content.cast("string"))
    return text if keep_bom else F.regexp_replace(text, "^﻿", "")


def split_lines(text: Column) -> Column:
    """The lines of a text without their ends; a final line end starts no line."""

    def trim(parts: Column) -> Column:
        n = F.size(parts)
        return F.when(F.get(parts, n - 1) == "", F.slice(parts, F.lit(1), n - 1)).otherwise(parts)

    return bind(F.split(text, BOUNDARY, -1), trim)


def is_blank(text: Column) -> Column:
    return F.regexp_like(text, F.lit(_SPACE))


def collapse(text: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def windows(lines: Column, max_lines: int = MAX_LINES, max_chars: int = MAX_CHARS) -> Column:
    """array<struct<start,end,text>>: greedy windows over lines (1-based, inclusive).

    A window closes before the line that would exceed a limit, a newline
    counted per line; one over-long line is a window alone; blank windows are
    left out.  One fold over the lines; texts are cut at the end.
    """
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    state = F.struct(empty.alias("done"), F.lit(1).cast("long").alias("start"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("size"))

    def step(acc: Column, line: Column) -> Column:
        length = F.length(line).cast("long") + 1
        close = (acc["n"] > 0) & ((acc["n"] >= max_lines) | (acc["size"] + length > max_chars))
        end = acc["start"] + acc["n"]
        done = F.when(close, F.array_append(acc["done"], F.struct(acc["start"].alias("start"), (end - 1).alias("end")))).otherwise(acc["done"])
        return F.struct(
            done.alias("done"),
            F.when(close, end).otherwise(acc["start"]).alias("start"),
            F.when(close, F.lit(1).cast("long")).otherwise(acc["n"] + 1).alias("n"),
            F.when(close, length).otherwise(acc["size"] + length).alias("size"),
        )

    def finish(acc: Column) -> Column:
        last = F.struct(acc["start"].alias("start"), (acc["start"] + acc["n"] - 1).alias("end"))
        return F.when(acc["n"] > 0, F.array_append(acc["done"], last)).otherwise(acc["done"])

    def cut(ls: Column) -> Column:
        spans = F.aggregate(ls, state, step, finish)
        text = lambda s: F.array_join(F.slice(ls, s["start"].cast("int"), (s["end"] - s["start"] + 1).cast("int")), "\n")
        full = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), text(s).alias("text")))
        return F.filter(full, lambda w: ~is_blank(w["text"]))

    return bind(lines, cut)
