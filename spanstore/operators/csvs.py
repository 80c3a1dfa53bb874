"""CSV as folds over lines: of one text as a column expression, of files of any length over their chunks.

A quote opens a field only at the field's start, two quotes inside one are a
quote, and text after the closing quote belongs to the field.  So a line's
effect on what follows is whether it leaves a quoted field open, and of a run
of lines it is enough to know that for both ways of entering it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import MAX_LINES
from ..functions.lines import bind, split_lines

CHUNK_LINES = 256
# Where the fold stands: at a field's start, in a plain field, in a quoted one, behind a quote in it; before the line.
_START, _PLAIN, _QUOTED, _BEHIND, _BEFORE = range(5)


def file_lines(text: Column) -> Column:
    """Lines as records count them: by line feeds alone; a final one starts no line."""

    def trim(parts: Column) -> Column:
        n = F.size(parts)
        return F.when(F.get(parts, n - 1) == "", F.slice(parts, F.lit(1), n - 1)).otherwise(parts)

    return bind(F.split(text, "\n", -1), trim)


def _marks(text: Column, mark: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, mark, F.lit("")))


def line_effect(line: Column, inside: Column, mark: Column) -> Column:
    """struct<open, marks, bad> of one line that starts ``inside`` a quoted field or not.

    ``open``: the line ends in one; ``marks``: delimiters outside of fields;
    ``bad``: a carriage return outside of quotes stands before other text.
    """

    def step(acc: Column, piece: Column) -> Column:
        was = acc["at"]
        # Before each piece but the first stands a quote; a line inside a field is one that a quote precedes.
        at = F.when(was == _BEFORE, _START).when(was.isin(_START, _BEHIND), _QUOTED).when(was == _QUOTED, _BEHIND).otherwise(_PLAIN)

        def read(state: Column) -> Column:
            plain = (state != _QUOTED) & (piece != "")
            return F.struct(
                F.when(plain, F.when(F.endswith(piece, mark), _START).otherwise(_PLAIN)).otherwise(state).alias("at"),
                (acc["marks"] + F.when(plain, _marks(piece, mark)).otherwise(0)).alias("marks"),
                (plain & F.endswith(piece, F.lit("\r"))).alias("returned"),
                (acc["bad"] | acc["returned"] | (plain & F.regexp_like(piece, F.lit("\r[^\r]")))).alias("bad"),
            )

        return bind(at, read)

    begin = F.struct(
        F.when(inside, _START).otherwise(_BEFORE).alias("at"), F.lit(0).alias("marks"), F.lit(False).alias("returned"), F.lit(False).alias("bad")
    )
    quoted = F.aggregate(
        F.split(line, '"', -1), begin, step,
        lambda a: F.struct((a["at"] == _QUOTED).alias("open"), a["marks"].alias("marks"), a["bad"].alias("bad")),
    )
    bare = F.struct(
        inside.alias("open"), F.when(inside, 0).otherwise(_marks(line, mark)).alias("marks"),
        (~inside & F.regexp_like(line, F.lit("\r[^\r]"))).alias("bad"),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(bare)


def unit_of(record: Column) -> Column:
    """Unit of a record (from 0): the first holds the header and MAX_LINES records, each other one MAX_LINES."""
    return F.floor((F.greatest(record, F.lit(1)) - 1) / MAX_LINES)


_PARTS = "array<struct<unit:bigint,start:bigint,end:bigint>>"


def fold(lines: Column, inside: Column, first_record: Column, mark: Column) -> Column:
    """struct<open, records, marks, bad, parts> of a run of lines.

    ``records`` end in it; ``marks`` are the delimiters of the run's first
    record; ``parts`` are spans of lines (1-based) by the unit they belong to.
    """

    def step(acc: Column, line: Column) -> Column:
        def add(e: Column) -> Column:
            n, done = acc["n"] + 1, acc["records"] + F.when(e["open"], 0).otherwise(1)
            old, new = unit_of(first_record + acc["records"]), unit_of(first_record + done)
            part = F.struct(old.alias("unit"), acc["start"].alias("start"), n.alias("end"))
            return F.struct(
                n.alias("n"),
                e["open"].alias("open"),
                done.alias("records"),
                (acc["marks"] + F.when(acc["records"] == 0, e["marks"]).otherwise(0)).alias("marks"),
                (acc["bad"] | e["bad"]).alias("bad"),
                F.when(new > old, n + 1).otherwise(acc["start"]).alias("start"),
                F.when(new > old, F.array_append(acc["parts"], part)).otherwise(acc["parts"]).alias("parts"),
            )

        return bind(line_effect(line, acc["open"], mark), add)

    def finish(acc: Column) -> Column:
        last = F.struct(unit_of(first_record + acc["records"]).alias("unit"), acc["start"].alias("start"), acc["n"].alias("end"))
        parts = F.when(acc["start"] <= acc["n"], F.array_append(acc["parts"], last)).otherwise(acc["parts"])
        return F.struct(*(acc[c].alias(c) for c in ("open", "records", "marks", "bad")), parts.alias("parts"))

    zero = lambda n: F.lit(n).cast("long")
    begin = F.struct(
        zero(0).alias("n"), inside.alias("open"), zero(0).alias("records"), F.lit(0).alias("marks"), F.lit(False).alias("bad"),
        zero(1).alias("start"), F.array().cast(_PARTS).alias("parts"),
    )
    return F.aggregate(lines, begin, step, finish)


def csv_spans(text: Column, path: Column) -> Column:
    """struct<columns, bad, parts> of a whole text: width of the first record, misplaced carriage returns, units' spans.

    Empty text has no parts; a quoted field left open runs to the end; fields
    may be of any length.
    """
    mark = F.when(F.endswith(F.lower(path), F.lit(".tsv")), "\t").otherwise(",")

    def read(lines: Column) -> Column:
        blank = F.regexp_like(F.get(lines, F.lit(0)), F.lit(r"^\r*\z"))
        return bind(
            fold(lines, F.lit(False), F.lit(0).cast("long"), mark),
            lambda f: F.struct(F.when(blank, 0).otherwise(f["marks"] + 1).alias("columns"), f["bad"].alias("bad"), f["parts"].alias("parts")),
        )

    return bind(file_lines(text), read)


def csv_texts(text: Column, parts: Column) -> Column:
    """Texts of spans; lines are those of any text, so other line ends than line feeds shift them, as record numbers don't."""
    return bind(
        split_lines(text),
        lambda ls: F.transform(parts, lambda p: F.array_join(F.slice(ls, p["start"].cast("int"), (p["end"] - p["start"] + 1).cast("int")), "\n")),
    )


def chunks_of(docs: DataFrame, key: str, text: Column, size: int = CHUNK_LINES) -> DataFrame:
    """(key, chunk, lines) of files: at most ``size`` lines a chunk, so that one long file feeds many tasks."""
    lines = file_lines(text)
    cut = bind(
        lines,
        lambda ls: F.transform(
            F.filter(F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / size).cast("int")), lambda i: F.size(ls) > 0), lambda i: F.slice(ls, i * size + 1, F.lit(size))
        ),
    )
    return docs.select(key, F.posexplode(cut).alias("chunk", "lines"))


def chunk_units(chunks: DataFrame, key: str = "file", mark: Column | None = None) -> DataFrame:
    """(key, ordinal, start, end, columns, text) of CSV files given as chunks (key, chunk, lines).

    Chunks of a file are ordered by ``chunk`` (any type that sorts, unique in
    its file); records may cross them anywhere.  Each chunk is folded for both
    ways of entering it; a window over the chunks' few numbers, not their text,
    then tells each how it is entered and at which line and record.  A carriage
    return ends a line's text and is text elsewhere.  ``mark``: the delimiter,
    a comma if not given.
    """
    mark = F.lit(",") if mark is None else mark
    zero = F.lit(0).cast("long")
    both = chunks.select(
        key, "chunk", F.size("lines").cast("long").alias("n"),
        F.regexp_like(F.get("lines", F.lit(0)), F.lit(r"^\r*\z")).alias("blank"),
        fold(F.col("lines"), F.lit(False), zero, mark).alias("out"), fold(F.col("lines"), F.lit(True), zero, mark).alias("in"),
    ).select(
        key, "chunk", "n", "blank", *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("out", "in") for c in ("open", "records", "marks"))
    )
    ordered = Window.partitionBy(key).orderBy("chunk")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    fixed_end = F.col("out_open") == F.col("in_open")
    swaps = F.when(F.col("out_open") & ~F.col("in_open"), 1).otherwise(0)
    odd = F.coalesce(F.sum(swaps).over(before), F.lit(0)) % 2 == 1
    entered = both.withColumn("odd", odd).withColumn("base", F.when(fixed_end, F.col("out_open") != F.col("odd")))
    # The last chunk that ends alike either way decides; each one since that turns in to out turns it once.
    entered = entered.withColumn("inside", F.coalesce(F.last("base", ignorenulls=True).over(before), F.lit(False)) != F.col("odd"))
    pick = lambda c: F.when(F.col("inside"), F.col(f"in_{c}")).otherwise(F.col(f"out_{c}"))
    placed = entered.withColumns(
        {
            "first_record": F.coalesce(F.sum(pick("records")).over(before), zero),
            "first_line": F.coalesce(F.sum("n").over(before), zero),
            "no": F.row_number().over(ordered),
        }
    )
    head = F.when(F.col("first_record") == 0, pick("marks")).otherwise(0)
    empty_head = F.max((F.col("no") == 1) & F.col("blank")).over(Window.partitionBy(key))
    placed = placed.withColumn("columns", F.when(empty_head, 0).otherwise(1 + F.sum(head).over(Window.partitionBy(key))))
    places = placed.select(key, "chunk", "inside", "first_record", "first_line", "columns")
    parts = chunks.join(places, [key, "chunk"]).select(
        key, "chunk", "lines", "first_line", "columns",
        F.explode(fold(F.col("lines"), F.col("inside"), F.col("first_record"), mark)["parts"]).alias("p"),
    )
    own = F.slice("lines", F.col("p.start").cast("int"), (F.col("p.end") - F.col("p.start") + 1).cast("int"))
    text = F.array_join(F.transform(own, lambda s: F.regexp_replace(s, r"\r\z", "")), "\n")
    parts = parts.select(
        key, F.col("p.unit").alias("ordinal"), (F.col("first_line") + F.col("p.start")).alias("start"),
        (F.col("first_line") + F.col("p.end")).alias("end"), "columns", text.alias("text"),
    )
    return parts.groupBy(key, "ordinal").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.first("columns").cast("long").alias("columns"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda s: s["text"]), "\n").alias("text"),
    )
