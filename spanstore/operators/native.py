"""Extractors that are column expressions: text, markdown, mermaid, plantuml, csv.

Each takes the decoded text and gives ``array<UNIT>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.lines import bind, is_blank, split_lines, windows
from ..functions.locators import lines as line_locator
from .csvs import csv_texts
from .units import UNITS


def _meta(**values: Column) -> Column:
    """A string map without the null values."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def _unit(start: Column, end: Column, text: Column, meta: Column, verbatim: Column) -> Column:
    return F.struct(
        line_locator(start, end).alias("locator"), text.alias("text"), meta.alias("meta"), verbatim.alias("verbatim")
    )


def no_meta() -> Column:
    return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def text_units(text: Column) -> Column:
    """Line windows of any text."""
    return F.transform(
        windows(split_lines(text)), lambda w: _unit(w["start"], w["end"], w["text"], no_meta(), F.lit(True))
    ).cast(UNITS)


def _trails(heads: Column) -> Column:
    """Heading trail of each heading: a deeper level is padded, a shallower one cuts the trail."""

    def step(acc: Column, h: Column) -> Column:
        level = h["level"].cast("int")
        kept = F.slice(acc["trail"], F.lit(1), F.least(F.size(acc["trail"]), level - 1))
        padded = F.concat(kept, F.array_repeat(F.lit(""), F.greatest(F.lit(0), level - 1 - F.size(kept))))
        trail = F.concat(padded, F.array(h["title"]))
        return F.struct(trail.alias("trail"), F.array_append(acc["all"], trail).alias("all"))

    start = F.struct(F.array().cast("array<string>").alias("trail"), F.array().cast("array<array<string>>").alias("all"))
    return F.aggregate(heads, start, step, lambda acc: acc["all"])


def _headings(lines: Column) -> Column:
    """array<struct<line, level, title>> of headings outside ``` fences."""

    def mark(acc: Column, line: Column) -> Column:
        fence = F.regexp_like(line, F.lit(r"(?U)^\s*```"))
        marks = F.regexp_extract(line, "(?U)" + fixed.HEADING, 1)
        title = F.regexp_extract(line, "(?U)" + fixed.HEADING, 2)
        n = acc["n"] + 1
        found = F.struct(n.alias("line"), F.length(marks).alias("level"), title.alias("title"))
        hit = ~fence & ~acc["fenced"] & (marks != "")
        return F.struct(
            n.alias("n"),
            F.when(fence, ~acc["fenced"]).otherwise(acc["fenced"]).alias("fenced"),
            F.when(hit, F.array_append(acc["found"], found)).otherwise(acc["found"]).alias("found"),
        )

    none = F.array().cast("array<struct<line:int,level:int,title:string>>")
    return F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.lit(False).alias("fenced"), none.alias("found")), mark, lambda acc: acc["found"])


def markdown_units(text: Column) -> Column:
    """Sections between headings; a long one becomes windows that repeat its heading."""

    def cut(ls: Column, hs: Column, trails: Column) -> Column:
        n, k = F.size(ls), F.size(hs)

        def section(i: Column) -> Column:
            # i = -1 is what stands before the first heading.
            start = F.when(i < 0, F.lit(1)).otherwise(F.get(hs, i)["line"])
            end = F.coalesce(F.get(hs, i + 1)["line"] - 1, n)
            trail = F.filter(F.coalesce(F.get(trails, i), F.array().cast("array<string>")), lambda t: t != "")
            return F.struct(start.alias("start"), end.alias("end"), trail.alias("trail"))

        sections = F.filter(F.transform(F.sequence(F.lit(-1), k - 1), section), lambda s: s["end"] >= s["start"])

        def units(s: Column) -> Column:
            own = F.slice(ls, s["start"], s["end"] - s["start"] + 1)
            full = F.size(s["trail"]) > 0
            meta = _meta(
                heading=F.when(full, F.element_at(s["trail"], -1)), heading_trail=F.when(full, F.array_join(s["trail"], " > "))
            )

            def split(body: Column) -> Column:
                whole = F.array(_unit(s["start"], s["end"], body, meta, F.lit(True)))
                parts = F.transform(
                    windows(split_lines(body)),
                    lambda w: _unit(s["start"] + w["start"] - 1, s["start"] + w["end"] - 1, w["text"], meta, F.lit(True)),
                )
                return F.when(is_blank(body), F.slice(whole, F.lit(1), F.lit(0))).when(
                    F.length(body) <= fixed.MAX_CHARS, whole
                ).otherwise(parts)

            return bind(F.array_join(own, "\n"), split)

        return F.when(n > 0, F.flatten(F.transform(sections, units))).otherwise(F.array().cast(UNITS))

    return bind(split_lines(text), lambda ls: bind(_headings(ls), lambda hs: bind(_trails(hs), lambda ts: cut(ls, hs, ts)))).cast(UNITS)


def _full(c: Column) -> Column:
    return F.when(c != "", c)


def _diagram_lines(text: Column, edge: str, node: str | None, order: tuple[int, int, int, int]) -> Column:
    """One unit per line that is neither blank nor a comment, with its first arrow in the meta."""
    pattern = "(?U)" + edge
    source, arrow, target, label = order

    def unit(line: Column, i: Column) -> Column:
        bare = F.regexp_replace(line, r"(?U)^\s+|\s+$", "")
        has_edge = F.regexp_like(line, F.lit(pattern))
        part = lambda g: F.regexp_extract(line, pattern, g)
        unquoted = lambda c: F.btrim(c, F.lit('"'))
        strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
        meta = _meta(
            edge_from=F.when(has_edge, unquoted(part(source))),
            edge_to=F.when(has_edge, unquoted(part(target))),
            arrow=F.when(has_edge, part(arrow)),
            edge_label=F.when(has_edge & (part(label) != ""), strip(part(label))),
            **(
                {}
                if node is None
                else {
                    "node_id": F.when(~has_edge, _full(F.regexp_extract(line, "(?U)" + node, 1))),
                    "node_label": F.when(
                        ~has_edge & F.regexp_like(line, F.lit("(?U)" + node)),
                        strip(F.coalesce(_full(F.regexp_extract(line, "(?U)" + node, 2)), F.regexp_extract(line, "(?U)" + node, 3))),
                    ),
                }
            ),
        )
        keep = bare != ""
        for prefix in fixed.COMMENT_PREFIXES:
            keep = keep & ~bare.startswith(prefix)
        return F.when(keep, _unit(i + 1, i + 1, bare, meta, bare == line))

    return F.array_compact(F.transform(split_lines(text), unit)).cast(UNITS)


def mermaid_units(text: Column) -> Column:
    return _diagram_lines(text, fixed.MERMAID_EDGE, fixed.MERMAID_NODE, (1, 2, 4, 3))


def plantuml_units(text: Column) -> Column:
    return _diagram_lines(text, fixed.PLANTUML_EDGE, None, (1, 2, 3, 4))


def csv_units(text: Column, spans: Column) -> Column:
    """Records by the hundred and twenty, from what :func:`.csvs.csv_spans` gives for the text."""

    def unit(p: Column, body: Column) -> Column:
        meta = _meta(columns=spans["columns"], rows=p["end"] - p["start"] + 1)
        return _unit(p["start"], p["end"], body, meta, F.lit(True))

    return F.zip_with(spans["parts"], csv_texts(text, spans["parts"]), unit).cast(UNITS)


NATIVE = {"text": text_units, "markdown": markdown_units, "mermaid": mermaid_units, "plantuml": plantuml_units}
