"""HTML extraction by layout: a tree with implied tags, then visible text as blocks.

One regular expression cuts the page into tags, comments and text.  A builder
closes what the next tag implies (paragraphs, list items, table parts, options),
ignores stray end tags, and drops what a browser does not show: scripts, styles,
templates, ``hidden`` and ``display:none`` elements, what stands in ``visibility:hidden``
ones unless it is made visible again,
closed dialogs, all but the summary of closed details, hidden inputs, datalists, and what browsers with scripts, frames and
media show other content for (noscript, noembed, noframes, iframe, canvas, audio, video).
In drawings and formulas descriptions, definitions and annotations are dropped.  Of a
select the chosen option is shown, of a list box all; an object shows its fallback.  The renderer walks the tree: inline text is collapsed, blocks start
lines (paragraph-like ones leave a blank line between), list items carry bullets
or numbers (from ``start``, also negative, down if ``reversed``) and indentation, ``pre`` keeps its white space, and table cells are
padded into aligned columns, spans of rows and columns counted, with bounds that keep the text's size in proportion to the page's; what stands in a table outside of its cells goes
before the table, as a browser's foster parenting has it.

Edge cases: null html gives null text; a page without visible text gives the
empty string; unclosed and misnested tags are closed where a new block or the
end of the page implies it; nesting beyond ``MAX_DEPTH`` is flattened into its
parent; repeated rows are extracted each; a very long page is one row, and time and
memory grow with its length; an empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes canvas audio video datalist".split())
# Dropped inside svg and math only.
UNDRAWN = frozenset("title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient filter annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr".split())
BLOCK = SPACED | frozenset(
    "html body address article aside details dialog div dd dt figcaption footer form header hgroup legend li main menu nav section summary search tr caption center optgroup option".split()
)
PARTS = frozenset("thead tbody tfoot tr td th".split())
# A start tag closes the open elements on the left, up to a boundary on the right.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}), "body": ({"head"}, {"html"}),
}
IMPLIED["thead"] = IMPLIED["tfoot"] = IMPLIED["tbody"]
# A quote delimits a value only after "="; anywhere else in a tag it is a character as any other.
VALUE = r"\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+"
PIECE = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:{VALUE})?+)?+)*+)>|([^<]+|<)", re.S)
# For the rest of a page where a quote is never closed.
UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|([^<]+|<)", re.S)
TAG_START = re.compile("</?[a-zA-Z]")
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({VALUE})?+)?+")
GONE = re.compile(r"display\s*:\s*none", re.I)
VEILED = re.compile(r"visibility\s*:\s*(\w+)", re.I)
SPACE = re.compile(r"[ \t\n\f\r]+")
DRAWS = re.compile("<(?:svg|math)", re.I)
INTEGER = re.compile("[+-]?[0-9]{1,9}")
MAX_DEPTH = 200
PAD = 40
GAP = 80


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def attributes(self) -> dict[str, str]:
        return {k.lower(): unescape(v[1:-1] if v[:1] in ("'", '"') else v) for k, v in ATTRIBUTE.findall(self.attrs)} if self.attrs else {}

    def visible(self) -> bool:
        if self.tag in UNSEEN:
            return False
        if not self.attrs:
            return self.tag != "dialog"
        a = self.attributes()
        return not ("hidden" in a or GONE.search(a.get("style", "")) or (self.tag == "dialog" and "open" not in a))


def build(page: str) -> Node:
    """The page's tree; unknown and unclosed elements are closed by what follows."""
    root = Node("html")
    open_: list[Node] = [root]

    def close(tags: set[str], fence: set[str]) -> None:
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in fence:
                return
            if open_[i].tag in tags:
                del open_[i:]
                if not any(n.tag in tags for n in open_[1:]):
                    return
                close(tags, fence)
                return

    def drawn() -> bool:
        """Whether the innermost of the elements that switch the rules is a drawing or a formula."""
        return next((n.tag in ("svg", "math") for n in reversed(open_) if n.tag in ("svg", "math", "foreignobject")), False)

    draws = DRAWS.search(page) is not None
    at, piece, last = 0, PIECE, page.rfind(">")
    while at < len(page):
        if at > last and not page.startswith("<!--", at):  # no tag ends behind here
            end, tag, attrs, text = None, None, None, page[at:]
            start, at = at, len(page)
        else:
            m = piece.match(page, at)
            end, tag, attrs, text = m.groups()
            if text == "<" and piece is PIECE and TAG_START.match(page, at):
                piece = UNQUOTED
                continue
            start, at = at, m.end()
        if text is not None:
            if open_[-1].tag == "head" and text.strip(" \t\n\f\r"):
                open_.pop()  # text ends the head
            open_[-1].kids.append(unescape(text))
        elif tag is None:
            if draws and page.startswith("<![CDATA[", start) and drawn():
                stop = page.find("]]>", start)
                at = stop + 3 if stop >= 0 else len(page)
                open_[-1].kids.append(page[start + 9 : stop if stop >= 0 else len(page)])
        elif end:
            tag = tag.lower()
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == tag:
                    del open_[i:]
                    break
                if open_[i].tag in ("table", "td", "th") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break
        else:
            tag = tag.lower()
            if tag == "html":
                root.attrs = attrs
                continue
            if (tag in BLOCK and tag not in ("option", "optgroup")) or tag == "body":
                close({"p", "head"} if tag != "head" else {"p"}, {"table", "td", "th", "li", "blockquote", "div", "object", "foreignobject"})
            elif open_[-1].tag == "head" and tag not in ("meta", "link", "base") and tag not in UNSEEN:
                open_.pop()
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            node = Node(tag, attrs.strip().rstrip("/"))
            foreign = draws and drawn()
            if foreign and tag in UNDRAWN:
                node.attrs = "hidden"
            elif foreign and tag == "text":
                open_[-1].kids.append(" ")
            open_[-1].kids.append(node)
            if (foreign or tag in ("svg", "math")) and attrs.endswith("/"):
                continue
            if tag in RAW:
                stop = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                inside = page[at : stop.start() if stop else len(page)]
                node.kids.append(unescape(inside.removeprefix("\n")) if tag == "textarea" else inside)
                at = stop.end() if stop else len(page)
            elif tag not in VOID and len(open_) < MAX_DEPTH:
                open_.append(node)
    if VEILED.search(page):
        unveil(root, True)
    return root


def unveil(node: Node, shown: bool) -> None:
    """Takes out what stands in elements of hidden visibility; an element inside that is visible again keeps its own."""
    kept = []
    for kid in node.kids:
        if isinstance(kid, Node):
            said = VEILED.search(kid.attributes().get("style", "")) if kid.attrs else None
            seen = said[1].lower() not in ("hidden", "collapse") if said else shown
            unveil(kid, seen)
            if seen or kid.tag not in ("img", "input", "select", "textarea", "hr", "br"):
                kept.append(kid)
        elif shown:
            kept.append(kid)
    node.kids = kept


class Lines:
    """Output under way: finished lines, the inline text of the current one, and whether a blank line is due."""

    def __init__(self):
        self.done: list[str] = []
        self.now: list[str] = []
        self.blank = False

    def end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.now)).strip(" ")
        self.now = []
        if text:
            self.add(text)

    def add(self, line: str) -> None:
        if self.blank and self.done:
            self.done.append("")
        self.blank = False
        self.done.append(line)


def _has_parts(node: Node) -> bool:
    """Whether rows or cells of the table around ``node`` stand below it."""
    return any(isinstance(k, Node) and k.tag != "table" and (k.tag in PARTS or _has_parts(k)) for k in node.kids)


def _number(said: str | None) -> int | None:
    """An integer attribute; anything else is as if it were not there."""
    return int(said) if said and INTEGER.fullmatch(said.strip(" \t\n\f\r")) else None


def _count_rows(node: Node) -> int:
    """At least the number of rows of a table, those of tables inside it not counted."""
    return sum(1 + _count_rows(k) for k in node.kids if isinstance(k, Node) and k.tag != "table")


def _aligned(rows: list[dict[int, str]]) -> list[str]:
    """Lines of rows of cells by column.

    A column starts after the widest cells of those before it, of which ``PAD`` characters count; columns that only
    spans fill take two; a gap is at most ``GAP`` wide.  So a line is at most a constant times its cells.
    """
    widths: dict[int, int] = {}
    for row in rows:
        for column, cell in row.items():
            widths[column] = max(widths.get(column, 0), min(len(cell), PAD))
    start, at, before = {}, 0, 0
    for column in sorted(widths):
        at += 2 * (column - before)
        start[column] = at
        at, before = at + widths[column] + 2, column + 1
    lines = []
    for row in rows:
        pieces, length = [], 0
        for column, cell in row.items():
            gap = min(max(start[column] - length, 2 if pieces else 0), GAP)
            pieces.append(" " * gap + cell)
            length += gap + len(cell)
        lines.append("".join(pieces).rstrip())
    return lines


def _grid(table_: Node) -> list[str]:
    """Rows of a table with cells padded to their columns, after whatever stands in it outside of cells."""
    rows: list[dict[int, str]] = []
    before: list[str] = []
    head: list[str] = []
    loose = Node("div")
    in_row = False
    covered: list[tuple[int, int, int]] = []  # columns [from, to) that a cell above covers down to a row, in order
    coming: list[tuple[int, int, int]] = []
    place = seen = 0  # the next free column, and how many of ``covered`` lie before it
    last = _count_rows(table_)

    def flush() -> None:
        before.extend(render(loose))
        loose.kids = []

    def end_row() -> None:
        nonlocal in_row
        in_row = False

    def begin_row() -> None:
        nonlocal in_row, place, seen, covered, coming
        joined: list[tuple[int, int, int]] = []
        for one in sorted([*covered, *coming]) if coming else covered:
            if one[2] < len(rows):
                continue
            if joined and joined[-1][1] >= one[0] and joined[-1][2] == one[2]:
                one = (joined[-1][0], max(joined.pop()[1], one[1]), one[2])
            joined.append(one)
        covered, coming, place, seen, in_row = joined, [], 0, 0, True
        rows.append({})

    def add_cell(cell: Node) -> None:
        nonlocal place, seen
        a = cell.attributes()
        wide, high = (_number(a.get(k)) for k in ("colspan", "rowspan"))
        wide, high = 1 if wide is None else min(max(wide, 1), 1000), 1 if high is None else max(high, 0)
        while seen < len(covered) and covered[seen][0] <= place:
            place = max(place, covered[seen][1])
            seen += 1
        if high != 1:  # 0: all rows of the part
            coming.append((place, place + wide, min(len(rows) + high - 2, last) if high else last))
        if text := " ".join(x for x in render(cell) if x):
            rows[-1][place] = text
        place += wide

    def collect(node: Node, shown: bool) -> None:
        nonlocal in_row
        for kid in node.kids:
            if isinstance(kid, str):
                if shown:
                    loose.kids.append(kid)
            elif kid.tag not in PARTS and kid.tag not in UNSEEN and kid.tag not in ("table", "caption") and (kid.tag == "form" or _has_parts(kid)):
                # A browser takes it out of the table (a form is left empty), so it cannot hide the cells.
                collect(kid, kid.tag == "form" or (shown and kid.visible()))
            elif not kid.visible():
                continue
            elif kid.tag in ("td", "th"):
                flush()
                if not in_row:
                    begin_row()
                add_cell(kid)
            elif kid.tag in PARTS:
                flush()
                end_row()
                if kid.tag == "tr":
                    begin_row()
                else:
                    covered.clear()
                    coming.clear()
                collect(kid, True)
                flush()
                end_row()
            elif kid.tag == "caption":
                flush()
                head.extend(render(kid))
            elif shown:
                loose.kids.append(kid)

    collect(table_, True)
    flush()
    return [x for x in [*before, *head, *_aligned(rows)] if x]


def _options(select: Node) -> list[str]:
    """What a select shows: the chosen option, the first one that can be if none is, or all of a list box."""
    found: list[tuple[Node, bool]] = []

    def collect(node: Node, off: bool) -> None:
        for kid in node.kids:
            if isinstance(kid, Node) and kid.tag == "option":
                found.append((kid, off or "disabled" in kid.attributes()))
            elif isinstance(kid, Node) and kid.tag not in UNSEEN:
                collect(kid, off or (kid.tag == "optgroup" and "disabled" in kid.attributes()))

    def label(option: Node) -> str:
        return option.attributes().get("label") or " ".join(x for x in render(option) if x)

    collect(select, False)
    a = select.attributes()
    if "multiple" in a or (_number(a.get("size")) or 0) > 1:
        return [label(o) for o, _ in found if o.visible()]
    chosen = [o for o, _ in found if "selected" in o.attributes()][-1:] or [o for o, off in found if not off][:1]
    return [label(o) for o in chosen]


def render(node: Node, pre: bool = False) -> list[str]:
    """Lines of the visible text below ``node``; ``pre``: white space is kept."""
    out = Lines()

    def end(pre: bool) -> None:
        """The line under way ends, as it is if white space is kept."""
        if pre and out.now:
            out.add("".join(out.now))
            out.now = []
        out.end_line()

    def walk(n: Node, pre: bool) -> None:
        kids, step, count = n.kids, 1, 0
        if n.tag == "ol" and n.attrs:
            a = n.attributes()
            step = -1 if "reversed" in a else 1
            first = _number(a.get("start"))
            if first is None:
                first = sum(isinstance(k, Node) and k.tag == "li" for k in kids) if step < 0 else 1
            count = first - step
        if n.tag == "details" and "open" not in n.attributes():
            kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
        for kid in kids:
            if isinstance(kid, str):
                if pre and "\n" in kid:
                    *full, rest = kid.split("\n")
                    for line in full:
                        out.add("".join(out.now) + line)
                        out.now = []
                    out.now.append(rest)
                else:
                    out.now.append(kid)
                continue
            if not kid.visible():
                continue
            tag = kid.tag
            if tag == "br":
                had = bool("".join(out.now).strip())
                end(pre)
                if not had and out.done and out.done[-1]:
                    out.done.append("")
            elif tag == "wbr":
                continue
            elif tag == "img":
                out.now.append(kid.attributes().get("alt", ""))
            elif tag == "input":
                a = kid.attributes()
                out.now.append("" if a.get("type", "").lower() in ("hidden", "checkbox", "radio", "password", "file", "image") else f" {a.get('value', '')} ")
            elif tag == "select":
                out.now.append(f" {' '.join(_options(kid))} ")
            elif tag in ("textarea", "svg"):
                out.now.append(" ")
                walk(kid, tag == "textarea")
                out.now.append(" ")
            elif tag == "q":
                out.now.append('"')
                walk(kid, pre)
                out.now.append('"')
            elif tag in BLOCK:
                end(pre)
                out.blank |= tag in SPACED and not (tag in ("ul", "ol") and n.tag == "li")
                if tag == "hr":
                    out.add("---")
                elif tag == "table":
                    for line in _grid(kid):
                        out.add(line)
                elif tag == "li":
                    said = _number(kid.attributes().get("value")) if kid.attrs else None
                    count = count + step if said is None else said
                    mark = f"{count}. " if n.tag == "ol" else "- "
                    for i, line in enumerate(render(kid, pre)):
                        out.add((mark if i == 0 else " " * len(mark)) + line if line else "")
                elif tag in ("blockquote", "dd"):
                    for line in render(kid, pre):
                        out.add(("> " if tag == "blockquote" else "  ") + line if line else "")
                else:
                    kept = pre or tag == "pre"
                    walk(kid, kept)
                    end(kept)
                out.blank |= tag in SPACED
            else:
                walk(kid, pre)
                if tag in ("td", "th"):
                    out.now.append(" ")

    walk(node, pre or node.tag == "pre")
    end(pre or node.tag == "pre")
    return out.done


def page_text(page: str | None) -> str | None:
    """All visible text of a page."""
    return None if page is None else "\n".join(render(build(page.replace("\r\n", "\n").replace("\x00", "")))).strip("\n")


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of pages (page_id, url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(h) for h in batch["html"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], texts], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
