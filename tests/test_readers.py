"""Readers on files that meet their limits and odd rules."""

import base64
import csv
import io
import json
import random
import urllib.parse
import zlib

import pytest
from pyspark.sql import functions as F

from spanstore.functions import fixed
from spanstore.operators import native, trees
from spanstore.operators.csvs import chunk_units, chunks_of
from spanstore.operators.extract import Reader, extract
from spanstore.operators.table_function import register_units
from spanstore.plans.ingest import finished_units, ingest_entries
from spanstore.plans.store import Store
from spanstore.sources.tree import ENTRY


def shown(units):
    return [(u["locator"].get("path") or (u["locator"]["start"], u["locator"]["end"]), u["text"]) for u in units]


def test_json_over_the_limit_gives_the_largest_nodes_that_fit():
    value = {"small": {"x": [1, 2]}, "list": ["w" * 1500, "v" * 1500, {"deep": "u" * 3000}], "long": "t" * 5000, "é/": 1}
    text = json.dumps(value, ensure_ascii=False)
    got = dict(shown(trees.json_units(text, "a.json")))
    assert list(got) == ["/small", "/list/0", "/list/1", "/list/2", "/long", "/é/"]
    assert got["/small"] == json.dumps(value["small"], indent=2) and got["/long"] == json.dumps("t" * 5000) and got["/list/2"] == json.dumps(value["list"][2], indent=2)
    assert shown(trees.json_units("3", "a.json")) == [("/", "3")]
    for bad in ("{", '{"a": 1}\n{"a": 2}\n'):  # a second record, as in .jsonl
        with pytest.raises(trees.Degraded):
            list(trees.json_units(bad, "a.jsonl"))


def test_toml_dates_fail_and_bad_toml_degrades():
    with pytest.raises(TypeError):
        list(trees.toml_units("day = 2020-01-02\n", "a.toml"))
    with pytest.raises(trees.Degraded):
        list(trees.toml_units("= 1", "a.toml"))


def csv_statement(text, mark=","):
    """(start, end, columns, text) of units by the standard library's reader, None where it refuses."""
    lines, reader = text.splitlines(), csv.reader(io.StringIO(text), delimiter=mark)
    try:
        records = [(reader.line_num, len(r)) for r in reader]
    except csv.Error:
        return None
    out, start = [], 1
    for i, (end, _) in enumerate(records):
        if i == len(records) - 1 or (i and i % fixed.MAX_LINES == 0):
            out.append((start, end, records[0][1], "\n".join(lines[start - 1 : end])))
            start = end + 1
    return out


def csv_texts():
    rng = random.Random(7)
    long = lambda rare: "".join(rng.choice('ab,"\n\n\nx,') if rng.random() < rare else rng.choice("ab\n,") for _ in range(rng.randrange(500, 3000)))
    texts = ["", "\n", "\n\na,b", "only,a,header\n", '"', '""', '"""', 'a"b,c\n"d"e"f,g', 'a,"b\r\nc"\r\nd,e\r\n', "a\rb", 'a\r"b"', "a\x85b,c\nd", 'x,"never closed\n' + "y\n" * 300]
    texts += ["".join(rng.choice('ab,"""\n\n\r,x') for _ in range(rng.randrange(1, 30))) for _ in range(600)]
    return texts + [long(1) for _ in range(15)] + [long(0.02) for _ in range(15)]


@pytest.mark.parametrize("path, mark", [("t.csv", ","), ("T.TSV", "\t")])
def test_csv_fold_equals_the_plain_reader(spark, path, mark):
    texts = [t.replace(",", mark) for t in csv_texts()]
    df = spark.createDataFrame([(i, "csv", path, bytearray(t.encode())) for i, t in enumerate(texts)], "document_id long, extractor string, path string, content binary")
    for r in extract(df).collect():
        text = texts[r["document_id"]]
        want = csv_statement(text, mark)
        if want is None:
            assert (r["status"], r["reason"]) == ("degraded", "degraded_parse") and all(u["meta"] == {"parse_error": r["detail"]} for u in r["units"])
        else:
            got = [(u["locator"]["start"], u["locator"]["end"], int(u["meta"]["columns"]), u["text"]) for u in r["units"]]
            assert r["status"] == "ok" and got == want, text
            assert all(int(u["meta"]["rows"]) == u["locator"]["end"] - u["locator"]["start"] + 1 and u["verbatim"] for u in r["units"])


@pytest.mark.parametrize("size", [1, 3, 256])
def test_csv_chunks_equal_the_plain_reader(spark, size):
    texts = [t for t in csv_texts() if "\r" not in t.replace("\r\n", "\n") and "\x85" not in t]
    df = spark.createDataFrame(list(enumerate(texts)), "file long, text string")
    got = {}
    for r in chunk_units(chunks_of(df, "file", F.col("text"), size)).collect():
        got.setdefault(r["file"], []).append((r["ordinal"], r["start"], r["end"], r["columns"], r["text"]))
    for i, text in enumerate(texts):
        units = sorted(got.get(i, []))
        assert [u[0] for u in units] == list(range(len(units)))
        assert [u[1:] for u in units] == csv_statement(text), text


def test_xml_names_attributes_and_line_hints():
    text = '<r xmlns="urn:a" xmlns:b="urn:b">\n<x b:k="1">one</x>\n<x>two <i>in</i> tail</x>\n<y/>\n<x z="&lt;">three</x>\n</r>'
    units = list(trees.xml_units(text, "a.xml"))
    assert shown(units) == [("/r/x[1]", "one k='1'"), ("/r/x[2]", "two"), ("/r/x[2]/i[1]", "in"), ("/r/x[3]", "three z='<'")]
    # A hint stays at its match: the second x repeats the first one's line; another name in between moves it on.
    assert [u["locator"]["line"] for u in units] == [2, 2, 3, 5]


def page(model):
    c = zlib.compressobj(wbits=-15)
    return base64.b64encode(c.compress(urllib.parse.quote(model).encode()) + c.flush()).decode()


def test_drawio_pages_labels_and_ends():
    model = (
        "<mxGraphModel><root><mxCell id='a' value='&lt;b&gt;Big &lt;i&gt;shop&lt;/i&gt;&lt;/b&gt;&amp;nbsp;one'/><mxCell id='b' value=' '/>"
        "<mxCell id='e' source='a' target='b'/><mxCell id='f' value='to' target='a'/></root></mxGraphModel>"
    )
    want = ["Big shop one", "Big shop one -> b", "to: ? -> Big shop one"]
    cut = base64.b64encode(zlib.compress(b"x")).decode()
    text = f"<mxfile><diagram>{page(model)}</diagram><diagram>no base64!</diagram><diagram>{cut}</diagram><diagram>{model}</diagram></mxfile>"
    units = list(trees.drawio_units(text, "a.drawio"))
    assert [u["text"] for u in units] == want * 2
    assert [u["locator"]["path"] for u in units][::3] == ["/diagram[1]/mxCell[@id='a']", "/diagram[2]/mxCell[@id='a']"]
    assert [u["text"] for u in trees.drawio_units(model, "a.drawio")] == want
    assert units[2]["meta"] == {"page": 1, "edge_from": "", "edge_to": "Big shop one", "edge_label": "to"}


def test_html_blocks_come_in_end_tag_order():
    text = "lost<ul><li>a <p>in\n<b>ner</b></p> b</li></ul><p>open <h2>x&amp;y</h2><script><p>no</p></script><td>c</td>"
    assert shown(trees.html_units(text, "a.html")) == [((1, 2), "in ner"), ((1, 2), "a b"), ((2, 2), "x&y"), ((2, 2), "c")]


def test_svg_repeats_inner_text():
    text = "<svg xmlns='http://www.w3.org/2000/svg'><title> t </title><text>a <tspan>b</tspan></text><desc/></svg>"
    assert shown(trees.svg_units(text, "a.svg")) == [("/svg/title[1]", "t"), ("/svg/text[2]", "a b"), ("/svg/tspan[3]", "b")]


def test_notebooks_that_are_none():
    for bad in ("{", '{"cells": 1}', "{}"):
        with pytest.raises(trees.Degraded):
            list(trees.notebook_units(bad, "n.ipynb"))
    with pytest.raises(AttributeError):
        list(trees.notebook_units("[1]", "n.ipynb"))


MARKDOWN = "before\n# One\n```\n# no heading\n```\n### Deep\ntext\n## Two\n" + "long line of words\n" * 300 + "# Last\n```\n# swallowed\n"


def test_markdown_sections(spark):
    df = spark.createDataFrame([(MARKDOWN,), ("",), ("\n \n",), ("plain",)], "t string")
    rows = [r[0] for r in df.select(native.markdown_units(F.col("t"))).collect()]
    got = [(u["locator"]["start"], u["locator"]["end"], dict(u["meta"]).get("heading_trail")) for u in rows[0]]
    assert got[:3] == [(1, 1, None), (2, 5, "One"), (6, 7, "One > Deep")] and got[-1] == (309, 311, "Last")
    assert {g[2] for g in got[3:-1]} == {"One > Two"} and [g[0] for g in got[3:-1]][0] == 8 and len(got[3:-1]) > 1
    assert all(len(u["text"]) <= fixed.MAX_CHARS for u in rows[0]) and rows[1] == [] and rows[2] == [] and len(rows[3]) == 1


def test_failures_cost_their_document_only(spark):
    files = [
        (1, "json", "a.json", b"{"), (2, "toml", "a.toml", b"d = 2020-01-02"), (3, "notebook", "n.ipynb", b"[1]"), (4, "pdf", "a.pdf", b"%PDF"),
        (5, "json", "b.json", b'"\\ud800"'), (6, "text", "a.txt", b"\xef\xbb\xbfbom\n"), (7, "csv", "a.csv", b"\xff,b\n"),
    ]
    df = spark.createDataFrame([(i, e, p, bytearray(c)) for i, e, p, c in files], "document_id long, extractor string, path string, content binary")
    got = {r["document_id"]: r for r in finished_units(extract(df)).collect()}
    assert {i: (r["status"], r["reason"]) for i, r in got.items()} == {
        1: ("degraded", "degraded_parse"), 2: ("failed", "extractor_error"), 3: ("failed", "extractor_error"), 4: ("skipped", "missing_dependency"),
        5: ("failed", "extractor_error"), 6: ("ok", ""), 7: ("ok", ""),
    }
    assert got[1]["degraded"].startswith("JSONDecodeError") and got[1]["units"][0]["text"] == "{"
    assert got[6]["units"][0]["text"] == "bom" and got[7]["units"][0]["text"] == "�,b"


def test_unreadable_file_is_a_read_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("here\n")
    rows = [("file", str(i), p, 5, str(tmp_path / p), "", None) for i, p in enumerate(("a.txt", "gone.txt"))]
    store = Store(spark, str(tmp_path / "store"))
    ingest_entries(spark, spark.createDataFrame(rows, ENTRY), store, "c", "u")
    got = {r["path"]: (r["outcome"], r["reason"], r["document_id"] is None) for r in store.table("ingest_events").collect()}
    assert got == {"a.txt": ("extracted", "", False), "gone.txt": ("failed", "read_error", True)}
    assert store.table("documents").count() == 1


def test_table_function_in_sql(spark):
    rows = [(1, "a.json", b'{"a": [1]}'), (2, "b.json", b"{"), (3, "c.json", None), (4, "d.json", b"3"), (5, None, b'"\xff"')]
    docs = spark.createDataFrame([(i, p, None if c is None else bytearray(c)) for i, p, c in rows], "id long, path string, content binary")
    register_units(spark)
    call = "SELECT id, u.* FROM {docs}, LATERAL read_units('json', path, content) AS u"
    found = spark.sql(call, docs=docs)
    assert found.columns == ["id", "ordinal", "status", "detail", "node", "line", "text", "verbatim", "meta"]
    got = {r["id"]: r for r in found.collect()}
    assert sorted(got) == [1, 2, 4, 5] and got[1]["text"] == json.dumps({"a": [1]}, indent=2) and got[1]["meta"] == {"pointer": "/"}
    assert got[2]["status"] == "degraded" and got[2]["text"] is None and got[2]["detail"].startswith("JSONDecodeError")
    assert got[4]["text"] == "3" and got[5]["text"] == '"\ufffd"'
    as_text = spark.sql("SELECT id, u.text FROM {docs}, LATERAL read_units('json', path, cast(content AS string)) AS u WHERE id < 5", docs=docs)
    assert sorted((r["id"], r["text"]) for r in as_text.collect()) == [(i, got[i]["text"]) for i in (1, 2, 4)]
    with pytest.raises(Exception, match="must be a constant"):
        spark.sql("SELECT * FROM {docs}, LATERAL read_units(path, path, content) AS u", docs=docs).collect()
    assert "start_line" in spark.sql("SELECT u.* FROM {docs}, LATERAL read_units('html', path, content) AS u", docs=docs).columns


def test_table_function_knows_registered_readers(spark, monkeypatch):
    monkeypatch.setattr("spanstore.operators.table_function.READERS", [Reader("halves", (), (".half",), read=lambda t, p: [{"locator": {"kind": "page", "number": 1}, "text": h, "verbatim": True, "meta": {"n": n}} for n, h in enumerate(t.split("|"))])])
    register_units(spark, "read_halves")
    got = spark.sql("SELECT ordinal, kind, node, text, meta FROM VALUES ('x|y') AS t(c), LATERAL read_halves('halves', 'a.half', c)").collect()
    assert [tuple(r) for r in sorted(got)] == [(0, "page", None, "x", {"n": "0"}), (1, "page", None, "y", {"n": "1"})]
