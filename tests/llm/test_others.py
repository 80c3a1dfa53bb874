"""Top-k search, HTML extraction and the pipeline."""

import html.parser
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from spanstore.llm import html_text, textgrams, topk_search
from spanstore.llm.registry import QUERIES


def brute_top(rows, k=10):
    vectors = {i: np.floor(np.asarray(v, float) * 1024).astype(np.int64) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = set()
    for q in (i for i in vectors if i % 100 == 0):
        scored = []
        for i, v in vectors.items():
            if i != q:
                n = min(len(v), len(vectors[q]))
                scored.append((-int(v[:n] @ vectors[q][:n]), i))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = df.select("vec_id", topk_search.quantized(F.col("embedding")).alias("v")).filter("v is not null")
    return {tuple(r) for r in topk_search.top_k(v, v.filter("vec_id % 100 = 0")).select("query_id", "rank", "vec_id", "score").collect()}


def test_top_k_on_odd_vectors(spark):
    r = np.random.default_rng(7)
    rows = [(i, [float(x) for x in r.normal(size=6)]) for i in range(320)]
    rows += [(400 + i, [0.5] * 6) for i in range(40)]
    rows += [(1000, None), (1001, [None] * 6), (1100, [float("nan")] * 6), (1200, [float("inf")] + [0.0] * 5), (1300, [1.0, 2.0]), (1301, [])]
    assert found(spark, rows) == brute_top(rows)
    assert found(spark, rows[:4]) == brute_top(rows[:4])
    assert found(spark, []) == set()


def test_top_k_on_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {tuple(r) for r in QUERIES["op4_topk"](spark, data).collect()}
    assert got == brute_top(rows)


def test_cover_tree_covers():
    points = np.random.default_rng(3).normal(size=(600, 5))
    tree = topk_search.CoverTree(points)
    for i, rows in enumerate(tree.rows):
        far = np.sqrt(((points[rows] - points[tree.center[i]]) ** 2).sum(axis=1))
        assert far.max() <= tree.radius[i] + 1e-9
        if len(tree.kids[i]):
            assert sorted(np.concatenate([tree.rows[k] for k in tree.kids[i]])) == sorted(rows)
            assert all(tree.radius[k] <= tree.radius[i] / topk_search.BASE + 1e-9 for k in tree.kids[i])


PAGES = [
    (None, None),
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>a</div><div>b <b>c</b></div>", "a\nb c"),
    ("<ul><li>x<li>y<ol><li>p<li>q</ol></ul>z", "- x\n- y\n  1. p\n  2. q\n\nz"),
    ("<ol start=4><li>x<li value=9>y<li>z</ol>", "4. x\n9. y\n10. z"),
    ("<table><tr><th>Name<th>N<tr><td>Long name<td>1<tr><td>b</table>", "Name       N\nLong name  1\nb"),
    ("a<script>if (1 < 2) x()</script><style>p{}</style>b", "ab"),
    ("<p hidden>no</p><p style='display: NONE'>no</p><span style=visibility:hidden>no</span>yes", "yes"),
    ("<head><title>t</title></head><body>in</body>", "in"),
    ("<head><title>t</title>Hello world", "Hello world"),
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C<tr><td>D<td>E</table>", "A  B\n   C\nD  E"),
    ("<table><tr><td>a<td rowspan=2 colspan=2>b<td>c<tr><td>d<td>e</table>", "a  b    c\nd       e"),
    ("<pre><div>x  y</div>z  w</pre>", "x  y\nz  w"),
    ("<pre>a  b<ul><li>c  d</ul></pre>", "a  b\n\n- c  d"),
    ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no<img alt=no></div>", "yes"),
    ("<pre>a\n  b</pre>", "a\n  b"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<!-- gone -->x<!DOCTYPE html>", "x"),
    ("1 < 2 <b", "1 < 2 <b"),
    ("<div>" * 500 + "deep", "deep"),
    ("<b>un<i>closed</b> tail", "unclosed tail"),
    ("a <img alt='pic'> b<hr>c", "a pic b\n\n---\n\nc"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_page_text(page, text):
    assert html_text.page_text(page) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc <>&é\n", max_size=30), max_size=6))
def test_visible_words_survive(paragraphs):
    from html import escape

    page = "".join(f"<p>{escape(p)}<script>{'x' * len(p)}</script>" for p in paragraphs)
    assert html_text.page_text(page).split() == " ".join(paragraphs).split()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/abpdivtrl=\"' !-&;\n", max_size=120))
def test_any_input_gives_text(page):
    assert isinstance(html_text.page_text(page), str)


def test_extract_pages(spark):
    rows = [(i, "u", p, "extra") for i, (p, _) in enumerate(PAGES)]
    out = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert {r["page_id"]: r["text"] for r in out} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, seen = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"] for r in seen.select("doc_id").collect()}
        seen = corpus_pipeline.stored(stage(spark, seen, data))
        assert {r["doc_id"] for r in seen.select("doc_id").collect()} <= before
        if name != corpus_pipeline.STAGES[-1][0]:
            assert seen.columns == columns
    assert {tuple(r) for r in corpus_pipeline.run(spark, data).collect()} == {tuple(r) for r in seen.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]


ODD_TABLES = [
    ("<table><tr><form><td>a</td><td>b</td></form></tr></table>", "a  b"),
    ("<table><tr>text<td>a</table>", "text\na"),
    ("<table><tr><p>text</p><td>a</td></tr></table>", "text\na"),
    ("<table>text<tr><td>a</td></tr>tail</table>", "text\ntail\na"),
    ("<table><tbody>one <b>two</b><tr><td>a</table>", "one two\na"),
    ("<table><caption>c</caption><form><tr><td>a<td>b</tr></form><tr><td>d</table>", "c\na  b\nd"),
    ("<table><td>a<td>b</table>", "a  b"),
    ("<table><tr><div><p>x<td>a<td><table><tr>in<td>n</table></div></table>", "x\na  in n"),
    ("<table><tr><form hidden><td>a</form><td>b</table>", "a  b"),
    ("<table><tr><div hidden>no<td>a</table><table><tr hidden><td>no</table>", "a"),
]


@pytest.mark.parametrize("page, text", ODD_TABLES)
def test_tables_lose_no_text(page, text):
    assert html_text.page_text(page) == text


SHOWN = [
    ("<p>Pick <select><option>a<option selected>b<option>c</select> now</p>", "Pick b now"),
    ("<select><optgroup disabled><option>a</optgroup><option disabled>b<option>c</select>", "c"),
    ("<select multiple><option>a<option>b</select>", "a b"),
    ("x<textarea>\ny &lt; <b></textarea>z", "x y < <b> z"),
    ("<svg><title>no</title><desc/><g/><text>a <tspan>b</tspan></text><text>c</text><text><![CDATA[1>2]]></text></svg>d", "a b c 1>2 d"),
    ("<math><mi>x</mi><annotation>no</annotation></math>", "x"),
    ("<p>a<object data=x><param name=y><p>fall</p>back</object>", "a\n\nfall\n\nback"),
    ("<map name=m><area href=x>in map</map>", "in map"),
    ("<noscript>no</noscript><video>no</video><datalist><option>no</datalist>yes", "yes"),
    ('<a href="x"">text</a> <b title="y">more</b>', "text more"),
    ("<p title=it's>text</p><p>it's > here</p>", "text\n\nit's > here"),
    ("<a title = 'a > b' x='>'>text</a>", "text"),
    ("<input value=\"'q'\">", "'q'"),
]


@pytest.mark.parametrize("page, text", SHOWN)
def test_what_browsers_show_is_kept(page, text):
    assert html_text.page_text(page) == text


def test_time_grows_with_the_page():
    """Malformed pages of a megabyte end in seconds."""
    for piece in ("<b", "<p title='", "<!--", "<a b=", "<table><tr>", "<![CDATA[", "<td rowspan=9>", "< ", "&amp", "<textarea>", "<a ='", "<a b='>'"):
        began = time.monotonic()
        html_text.page_text(piece * (200_000 // len(piece)))
        assert time.monotonic() - began < 5, piece


def test_words_of_ordinary_pages_equal_another_parser(spark, data):
    """Every word that the standard library's parser finds outside of dropped elements stands in the text, in order."""

    class Words(html.parser.HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.words, self.off = [], 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("script", "style", "title", "noscript", "template")

        def handle_endtag(self, tag):
            self.off -= tag in ("script", "style", "title", "noscript", "template")

        def handle_data(self, words):
            self.words += [] if self.off else words.split()

    pages = spark.read.parquet(f"{data}/pages.parquet").select("html").limit(200).collect()
    for (page,) in pages:
        if page and "hidden" not in page and "<img" not in page and "<input" not in page and "<iframe" not in page:
            other = Words()
            other.feed(page)
            other.close()
            got = "".join(w for w in re.sub(r"(?m)^[ >]*(- |\d+\. )?", "", html_text.page_text(page)).split() if w != "---")
            assert got == "".join(other.words)


NUMBERS = [
    ('<ol start="²"><li>a</ol>', "1. a"), ('<ol><li value="³">a</ol>', "1. a"), ('<table><tr><td rowspan="²">a<td colspan="²">b</table>', "a  b"),
    ('<select size="²"><option>a<option>b</select>', "a"), (f"<ol><li value={'9' * 5000}>a</ol>", "1. a"), ("<ol start=-3><li>a<li>b</ol>", "-3. a\n-2. b"),
    ("<ol reversed><li>a<li>b</ol>", "2. a\n1. b"), ("<ol reversed start=5><li>a<li value=9>b<li>c</ol>", "5. a\n9. b\n8. c"),
    ("<details><summary>s</summary>hidden</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"), ("<table><tr><td colspan=3>a<td>b<tr><td>1<td>2<td>3<td>4</table>", "a        b\n1  2  3  4"),
    ("<table><tr><td colspan=1000>a<td>b</table>", "a" + " " * 80 + "b"), ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
]


@pytest.mark.parametrize("page, text", NUMBERS)
def test_numbers_of_attributes(page, text):
    assert html_text.page_text(page) == text


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(["start", "value", "rowspan", "colspan", "size", "reversed"]), st.text(max_size=12), st.integers(-(10**12), 10**12))
def test_any_attribute_value_keeps_the_words(name, said, number):
    from html import escape

    for value in (said, str(number)):
        a = f'{name}="{escape(value)}"'
        page = f"<ol {a}><li {a}>one</ol><table><tr><td {a}>two<td>three<tr><td>four</table>"
        words = html_text.page_text(page).split()
        assert [w for w in words if w in ("one", "two", "three", "four")] == ["one", "two", "three", "four"]


def test_text_grows_with_the_page():
    """Wide cells, spans and columns that only spans fill make no more text than a constant times the page."""
    long = "<table><tr><td>" + "x" * 16_000 + "<td>y" + "<tr><td>a<td>b" * 400 + "</table>"
    spans = "<table>" + "<tr><td colspan=100 rowspan=100>ab" * 3000 + "</table>"
    steep = "<table><tr>" + f"<td rowspan=60000>{'w' * 40}" * 300 + "<tr><td>z" * 4000 + "</table>"
    for page in (long, spans, steep, "<table>" + "<tr><td rowspan=0>a" * 10_000, "<table>" + "<tr><td rowspan=65534>a" * 10_000):
        began = time.monotonic()
        assert len(html_text.page_text(page)) < 12 * len(page)
        assert time.monotonic() - began < 5


def test_word_hashes_have_no_algebra():
    """Complementary Thue-Morse words collide under any polynomial modulo a power of two."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - b for b in bits]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    a, b = (textgrams.shingle_set(f"{w} x y z w") for w in (one, two))
    assert not set(a.tolist()) & set(b.tolist())
    assert (textgrams.word_hashes("Ab\tÉ ab") == textgrams.word_hashes("aB\nÉ\x0bAB")).all()


def test_huge_components_take_no_part(spark):
    rows = [(1, [1e300, 1.0]), (2, [1.0, 2.0]), (3, [2e6, 1.0]), (4, [0.5, 0.5]), (5, [1e9, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>").select("vec_id", topk_search.quantized(F.col("e")).alias("v"))
    kept = {r["vec_id"]: r["v"] for r in df.collect() if r["v"] is not None}
    assert kept == {2: [1024, 2048], 3: [2048000000, 1024], 4: [512, 512]}
    plain = sorted(((-sum(x * y for x, y in zip(kept[2], v)), i) for i, v in kept.items() if i != 2))
    got = topk_search.top_k(df.filter("v is not null"), df.filter("vec_id = 2"), 5)
    assert [(-r["score"], r["vec_id"]) for r in got.orderBy("rank").collect()] == plain


def test_scores_do_not_depend_on_the_number_of_cells(monkeypatch):
    from spanstore.llm import langid

    r = np.random.default_rng(1)
    model = langid.Model([f"l{i}" for i in range(7)], r.integers(0, 50, (7, langid.BUCKETS)), np.ones(7))
    texts = ["some words of text " * 20, "x", "andere Wörter"]
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "CELLS", 64)
    assert model.predict(texts)[0] == whole[0] and np.allclose(model.predict(texts)[1], whole[1])
