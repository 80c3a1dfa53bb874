"""End to end over a mixed tree: one event per entry, reruns, edits, citations."""

import base64
import json
import os
import urllib.parse
import zlib

import pytest
from pyspark.sql import functions as F

from spanstore.cli import main
from spanstore.functions import locators
from spanstore.operators import extract
from spanstore.plans import ledger, query
from spanstore.plans.ingest import ingest
from spanstore.plans.store import BUCKETED, SCHEMAS, Store, StoreError
from spanstore.sources.workspace import Workspace


def deflated(text: str) -> str:
    c = zlib.compressobj(wbits=-15)
    raw = c.compress(urllib.parse.quote(text).encode()) + c.flush()
    return base64.b64encode(raw).decode()


MODEL = (
    "<mxGraphModel><root><mxCell id='a' value='Shop'/><mxCell id='b' value='&lt;b&gt;Store&lt;/b&gt;'/>"
    "<mxCell id='c' value='Log'/><mxCell id='e' value='writes' source='a' target='b'/><mxCell id='f' source='b' target='zz'/></root></mxGraphModel>"
)
FILES = {
    "one/README.md": "# Head\n\nintro\n\n## Next\n\nmore\n",
    "one/app/run.py": "def go():\n    return 1\n",
    "one/requirements.txt": "x==1\n",
    "one/docker-compose.yml": "services: {}\n",
    "one/.env": "DB=postgres://me:hunter22@db/x\n",
    "one/node_modules/dep/index.js": "x",
    "two/src/a.ts": "const a = 1;\n",
    "two/package.json": '{"name": "two"}',
    "two/package-lock.json": "{}",
    "two/broken.json": '{"name": ',
    "docs/flow.drawio": f"<mxfile><diagram>{deflated(MODEL)}</diagram></mxfile>",
    "docs/page.html": "<html><body><h1>T</h1>\n<p>one</p><p>two\nlines</p><script>x()</script></body></html>",
    "docs/t.csv": 'a,b\n1,"x\ny"\n2,z\n',
    "docs/g.mmd": "graph TD\n  A-->B\n  B -->|yes| C\n",
    "docs/scan.png": b"\x89PNG\x00\x00",
    "docs/paper.pdf": b"%PDF-1.4\x00",
    "vendor/lib.min.js": "var a",
    "empty.txt": "",
    "n.ipynb": json.dumps({"cells": [{"cell_type": "markdown", "source": ["# hi\n", "there"]}]}),
    "blob.bin": b"\x00\x01\x02",
}


@pytest.fixture(scope="module")
def site(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    workspace = Workspace.resolve(str(tmp_path_factory.mktemp("ws")))
    runs = [ingest(spark, str(root), workspace)]
    first = {n: Store(spark, workspace.tables).table(n).count() for n in ("text_units", "blobs", "documents", "document_versions")}
    runs.append(ingest(spark, str(root), workspace))
    return root, workspace, Store(spark, workspace.tables), runs, first


def by_path(store, run):
    rows = store.table("ingest_events").filter(F.col("run_id") == run.id).collect()
    assert len({r["path"] for r in rows}) == len(rows)
    return {r["path"]: r for r in rows}


def test_one_event_per_entry(site):
    root, _, store, runs, _ = site
    got = by_path(store, runs[0])
    entries = {n for n in FILES if "node_modules" not in n} | {"one/node_modules"}
    assert set(got) == entries
    expect = {
        "one/node_modules": ("skipped", "pruned_directory"), "empty.txt": ("skipped", "empty_file"), "vendor/lib.min.js": ("skipped", "low_relevance"),
        "two/package-lock.json": ("skipped", "low_relevance"), "docs/scan.png": ("skipped", "missing_dependency"),
        "docs/paper.pdf": ("skipped", "missing_dependency"), "two/broken.json": ("extracted", "degraded_parse"), "blob.bin": ("skipped", "binary"),
    }
    for name in entries:
        assert (got[name]["outcome"], got[name]["reason"]) == expect.get(name, ("extracted", "")), name
    units = {n: got[n]["units"] for n in got}
    assert units["one/README.md"] == 2 and units["docs/flow.drawio"] == 5 and units["docs/page.html"] == 3
    assert units["docs/t.csv"] == 1 and units["docs/g.mmd"] == 3 and units["n.ipynb"] == 1


def test_rerun_extracts_nothing(site):
    _, _, store, runs, first = site
    again = by_path(store, runs[1])
    assert not [r for r in again.values() if r["outcome"] == "extracted"]
    assert {n: store.table(n).count() for n in first} == first


def test_order_follows_the_walk(site):
    _, _, store, runs, _ = site
    rows = ledger.events(store.table("ingest_events"), runs[0].id).collect()
    paths = [r["path"] for r in rows]
    assert paths[:3] == ["blob.bin", "empty.txt", "n.ipynb"] and paths.index("one/node_modules") < paths.index("one/.env")


def test_secrets_and_find(site):
    _, _, store, _, _ = site
    units, docs = store.table("text_units"), store.table("documents")
    flagged = query.sensitive_units(units, docs).collect()
    assert [(r["path"], r["sensitivity"], r["sensitivity_labels"]) for r in flagged] == [("one/.env", "secret", ["connection_string"])]
    assert [r["text"] for r in query.find_units(units, docs, "WRITES").collect()] == ["writes: Shop -> Store"]


def test_citations_open_the_bytes(site):
    _, _, store, _, _ = site
    units, blobs = store.table("text_units"), store.table("blobs")
    assert query.verify_all(units, blobs).count() == 0
    assert query.verify_blobs(blobs).filter("not intact").count() == 0
    node = query.resolve(units.filter("locator.kind = 'node'"), blobs).first()
    assert node["exact"] is False and node["resolved"] == node["text"] and node["note"]


def test_edit_and_return(site, spark):
    root, workspace, store, _, first = site
    path = root / "one/requirements.txt"
    old = path.read_text()
    path.write_text("y==2\n")
    run = ingest(spark, str(root), workspace)
    assert {p for p, r in by_path(store, run).items() if r["outcome"] == "extracted"} == {"one/requirements.txt"}
    assert store.table("document_versions").count() == first["document_versions"] + 1
    path.write_text("   \n")
    ingest(spark, str(root), workspace)
    doc = store.table("documents").filter("path = 'one/requirements.txt'").first()
    assert store.table("text_units").filter(F.col("document_id") == doc["id"]).count() == 0
    path.write_text(old)
    ingest(spark, str(root), workspace)
    assert store.table("document_versions").count() == first["document_versions"] + 2
    assert store.table("text_units").count() == first["text_units"]


def test_pasted_text_and_cli(spark, tmp_path, capsys):
    text = "A note that is long enough.\nmail me at who@example.org\n"
    assert main(["--root", str(tmp_path), "ingest", text], spark) == 0
    assert "extracted=1" in capsys.readouterr().out
    for command in (["runs"], ["ledger"], ["gaps"], ["find", "NOTE"], ["doctor"], ["stats"]):
        assert main(["--root", str(tmp_path), *command], spark) == 0
    out = capsys.readouterr().out
    assert "pegado.txt · lines 1-2" in out and "sensitive\t1" in out
    unit = Store(spark, Workspace.resolve(str(tmp_path)).tables).table("text_units").first()["id"]
    assert main(["--root", str(tmp_path), "show", unit], spark) == 0
    assert "identical to the bytes" in capsys.readouterr().out
    assert main(["--root", str(tmp_path), "ingest", "/no/such/path"], spark) == 1
    assert "does not exist" in capsys.readouterr().err


def test_git_source(spark, tmp_path):
    import subprocess

    repo = tmp_path / "origin"
    repo.mkdir()
    run = lambda *a: subprocess.run(["git", "-c", "user.name=t", "-c", "user.email=t@t", *a], cwd=repo, check=True, capture_output=True)
    run("init", "-q")
    (repo / "a.md").write_text("# a\n")
    run("add", ".")
    run("commit", "-qm", "one")
    workspace = Workspace.resolve(str(tmp_path / "ws"))
    ingest(spark, str(repo), workspace, "git")
    store = Store(spark, workspace.tables)
    got = {r["path"]: r["outcome"] for r in store.table("ingest_events").collect()}
    assert got == {".git": "skipped", "a.md": "extracted"}
    assert store.table("sources").first()["label"] == "origin"
    assert len(store.table("sources").first()["revision"]) == 40
    assert os.path.isdir(workspace.clones)


def test_links_and_big_folders_are_walked_in_order(spark, tmp_path, monkeypatch):
    from spanstore.sources import tree

    for i in range(6):
        (tmp_path / "big" / f"d{i}" / "deep").mkdir(parents=True)
        (tmp_path / "big" / f"d{i}" / "deep" / f"f{i}.txt").write_text("x")
    (tmp_path / "big" / ".git").mkdir()
    (tmp_path / "link").symlink_to(tmp_path / "big")
    want = None
    for parts in (1, 4, 128):
        monkeypatch.setattr(tree, "PARTITIONS", parts)
        got = [(r["entry_kind"], r["path"]) for r in tree.read_tree(spark, str(tmp_path)).orderBy("seq").collect()]
        want = want or got
        assert got == want
    assert want == [("pruned", "big/.git"), *(("file", f"big/d{i}/deep/f{i}.txt") for i in range(6))]


def test_store_refuses_what_breaks_a_constraint(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    blank = lambda name: spark.createDataFrame([], SCHEMAS[name])
    sha = "a" * 64
    row = lambda name, **v: blank(name).unionByName(spark.createDataFrame([tuple(v.values())], ", ".join(f"{k} {blank(name).schema[k].dataType.simpleString()}" for k in v)), allowMissingColumns=True)
    blob = row("blobs", sha256=sha, size=1, shard="aa")
    source = row("sources", id="s", connector="c", uri="u")
    document = row("documents", id="d", source_id="s", path="p", blob_sha=sha, relevance=1)
    store.commit({"blobs": blob, "sources": source, "documents": document})
    before = store.parts()
    unit = dict(id="u", document_id="d", blob_sha=sha, locator_json="{}", char_count=1, sensitivity="none")
    for name, bad in (
        ("blobs", row("blobs", sha256="short", size=1, shard="sh")),
        ("blobs", blob),  # stands already
        ("documents", row("documents", id="e", source_id="nobody", path="p", blob_sha=sha, relevance=1)),
        ("documents", row("documents", id="e", source_id="s", path="p", blob_sha="b" * 64, relevance=1)),
        ("documents", document.unionByName(document)),
        ("document_versions", row("document_versions", document_id="x", blob_sha=sha)),
        ("text_units", row("text_units", **{**unit, "char_count": 0})),
        ("text_units", row("text_units", **{**unit, "document_id": "x"})),
        ("text_units", row("text_units", **{**unit, "blob_sha": "b" * 64})),
        ("text_units", row("text_units", **{**unit, "sensitivity": "other"})),
        ("ingest_events", row("ingest_events", run_id="r", path="p", outcome="skipped")),
    ):
        with pytest.raises(StoreError):
            store.commit({name: bad}, {name: store.rewrite(name, store.touched(name, bad.select(BUCKETED[name])))} if name in BUCKETED else None)
        assert store.parts() == before
    store.commit({"text_units": row("text_units", **unit)}, {"text_units": store.rewrite("text_units", store.touched("text_units", document.select("id")))})
    assert store.table("text_units").count() == 1 and store.table("documents").count() == 1


def test_lock_names_its_owner_and_can_be_broken(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    with store.writing():
        assert store.lock_owner()["pid"] == os.getpid()
        with pytest.raises(StoreError, match=str(os.getpid())), store.writing():
            pass
        store.break_lock()
        with store.writing():
            pass
    assert store.lock_owner() == {}


def test_an_edit_rewrites_few_buckets(site, spark):
    root, workspace, store, _, _ = site
    before = store.parts()
    path = root / "one/app/run.py"
    old = path.read_text()
    path.write_text("def stop():\n    return 2\n")
    ingest(spark, str(root), workspace)
    after = store.parts()
    assert len(set(after["text_units"]) - set(before["text_units"])) == 1
    path.write_text(old)
    ingest(spark, str(root), workspace)


def test_registered_reader_gets_its_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extract, "READERS", list(extract.READERS))

    def read(data, path):
        yield {"locator": {"kind": "page", "number": 1}, "text": f"{len(data)} bytes", "verbatim": False, "meta": {"pages": 1}}

    def fails(text, path):
        raise RuntimeError("no")

    extract.register(extract.Reader("pdf", ("application/pdf",), (".pdf",), read, binary=True))
    extract.register(extract.Reader("odd", (), (".odd",), fails))
    (tmp_path / "a.pdf").write_bytes(b"%PDF\xff\x00")
    (tmp_path / "b.odd").write_text("x")
    workspace = Workspace.resolve(str(tmp_path / "ws"))
    run = ingest(spark, str(tmp_path / "a.pdf"), workspace)
    other = ingest(spark, str(tmp_path / "b.odd"), workspace)
    store = Store(spark, workspace.tables)
    assert [r["text"] for r in store.table("text_units").collect()] == ["6 bytes"]
    assert by_path(store, run)["a.pdf"]["outcome"] == "extracted"
    failed = by_path(store, other)["b.odd"]
    assert (failed["outcome"], failed["reason"], failed["detail"]) == ("failed", "extractor_error", "RuntimeError: no")
    assert extract.availability(spark).filter("name = 'pdf'").first()["available"]


def test_byte_spans_and_new_locator_kinds(spark, monkeypatch):
    monkeypatch.setattr(locators, "KINDS", dict(locators.KINDS))
    locators.register_kind("frame", ["number", "path"])
    frame = locators.locator("frame", number=F.lit(7), path=F.lit("clip"))
    got = spark.range(1).select(locators.canonical_json(frame), locators.is_valid(frame), locators.label(frame)).first()
    assert tuple(got) == ('{"kind":"frame","number":7,"path":"clip"}', True, "frame")
    with pytest.raises(ValueError):
        locators.register_kind("bad", ["nowhere"])
    blobs = spark.createDataFrame([("s", bytearray("aé\nb".encode()))], "sha256 string, content binary")
    spans = [(0, 1, "a", None), (1, 3, "é", None), (3, 99, "\nb", None), (1, 2, "\ufffd", None), (5, 6, None, "past")]
    units = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(spans)], "id int, a long, b long")
    units = units.select("id", F.lit("s").alias("blob_sha"), F.lit("t").alias("text"), locators.locator("bytes", start=F.col("a"), end=F.col("b")).alias("locator"))
    rows = query.resolve(units, blobs).orderBy("id").collect()
    for row, (_, _, text, error) in zip(rows, spans):
        assert row["resolved"] == text and row["exact"] == (error is None) and (error is None or error in row["error"])
