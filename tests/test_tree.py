"""The tree source's pushed conditions and stream, the blob sink, lookups and edits that touch little."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from spanstore.plans.ingest import ingest
from spanstore.plans.store import BLOOM, SCHEMAS, Store, StoreError, shared_folder
from spanstore.sources import tree
from spanstore.sources.sink import BlobSink, BlobWriter
from spanstore.sources.workspace import Workspace
from spanstore.streaming.batches import ingest_tree_stream

FILES = {
    "docs/a.md": "# a\n", "docs/deep/b.txt": "bb\n", "docs/deep/empty.txt": "", "docs.txt": "d\n", "src/x.py": "x = 1\n", "src/node_modules/y.js": "y",
    "src/lib/z.py": "z = 22222\n", "img/p.png": b"\x89PNG\x00",
}


def grown(root):
    for name, text in FILES.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(root)


CONDITIONS = [
    [("path", "startswith", "docs/")],
    [("path", "startswith", "docs")],
    [("path", "=", "src/lib/z.py")],
    [("entry_kind", "=", "pruned")],
    [("entry_kind", "=", "file"), ("size", ">", 0), ("size", "<=", 4)],
    [("size", "<", 4), ("path", "startswith", "src/")],
    [("path", "startswith", "no/such")],
    [("path", "startswith", "docs/"), ("path", "startswith", "docs/deep/"), ("size", ">=", 3)],
]


@pytest.mark.parametrize("where", CONDITIONS)
def test_conditions_are_decided_by_the_walk(spark, tmp_path, where):
    root = grown(tmp_path)
    whole = {r["path"]: r for r in tree.read_tree(spark, root).collect()}
    got = tree.read_tree(spark, root, where=where)
    assert " Filter (" not in got._jdf.queryExecution().executedPlan().toString()
    want = {p: r for p, r in whole.items() if all(tree._HOLDS[op](r[c], x) for c, op, x in where)}
    assert {r["path"]: r for r in got.collect()} == want


def test_other_folders_are_not_opened(tmp_path, monkeypatch):
    root, opened = grown(tmp_path), []
    listed = tree._listed
    monkeypatch.setattr(tree, "_listed", lambda folder: opened.append(os.path.relpath(folder, root)) or listed(folder))
    reader = tree._TreeReader(root, "", [("path", "startswith", "docs/")])
    assert list(reader.pushFilters([tree.StringStartsWith(("path",), "docs/"), tree.IsNotNull(("path",))])) == []
    rows = [row for part in reader.partitions() for row in reader.read(part)]
    assert {r[2] for r in rows} == {"docs/a.md", "docs/deep/b.txt", "docs/deep/empty.txt"}
    assert set(opened) == {".", "docs", "docs/deep"}


def test_scans_of_one_tree_do_not_disturb_each_other(spark, tmp_path):
    """What a later filter leaves out of one scan stays in the others."""
    df = tree.read_tree(spark, grown(tmp_path))
    counts = [df.count(), df.filter("entry_kind = 'file'").count(), df.count(), df.filter("size > 3").count(), df.count()]
    assert counts == [8, 7, 8, 4, 8]
    some = tree.read_tree(spark, str(tmp_path), where=[("path", "startswith", "src/")])
    assert [some.count(), some.filter("entry_kind = 'file'").count(), some.count()] == [3, 2, 3]


def test_only_a_part_of_a_tree(spark, tmp_path):
    root = grown(tmp_path / "t")
    workspace = Workspace.resolve(str(tmp_path / "ws"))
    ingest(spark, root, workspace, only="src/")
    store = Store(spark, workspace.tables)
    assert {(r["path"], r["outcome"]) for r in store.table("ingest_events").collect()} == {("src/node_modules", "skipped"), ("src/x.py", "extracted"), ("src/lib/z.py", "extracted")}
    assert not os.listdir(os.path.join(store.root, "staging"))


def test_stream_gives_what_has_changed(spark, tmp_path):
    root = tmp_path / "t"
    grown(root)
    store = Store(spark, str(tmp_path / "tables"))
    turn = lambda: ingest_tree_stream(spark, str(root), store, str(tmp_path / "ck")).awaitTermination()
    turn()
    events = lambda: store.table("ingest_events").groupBy("run_id").agg(F.sort_array(F.collect_list("path"))).collect()
    files = sorted(p for p in FILES if "node_modules" not in p)
    assert [r[1] for r in events()] == [files]
    (root / "src/x.py").write_text("x = 2\n")
    (root / "docs/new.txt").write_text("new\n")
    (root / "docs.txt").unlink()
    turn()
    assert sorted(r[1] for r in events()) == sorted([files, ["docs/new.txt", "src/x.py"]])
    turn()  # nothing has changed: no run
    assert len(events()) == 2
    assert store.table("text_units").filter("text = 'x = 2'").count() == 1 and store.table("documents").count() == len(files)


def test_listings_are_kept_while_needed(tmp_path):
    root = tmp_path / "t"
    grown(root)
    reader = tree._TreeStreamReader(str(root), "", str(tmp_path / "listings"))
    one = reader.latestOffset()
    assert reader.latestOffset() == one
    (root / "docs.txt").write_text("other\n")
    two = tree._TreeStreamReader(str(root), "", str(tmp_path / "listings")).latestOffset()
    assert two["listing"] > one["listing"]
    changed = lambda a, b: [r[2] for p in reader.partitions(a, b) for r in reader.read(p)]
    assert changed(one, two) == ["docs.txt"] and len(changed(reader.initialOffset(), one)) == 7
    reader.commit(two)
    assert os.listdir(tmp_path / "listings") == [two["listing"]]


def blob_rows(spark, n=40):
    rows = spark.range(n).select(F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    return rows.select(F.sha2("content", 256).alias("sha256"), "content").withColumn("shard", F.substring("sha256", 1, 2))


def test_sink_publishes_whole_writes(spark, tmp_path):
    spark.dataSource.register(BlobSink)
    where = str(tmp_path / "blobs")
    blob_rows(spark).repartition(3).sortWithinPartitions("shard").write.format("blobs").option("path", where).mode("append").save()
    read = spark.read.schema("sha256 string, content binary, shard string").parquet(where)
    assert {tuple(r) for r in read.collect()} == {tuple(r) for r in blob_rows(spark).select("sha256", "content", "shard").collect()}
    assert all(d.startswith("shard=") for d in os.listdir(where))

    def failing(batches):
        for batch in batches:
            yield batch
            if batch.num_rows:
                raise RuntimeError("lost")

    bad = blob_rows(spark, 90).filter("length(content) = 2").repartition(2).mapInArrow(failing, "sha256 string, content binary, shard string")
    with pytest.raises(Exception, match="lost"):
        bad.write.format("blobs").option("path", where).mode("append").save()
    assert all(d.startswith("shard=") for d in os.listdir(where)) and read.count() == 40


def test_a_killed_task_leaves_nothing_visible(spark, tmp_path):
    where = str(tmp_path / "blobs")
    batch = blob_rows(spark).sort("shard").toArrow().to_batches()
    writer = BlobWriter(where)
    writer.write(iter(batch))  # its message never arrives
    read = lambda: spark.read.schema("sha256 string, content binary, shard string").parquet(where)
    assert read().count() == 0
    writer.commit([writer.write(iter(batch)), None])
    assert read().count() == 40 and not [d for d in os.listdir(where) if d.startswith("_")]


def test_a_unit_is_found_in_few_rows(spark, tmp_path):
    """Row groups that cannot hold the id are skipped, and one bucket is read."""
    store = Store(spark, str(tmp_path))
    blank = lambda name: spark.createDataFrame([], SCHEMAS[name])
    sha = "a" * 64
    filled = lambda name, df: blank(name).unionByName(df, allowMissingColumns=True)
    docs = spark.range(400).select(F.concat(F.lit("d"), "id").alias("id"), F.lit("s").alias("source_id"), F.concat(F.lit("p"), "id").alias("path"), F.lit(sha).alias("blob_sha"), F.lit(1).alias("relevance"))
    units = spark.range(4000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("id"), F.concat(F.lit("d"), F.col("id") % 400).alias("document_id"), F.lit(sha).alias("blob_sha"),
        F.lit("{}").alias("locator_json"), F.lit(1).alias("char_count"), F.lit("none").alias("sensitivity"),
    )
    store.commit(
        {
            "blobs": filled("blobs", spark.createDataFrame([(sha, 1, "aa")], "sha256 string, size long, shard string")),
            "sources": filled("sources", spark.createDataFrame([("s", "c", "u")], "id string, connector string, uri string")),
            "documents": filled("documents", docs), "text_units": filled("text_units", units),
        }
    )
    assert BLOOM["text_units"]
    wanted = units.filter("document_id = 'd7'").first()["id"]

    def rows_scanned(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        leaf = plan.collectLeaves().head()
        return leaf.metrics().get("numOutputRows").get().value()

    assert rows_scanned(store.table("text_units").filter(F.col("id") == wanted)) <= 400
    found, documents, blobs = store.of_unit(wanted)
    assert [r["document_id"] for r in found.collect()] == ["d7"] and [r["path"] for r in documents.collect()] == ["p7"] and blobs.count() == 1
    assert rows_scanned(found) <= 400
    assert [df.count() for df in store.of_unit("nothing")] == [0, 0, 0]


@pytest.mark.parametrize("attempt", range(2))
def test_reruns_and_edits_rewrite_what_they_touch(spark, tmp_path, attempt):
    """Whatever the root, and so the ids: files that never gave units are tried again but touch no bucket."""
    root = tmp_path / f"tree{attempt}"
    grown(root)
    for i in range(6):
        (root / f"scan{i}.pdf").write_bytes(b"%PDF\x00")
        (root / f"blank{i}.txt").write_text("  \n")
    workspace = Workspace.resolve(str(tmp_path / "ws"))
    ingest(spark, str(root), workspace)
    store = Store(spark, workspace.tables)
    first = store.parts()["text_units"]
    ingest(spark, str(root), workspace)
    assert store.parts()["text_units"] == first
    (root / "src/x.py").write_text("x = 3\n")
    ingest(spark, str(root), workspace)
    assert len(set(store.parts()["text_units"]) - set(first)) == 1


def test_other_schemes_are_refused():
    session = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://host/x"})
    with pytest.raises(StoreError, match="hdfs"):
        shared_folder(session)
