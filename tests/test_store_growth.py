"""Buckets grow by linear hashing: rows stay findable, edits stay cheap, large buckets are written by several tasks."""

import os

import pytest
from pyspark.sql import functions as F

from spanstore.plans import store as st
from spanstore.plans.ingest import ingest
from spanstore.sources.workspace import Workspace

SHA = "a" * 64


def documents(spark, ids):
    rows = ids.select(
        F.concat(F.lit("d"), "id").alias("id"), F.lit("s").alias("source_id"), F.concat(F.lit("p"), "id").alias("path"), F.lit(SHA).alias("blob_sha"), F.lit(1).alias("relevance")
    )
    return spark.createDataFrame([], st.SCHEMAS["documents"]).unionByName(rows, allowMissingColumns=True)


def upsert(store, rows):
    """Commits documents and tells the buckets and the bytes it wrote."""
    spark = store.spark
    changes = {}
    if "blobs" not in store.parts():
        filled = lambda name, row, names: spark.createDataFrame([], st.SCHEMAS[name]).unionByName(spark.createDataFrame([row], names), allowMissingColumns=True)
        changes["blobs"] = filled("blobs", (SHA, 1, "aa"), "sha256 string, size long, shard string")
        changes["sources"] = filled("sources", ("s", "c", "u"), "id string, connector string, uri string")
    before = set(store.parts().get("documents", []))
    at = store.rewrite("documents", store.touched("documents", rows.select("id")))
    store.commit({**changes, "documents": st.merge_rows(store.table("documents", at.buckets), rows)}, {"documents": at})
    fresh = set(store.parts()["documents"]) - before
    return at, fresh, sum(st.bytes_below(os.path.join(store.root, p)) for p in fresh)


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 11, 64, 100])
def test_one_more_bucket_takes_rows_of_one_bucket_only(spark, width):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    moved = keys.select(st.bucket_of(F.col("k"), width).alias("a"), st.bucket_of(F.col("k"), width + 1).alias("b")).distinct().collect()
    assert {r["a"] for r in moved} <= set(range(width)) and {r["b"] for r in moved} <= set(range(width + 1))
    assert all(r["a"] == r["b"] or (r["b"] == width and r["a"] == st.origin(width, width)) for r in moved)


def test_rows_stay_findable_while_buckets_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKETS", 2)
    monkeypatch.setattr(st, "BUCKET_BYTES", 6000)
    store = st.Store(spark, str(tmp_path))
    widths = []
    for n in range(7):
        rows = documents(spark, spark.range(n * 30, n * 30 + (30 if n < 5 else 1)))
        upsert(store, rows)
        widths.append(store.width("documents"))
    assert widths == sorted(widths) and widths[-1] > widths[0] >= 2
    total = store.table("documents")
    assert sorted(r["id"] for r in total.select("id").collect()) == sorted(f"d{i}" for n in range(7) for i in range(n * 30, n * 30 + (30 if n < 5 else 1)))
    for key in ("d0", "d77", "d149", "d150", "d180"):
        at = store.touched("documents", spark.createDataFrame([(key,)], "id string"))
        assert [r["path"] for r in store.table("documents", set(at)).filter(F.col("id") == key).collect()] == ["p" + key[1:]]
    # Every row lies where its key says.
    for path in store.parts()["documents"]:
        rows = spark.read.parquet(os.path.join(store.root, path))
        assert {r[0] for r in rows.select(st.bucket_of(F.col("id"), widths[-1])).distinct().collect()} == {st._bucket(path)}
    before = store.state()
    assert store.rewrite("documents", {}).buckets == set() and store.state() == before


def test_an_edit_costs_as_much_in_a_table_a_hundred_times_as_large(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKETS", 1)
    monkeypatch.setattr(st, "BUCKET_BYTES", 40_000)
    cost = {}
    for n in (150, 15_000):
        store = st.Store(spark, str(tmp_path / str(n)))
        upsert(store, documents(spark, spark.range(n)))
        assert store.width("documents") == -(-n * st.ROW_BYTES["documents"] // st.BUCKET_BYTES)
        at, fresh, cost[n] = upsert(store, documents(spark, spark.range(1)))
        assert len(fresh) <= 3 and at.buckets >= {st._bucket(p) for p in fresh}
        assert store.table("documents").count() == n
    assert cost[15_000] <= 2 * cost[150]


def test_large_buckets_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(st, "BUCKETS", 2)
    monkeypatch.setattr(st, "TASK_BYTES", 20_000)
    store = st.Store(spark, str(tmp_path))
    upsert(store, documents(spark, spark.range(2000)))
    assert store.width("documents") == 2
    files = [len([f for f in os.listdir(os.path.join(store.root, p)) if f.endswith(".parquet")]) for p in store.parts()["documents"]]
    assert min(files) > 4 and store.table("documents").select("id").distinct().count() == 2000


def test_ingestion_over_growing_buckets(spark, tmp_path, monkeypatch):
    """The same rows as with buckets enough from the start; tables of one key may differ in width."""
    root = tmp_path / "tree"
    root.mkdir()
    for i in range(24):
        (root / f"f{i}.md").write_text(f"# Title {i}\n\ntext of file {i}\n")
    tables = {}
    for name, buckets, size in (("plain", 64, 1 << 30), ("growing", 1, 9000)):
        monkeypatch.setattr(st, "BUCKETS", buckets)
        monkeypatch.setattr(st, "BUCKET_BYTES", size)
        workspace = Workspace.resolve(str(tmp_path / name))
        (root / "f3.md").write_text("# Title 3\n\nas before\n")
        ingest(spark, str(root), workspace)
        (root / "f3.md").write_text("# Title 3\n\nedited\n")
        ingest(spark, str(root), workspace)
        store = st.Store(spark, workspace.tables)
        units = store.table("text_units").select("id", "document_id", "text").orderBy("id").collect()
        tables[name] = (units, store.table("documents").select("id", "blob_sha").orderBy("id").collect(), [r["counters"] for r in store.table("ingest_runs").orderBy("run_seq").collect()])
        if name == "growing":
            assert store.width("text_units") > 1 and store.width("documents") > 0
            found, document, blob = store.of_unit(units[0]["id"])
            assert found.count() == document.count() == blob.count() == 1
    assert tables["plain"] == tables["growing"]


def test_a_pointer_of_directories_alone_is_read(spark, tmp_path):
    (tmp_path / "CURRENT").write_text('{"documents": ["documents/batch=x/bucket=3"]}')
    store = st.Store(spark, str(tmp_path))
    assert store.parts() == {"documents": ["documents/batch=x/bucket=3"]} and store.width("documents") == st.BUCKETS
