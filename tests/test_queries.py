"""Queries against their SQL in DuckDB, and what stands without the optional parts."""

import duckdb
import pytest

import __spark_entry__ as entry
from spanstore.oracle import ORACLE_SQL
from spanstore.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    sql = duck.sql(ORACLE_SQL[name])
    order = sorted(df.columns)
    assert sorted(sql.columns) == order
    at = [sql.columns.index(c) for c in order]
    assert sorted(repr(tuple(r[c] for c in order)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in sql.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stream(spark, tmp_path):
    from spanstore.plans.store import Store
    from spanstore.streaming.batches import ingest_stream

    inbox = tmp_path / "in"
    spark.createDataFrame([("a.md", bytearray(b"# a\n")), ("b.txt", bytearray(b"b\n"))], "path string, content binary").write.parquet(str(inbox))
    store = Store(spark, str(tmp_path / "tables"))
    items = spark.readStream.schema("path string, content binary").parquet(str(inbox))
    ingest_stream(items, store, "inbox", str(tmp_path / "ck")).awaitTermination()
    got = {(r["path"], r["outcome"]) for r in store.table("ingest_events").collect()}
    assert got == {("a.md", "extracted"), ("b.txt", "extracted")}
