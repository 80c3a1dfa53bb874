"""Ingestion: entries in, blobs, documents, units and exactly one event per entry out."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, ids, media, triage
from ..functions.lines import is_blank
from ..functions.locators import canonical_json, is_valid
from ..operators.extract import extract, route, small_batches
from ..sources.connectors import Source, select_connector
from ..sources.tree import fetch, with_content
from ..sources.workspace import Workspace
from . import store as st
from .ledger import OUTCOMES


@dataclass(frozen=True)
class Run:
    """Identity and clock of a run, bound once so that plans stay deterministic."""

    id: str
    seq: int
    now: str

    @classmethod
    def start(cls, seq: int) -> Run:
        now = dt.datetime.now(dt.UTC)
        return cls(f"{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:6]}", seq, f"{now:%Y-%m-%dT%H:%M:%S}+00:00")


def metadata_gate(size: Column, kind: Column) -> Column:
    """struct<outcome, reason, detail> of entries whose bytes are not read, else null."""
    verdict = lambda reason, detail="": F.struct(
        F.lit("skipped").alias("outcome"), F.lit(reason).alias("reason"), (detail if isinstance(detail, Column) else F.lit(detail)).alias("detail")
    )
    return (
        F.when(kind == "pruned", verdict("pruned_directory", "not entered by convention"))
        .when(size == 0, verdict("empty_file"))
        .when(size > fixed.MAX_BLOB_BYTES, verdict("too_large", F.format_string(f"%d bytes, the most is {fixed.MAX_BLOB_BYTES}", size)))
    )


def describe(items: DataFrame, source_id: Column) -> DataFrame:
    """Adds hash, ids, media type, relevance and reader to items with content."""
    size = F.octet_length("content").cast("long")
    out = items.withColumns({"blob_sha": ids.sha256_hex(F.col("content")), "size": size, "document_id": ids.document_id(source_id, F.col("path"))})
    out = out.withColumn("media_type", F.coalesce("media_type", media.media_type(F.col("path"), F.col("content"))))
    return out.withColumns(
        {
            "relevance": triage.relevance(F.col("path"), F.col("size")),
            "extractor": route(F.col("media_type"), F.col("path")),
            "binary": media.looks_binary(F.col("content")) & ~media.is_textual(F.col("media_type")),
        }
    )


def is_unchanged(old_sha: Column, sha: Column, had_units: Column) -> Column:
    """The same bytes as before, and units of those bytes exist."""
    return F.coalesce(old_sha == sha, F.lit(False)) & F.coalesce(had_units, F.lit(False))


def content_gate(unchanged: Column) -> Column:
    """struct<outcome, reason, detail> of described items that are not extracted: the first rule that fits."""
    verdict = lambda outcome, reason, detail: F.struct(F.lit(outcome).alias("outcome"), reason.alias("reason"), detail.alias("detail"))
    lit = F.lit
    return (
        F.when(F.col("read_error").isNotNull(), verdict("failed", lit("read_error"), F.col("read_error")))
        .when(unchanged, verdict("unchanged", lit("unchanged_blob"), lit("")))
        .when(F.col("relevance") == triage.IGNORABLE, verdict("skipped", lit("low_relevance"), lit("stored and addressable, not extracted")))
        .when(
            F.col("extractor").isNull(),
            verdict("skipped", F.when(F.col("binary"), "binary").otherwise("no_extractor"), F.concat(lit("no reader for "), F.col("media_type"))),
        )
    )


def finished_units(extracted: DataFrame) -> DataFrame:
    """Drops blank and unaddressable units and notes the first parse error."""
    filled = F.filter(F.coalesce("units", F.array().cast(extracted.schema["units"].dataType)), lambda u: ~is_blank(u["text"]))
    out = extracted.withColumn("units", filled)
    errors = F.filter(F.transform("units", lambda u: F.try_element_at(u["meta"], F.lit("parse_error"))), lambda e: F.coalesce(e, F.lit("")) != "")
    return out.withColumn("degraded", F.coalesce(F.get(errors, F.lit(0)), F.lit(""))).withColumn(
        "units", F.filter("units", lambda u: is_valid(u["locator"]))
    )


def unit_rows(done: DataFrame, now: str) -> DataFrame:
    """text_units rows of documents with ``units``; the ordinal is the place among the units that stay."""
    rows = done.select("document_id", "blob_sha", "extractor", "relevance", F.posexplode("units").alias("ordinal", "u"))
    rows = rows.withColumn("s", triage.sensitivity(F.col("u.text"))).withColumn("locator_json", canonical_json(F.col("u.locator"), " "))
    return rows.select(
        ids.text_unit_id(F.col("document_id"), F.col("blob_sha"), canonical_json(F.col("u.locator")), F.col("ordinal")).alias("id"),
        "document_id", "blob_sha", F.col("u.locator").alias("locator"), "locator_json", "ordinal", F.col("u.text").alias("text"),
        F.length("u.text").alias("char_count"), F.col("u.verbatim").alias("verbatim"), "extractor", "relevance",
        F.col("s.level").alias("sensitivity"), F.col("s.labels").alias("sensitivity_labels"), F.col("u.meta").alias("meta"), F.lit(now).alias("created_utc"),
    )


def ingest_entries(
    spark: SparkSession, entries: DataFrame, store: st.Store, connector: str, uri: str, label: str = "", revision: str = "", has_content: bool = False
) -> Run:
    """Runs one ingestion of ``entries`` and commits it as a whole."""
    with small_batches(spark), store.writing():
        old = {name: store.table(name) for name in ("blobs", "document_versions", "ingest_runs")}
        run = Run.start(old["ingest_runs"].count())
        source = ids.source_id(F.lit(connector), F.lit(uri))
        if not has_content:
            # A tree is walked once; both gates read its listing.
            entries.write.parquet(store.staging(run.id, "listing"))
            entries = spark.read.schema(entries.schema).parquet(store.staging(run.id, "listing"))
        gated = entries.withColumn("gate", metadata_gate(F.col("size"), F.col("entry_kind")))
        early = gated.filter("gate is not null")
        ready = gated.filter("gate is null").drop("gate")
        items = describe(with_content(ready) if has_content else fetch(ready), source)
        # Bytes are written once, as the blobs' staging table; all else reads the narrow columns.
        staged = store.staging(run.id, "items")
        items.write.parquet(staged)
        items = spark.read.schema(items.schema).parquet(staged)
        readable = items.filter("read_error is null")

        # Only the buckets of the run's documents are read.
        keys = readable.select("document_id")
        docs_at = store.rewrite("documents", store.touched("documents", keys))
        prior = store.table("text_units", set(store.touched("text_units", keys))).select("document_id", "blob_sha").distinct().withColumn("had", F.lit(True))
        docs_before = store.table("documents", docs_at.buckets).select(F.col("id").alias("document_id"), F.col("blob_sha").alias("old_sha"))
        narrow = items.drop("content").join(docs_before, "document_id", "left").join(prior, ["document_id", "blob_sha"], "left")
        judged = narrow.withColumn("gate", content_gate(is_unchanged(F.col("old_sha"), F.col("blob_sha"), F.col("had"))))
        todo = judged.filter("gate is null").select("document_id", "extractor", "path")
        work = todo.join(readable.select("document_id", "content"), "document_id")
        done_path = store.staging(run.id, "units")
        finished_units(extract(work)).write.parquet(done_path)
        done = spark.read.parquet(done_path)

        found = judged.join(done, "document_id", "left")
        n = F.coalesce(F.size("units"), F.lit(0))
        n = F.when(F.col("units").isNull(), 0).otherwise(n)
        outcome = (
            F.when(F.col("gate").isNotNull(), F.col("gate.outcome"))
            .when(F.col("status").isin("skipped", "failed"), F.col("status"))
            .when(n == 0, "skipped")
            .otherwise("extracted")
        )
        reason = (
            F.when(F.col("gate").isNotNull(), F.col("gate.reason"))
            .when(F.col("status").isin("skipped", "failed"), F.col("reason"))
            .when(n == 0, "nothing_to_extract")
            .when(F.col("degraded") != "", "degraded_parse")
            .otherwise("")
        )
        detail = (
            F.when(F.col("gate").isNotNull(), F.col("gate.detail"))
            .when(F.col("status").isin("skipped", "failed"), F.col("detail"))
            .when(n == 0, F.concat(F.col("extractor"), F.lit(" gave no text")))
            .otherwise(F.col("degraded"))
        )
        failed_read = F.col("read_error").isNotNull()
        known = lambda c: F.when(~failed_read, F.col(c))
        late_events = found.select(
            F.lit(run.id).alias("run_id"), "seq", "path", known("document_id").alias("document_id"), known("blob_sha").alias("blob_sha"),
            known("media_type").alias("media_type"), known("size").alias("size"), outcome.alias("outcome"), reason.alias("reason"),
            F.substring(detail, 1, fixed.DETAIL_CHARS).alias("detail"), F.when(F.col("gate").isNull(), F.col("extractor")).alias("extractor"),
            n.cast("int").alias("units"), F.lit(run.now).alias("recorded_utc"),
        )
        none = F.lit(None).cast("string")
        early_events = early.select(
            F.lit(run.id).alias("run_id"), "seq", "path", none.alias("document_id"), none.alias("blob_sha"), none.alias("media_type"),
            F.when(F.col("gate.reason") == "too_large", F.col("size")).alias("size"), "gate.outcome", "gate.reason", "gate.detail",
            none.alias("extractor"), F.lit(0).alias("units"), F.lit(run.now).alias("recorded_utc"),
        )
        events = late_events.unionByName(early_events)

        seen = readable.drop("content").select(
            F.col("document_id").alias("id"), source.alias("source_id"), "path", "blob_sha", "media_type", "size", "relevance",
            F.lit(run.now).alias("first_seen"), F.lit(run.now).alias("last_seen"), "seq", "revision",
        )
        blobs = st.new_blobs(seen.withColumnRenamed("blob_sha", "sha256"), old["blobs"])
        blobs = blobs.join(readable.select(F.col("path").alias("from_path"), "content"), "from_path").withColumn("shard", F.substring("sha256", 1, 2))
        versions = st.new_versions(
            seen.select(
                F.col("id").alias("document_id"), "blob_sha", F.coalesce(F.nullif("revision", F.lit("")), F.lit(revision)).alias("revision"),
                F.lit(run.now).alias("seen_utc"), F.lit(run.seq).cast("long").alias("run_seq"), "seq",
            ),
            old["document_versions"],
        )
        # Documents whose bytes changed lose their old units even when the new bytes give none; what never had units has none to lose.
        stale = (
            judged.filter("read_error is null and (gate is null or not (old_sha <=> blob_sha))")
            .filter(F.coalesce(F.col("gate.outcome"), F.lit("")) != "unchanged")
            .join(prior.select("document_id").distinct(), "document_id", "left_semi")
        )
        units = unit_rows(done.join(judged.select("document_id", "blob_sha", "extractor", "relevance"), "document_id"), run.now)
        first = spark.range(1).select(
            source.alias("id"), F.lit(connector).alias("connector"), F.lit(uri).alias("uri"), F.lit(label).alias("label"),
            F.lit(revision).alias("revision"), F.lit(run.now).alias("first_seen"), F.lit(run.now).alias("last_seen"),
        )
        # The counters are taken while the events are written.
        counted = Observation(run.id)
        events = events.observe(counted, *(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES), F.coalesce(F.sum("units"), F.lit(0)).cast("long").alias("units"))

        def finished() -> DataFrame:
            counts = {k: n for k, n in counted.get.items() if n or k == "units"}
            row = (run.id, run.seq, connector, uri, run.now, run.now, "ok", counts if len(counts) > 1 else {})
            names = "id string, run_seq bigint, connector string, target string, started_utc string, finished_utc string, status string, counters map<string,bigint>"
            return spark.createDataFrame([row], names).withColumn("source_id", source)

        # Only the buckets that hold a row of this run are written again.
        changed = stale.select("document_id").unionByName(done.filter(F.size("units") > 0).select("document_id"))
        units_at = store.rewrite("text_units", store.touched("text_units", changed), st.bytes_below(done_path))
        source_at = store.rewrite("sources", store.touched("sources", first.select("id")))
        store.commit(
            {
                "blobs": blobs,
                "sources": st.merge_rows(store.table("sources", source_at.buckets), first),
                "documents": st.merge_rows(store.table("documents", docs_at.buckets), seen.drop("seq", "revision")),
                "document_versions": versions,
                "text_units": st.replace_units(store.table("text_units", units_at.buckets), stale, units),
                "ingest_events": events,
                "ingest_runs": finished,
            },
            {"sources": source_at, "documents": docs_at, "text_units": units_at},
        )
        store.drop_staging(run.id)
        return run


def ingest(spark: SparkSession, target: str | Source, workspace: Workspace, kind: str | None = None, only: str = "") -> Run:
    """Ingests a target: a directory, a repository, a file or pasted text.

    only: of a tree, the paths that begin with this; no other folder is listed.
    """
    connector = target if isinstance(target, Source) else select_connector(target, kind)
    connector.only = only or connector.only
    connector.prepare(workspace.clones)
    store = st.Store(spark, workspace.tables)
    return ingest_entries(
        spark, connector.entries(spark), store, connector.name, connector.uri, connector.label, connector.revision, connector.has_content
    )
