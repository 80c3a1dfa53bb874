"""The ledger: one event per entry, runs, gaps and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOMES = ("extracted", "unchanged", "skipped", "failed")
REASONS = (
    "pruned_directory", "no_extractor", "missing_dependency", "nothing_to_extract", "low_relevance", "too_large",
    "binary", "empty_file", "read_error", "extractor_error", "degraded_parse", "unchanged_blob",
)


def counters(events: DataFrame) -> DataFrame:
    """(run_id, counters): entries by outcome, and units."""
    by = events.groupBy("run_id", "outcome").agg(F.count("*").alias("n"), F.sum("units").alias("u"))
    cells = by.groupBy("run_id").agg(
        F.collect_list(F.struct(F.col("outcome").alias("name"), "n")).alias("outcomes"), F.sum("u").cast("long").alias("units")
    )
    total = F.struct(F.lit("units").alias("name"), F.col("units").alias("n"))
    return cells.select("run_id", F.map_from_entries(F.array_append("outcomes", total)).alias("counters"))


def documents_of(counts: Column) -> Column:
    """Entries of a run: the sum of the outcomes, pruned directories included."""
    return sum((F.coalesce(F.try_element_at(counts, F.lit(o)), F.lit(0)) for o in OUTCOMES), F.lit(0))


def summary_line(runs: DataFrame) -> Column:
    """One line a run."""
    names = F.filter(F.array_sort(F.map_keys("counters")), lambda k: F.element_at(F.col("counters"), k) > 0)
    shown = F.array_join(F.transform(names, lambda k: F.concat(k, F.lit("="), F.element_at(F.col("counters"), k).cast("string"))), ", ")
    return F.concat_ws(" ", "id", "connector", "target", F.lit("::"), F.when(shown == "", F.lit("no documents")).otherwise(shown))


def events(table: DataFrame, run_id: str | None = None, outcome: str | None = None, limit: int = 200) -> DataFrame:
    """Events in walk order, optionally of a run or an outcome."""
    for name, value in (("run_id", run_id), ("outcome", outcome)):
        if value:
            table = table.filter(F.col(name) == value)
    return table.orderBy("run_id", "seq").limit(limit)


def gaps(table: DataFrame, run_id: str | None = None) -> DataFrame:
    """(outcome, reason, documents, example): why entries are not readable, most frequent first."""
    rows = table.filter(F.col("outcome").isin("skipped", "failed"))
    rows = rows.filter(F.col("run_id") == run_id) if run_id else rows
    found = rows.groupBy("outcome", "reason").agg(F.count("*").alias("documents"), F.min("path").alias("example"))
    return found.orderBy(F.desc("documents"), "outcome", "reason")


def gap_line(row: DataFrame) -> Column:
    return F.format_string("%5d  %s/%s  e.g. %s", "documents", "outcome", "reason", "example")


def runs(table: DataFrame, limit: int = 20) -> DataFrame:
    """Latest runs first."""
    return table.orderBy(F.desc("started_utc"), F.desc("run_seq")).limit(limit)


def last_run(table: DataFrame) -> DataFrame:
    return runs(table, 1)
