"""Command line: ingest, runs, ledger, gaps, show, find, doctor, stats."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.locators import cite
from .operators.extract import availability
from .plans import ledger, query
from .plans.ingest import ingest
from .plans.store import SCHEMAS, Store, StoreError
from .sources.connectors import ConnectorError
from .sources.workspace import Workspace


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="spanstore")
    p.add_argument("--root", help="workspace directory")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *args: tuple) -> None:
        s = sub.add_parser(name)
        for flag, kw in args:
            s.add_argument(flag, **kw)

    limit = lambda n: ("--limit", {"type": int, "default": n})
    add("ingest", ("target", {}), ("--kind", {}), ("--only", {"default": "", "metavar": "PREFIX"}))
    add("runs")
    add("ledger", ("--run", {}), ("--outcome", {"choices": ledger.OUTCOMES}), limit(50))
    add("gaps", ("--run", {}))
    add("show", ("unit_id", {}))
    add("find", ("needle", {}), limit(10))
    add("doctor")
    add("stats")
    return p


def _lines(df: DataFrame) -> list[str]:
    """Rows of a bounded report as text."""
    return ["\t".join("" if v is None else str(v) for v in row) for row in df.collect()]


def report(spark: SparkSession, args: argparse.Namespace) -> list[str]:
    """The lines a command prints."""
    workspace = Workspace.resolve(args.root)
    if args.command == "doctor":
        return _lines(availability(spark))
    if args.command == "ingest":
        run = ingest(spark, args.target, workspace, args.kind, args.only)
        args.run = run.id
    store = Store(spark, workspace.tables)
    t = store.table
    if args.command == "ingest":
        mine = t("ingest_runs").filter(F.col("id") == run.id)
        found = ledger.gaps(t("ingest_events"), run.id)
        return _lines(mine.select(ledger.summary_line(mine))) + _lines(found.select(ledger.gap_line(found)))
    if args.command == "runs":
        found = ledger.runs(t("ingest_runs"))
        return _lines(found.select(ledger.summary_line(found)))
    if args.command == "ledger":
        return _lines(ledger.events(t("ingest_events"), args.run, args.outcome, args.limit).select("outcome", "reason", "path", "units", "detail"))
    if args.command == "gaps":
        found = ledger.gaps(t("ingest_events"), args.run)
        return _lines(found.select(ledger.gap_line(found)))
    if args.command == "find":
        found = query.find_units(t("text_units"), t("documents"), args.needle, args.limit)
        first = F.substring(F.element_at(F.split("text", "\n"), 1), 1, 90)
        return _lines(found.select("id", cite(F.col("path"), F.col("blob_sha"), F.col("locator")), first))
    if args.command == "show":
        rows = query.show(*store.of_unit(args.unit_id), args.unit_id).select("cite", "text", "resolved", "verdict").collect()
        if not rows:
            raise StoreError(f"no unit {args.unit_id}")
        return [str(v) for v in rows[0] if v is not None]
    names = [n for n in SCHEMAS if n not in ("ingest_runs",)]
    flagged = query.sensitive_units(t("text_units"), t("documents"), 1000).agg(F.count("*").alias("rows"))
    return _lines(query.table_counts({n: t(n) for n in names})) + _lines(flagged.select(F.lit("sensitive"), "rows"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("spanstore").getOrCreate()
    try:
        for line in report(spark, args):
            print(line)
    except (ConnectorError, StoreError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
