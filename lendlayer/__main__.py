"""Command line: run the layered jobs as a Spark application.

    spark-submit lendlayer/__main__.py run --location /shared/lake --as-of 2026-01-01 \
        --ingest customer_metadata=landing/customer_metadata.csv --tables customer_metadata
    python -m lendlayer silver --hive --location /shared/lake --tables loan_history

Subcommands: ``ingest`` (file -> bronze), ``seed`` (CSV of literal values -> bronze table of
fixed schema), ``nulls`` (bronze split on critical columns), ``repair`` (officer ids in place),
``silver`` (bronze -> silver + reject), ``gold`` (silver -> gold), ``run`` (optional
ingests, then repair, silver and gold for the manifest). Each prints the run report
and exits non-zero when a table failed.

Tables are registered in the session catalog. Steps split over several
applications need a persistent metastore (the cluster's, or ``--hive`` for a local
one); ``run`` does everything in one application.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from lendlayer.layout import Layout
from lendlayer.operators.quality import DEFAULT_RULES, load_rules
from lendlayer.plans import jobs
from lendlayer.schemas import CLEANED_TABLES, RAW_TABLES, SCHEMA_DDL
from lendlayer.sources.catalog import preview, tables_frame
from lendlayer.sources.files import read_manifest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lendlayer", description=__doc__.split("\n")[0])
    p.add_argument("command", choices=["ingest", "seed", "nulls", "repair", "silver", "gold", "run"])
    p.add_argument("--prefix", default="", help="database name prefix")
    p.add_argument("--location", default=None, help="shared folder for the layer databases")
    p.add_argument("--catalog", default=None, help="catalog of the layer databases")
    p.add_argument("--tables", default=",".join(RAW_TABLES + CLEANED_TABLES), help="comma-separated tables")
    p.add_argument("--manifest", default=None, help="INI file with a [tables] section of table lists (instead of --tables)")
    p.add_argument("--as-of", default=None, help="load / overdue reference date (YYYY-MM-DD); default today")
    p.add_argument("--alias", action="append", default=[], help="table=rules_name, e.g. branch_master_dirty=branch_master")
    p.add_argument("--parallelism", type=int, default=1, help="tables processed concurrently")
    p.add_argument("--table", help="ingest: target bronze table (one of the ten schemas)")
    p.add_argument("--path", help="ingest: file or folder to land")
    p.add_argument("--format", default="csv", choices=["csv", "json"])
    p.add_argument("--json-lines", action="store_true", help="ingest: JSON lines instead of one document per file")
    p.add_argument("--ingest", action="append", default=[], help="run: table=path to land first (repeatable)")
    p.add_argument("--hive", action="store_true", help="use a persistent (Hive) metastore")
    p.add_argument("--rules", default=None, help="JSON file of data-quality rules (default: built-in registry)")
    p.add_argument("--preview", type=int, default=0, help="ingest/run: show the first N rows of each landed table")
    return p


def _show(df) -> None:
    df.show(max(df.count(), 1), truncate=False)


def _preview(spark: SparkSession, layout: Layout, table: str, n: int) -> None:
    if n > 0:
        preview(spark.table(layout.table("bronze", table)), n).show(n, truncate=False)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"lendlayer-{args.command}")
    spark = (builder.enableHiveSupport() if args.hive else builder).getOrCreate()
    layout = Layout(prefix=args.prefix, location=args.location, catalog=args.catalog).create(spark)
    tables = [t.strip() for t in args.tables.split(",") if t.strip()]
    if args.manifest:
        tables = [t for listed in read_manifest(spark, args.manifest).values() for t in listed]
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
    aliases = dict(a.split("=", 1) for a in args.alias)
    rules = load_rules(args.rules) if args.rules else DEFAULT_RULES
    if args.command == "ingest":
        if not (args.table and args.path):
            raise SystemExit("ingest needs --table and --path")
        rows = [
            jobs.ingest_file(
                spark, layout, args.path, args.table, SCHEMA_DDL[args.table], args.format, not args.json_lines
            )
        ]
        _preview(spark, layout, args.table, args.preview)
    elif args.command == "seed":
        if not (args.table and args.path):
            raise SystemExit("seed needs --table and --path")
        rows = [jobs.seed_file(spark, layout, args.path, args.table, SCHEMA_DDL[args.table])]
    elif args.command == "nulls":
        rows = jobs.split_nulls(spark, layout, tables, parallelism=args.parallelism)
    elif args.command == "repair":
        rows = [jobs.repair_officer_ids(spark, layout)]
    elif args.command == "silver":
        rows = jobs.bronze_to_silver(
            spark, layout, tables, rules=rules, aliases=aliases, parallelism=args.parallelism
        )
    elif args.command == "gold":
        rows = jobs.silver_to_gold(spark, layout, as_of=as_of, parallelism=args.parallelism)
    else:
        landed = []
        for item in args.ingest:
            table, path = item.split("=", 1)
            landed.append(
                jobs.ingest_file(spark, layout, path, table, SCHEMA_DDL[table], args.format, not args.json_lines)
            )
            _preview(spark, layout, table, args.preview)
        report = jobs.run_all(
            spark, layout, tables, aliases=aliases, as_of=as_of, parallelism=args.parallelism, rules=rules
        )
        if landed:
            report = jobs.report_frame(spark, landed).unionByName(report)
        _show(report)
        _show(tables_frame(spark, layout.database("gold")))  # the written gold tables
        return 1 if report.filter("status = 'failed'").limit(1).count() else 0
    _show(jobs.report_frame(spark, rows))
    return 1 if any(r.status == "failed" for r in rows) else 0


if __name__ == "__main__":
    sys.exit(main())
