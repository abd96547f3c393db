"""Command line for ``spark-submit``: one sub-command per pipeline.

    spark-submit --py-files haulage.zip run.py csv-to-parquet IN OUT
    python -m haulage race-results IN OUT --run-date 2026-03-07

Databases come from the environment (``SOURCE_JDBC_URL``, ``SOURCE_USER``,
``SOURCE_PASSWORD``, ``SOURCE_DRIVER`` and the same with ``TARGET``), object
store access from ``S3_ENDPOINT``, ``S3_ACCESS_KEY`` and ``S3_SECRET_KEY``.
Any failure ends the program with exit code 1; the session is always stopped.
"""

from __future__ import annotations

import os
import re
import argparse
import sys
from collections.abc import Sequence

from haulage.plans import customer, launches, parquet_copy, races, replicate, staging
from haulage.session import build_session, object_store_settings
from haulage.sources import Endpoint, LOSSLESS, PLAIN
from haulage.sources.files import STANDARD

DIALECTS = {"lossless": LOSSLESS, "plain": PLAIN, "standard": STANDARD}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="haulage", description="Batch ETL on Spark")
    top.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, summary: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=summary)
        sub.set_defaults(run=run)
        return sub

    sub = command("customer", run_customer, "customer dimension to CSV and a staging table")
    sub.add_argument("base", help="folder for the dated CSV")
    sub.add_argument("--run-date", required=True)
    sub.add_argument("--source-table", default=f"dbo.{customer.SOURCE_TABLE}")
    sub.add_argument("--staging-table", default=customer.STAGING_TABLE)
    sub.add_argument("--csv", choices=DIALECTS, default="lossless")
    sub.add_argument("--schema", help="column types of the staging table; default: all text")

    sub = command("replicate", run_replicate, "copy tables between databases")
    sub.add_argument("tables", nargs="+")
    sub.add_argument("--schema", default="dbo")
    sub.add_argument("--prefix", default=replicate.TARGET_PREFIX)
    sub.add_argument("--at-once", type=int, default=4)
    sub.add_argument("--counts-only", action="store_true", help="compare row counts, not rows")

    sub = command("csv-to-parquet", run_parquet_copy, "convert a CSV and check the copy")
    sub.add_argument("csv")
    sub.add_argument("parquet")
    sub.add_argument("--schema", help="column types, e.g. 'day date, n int'; default: inferred")
    sub.add_argument("--csv-dialect", choices=DIALECTS, default="plain")
    sub.add_argument("--max-bad-share", type=float, help="put bad rows apart, up to this share; needs --schema")
    sub.add_argument("--required", nargs="*", default=[], help="columns that a good row has")

    sub = command("stage-csv", run_staging, "replace a catalog table by a folder of CSV files")
    sub.add_argument("folder")
    sub.add_argument("table", help="catalog.namespace.table")
    sub.add_argument("--schema", help="column types; default: inferred")
    sub.add_argument("--no-properties", action="store_true")
    sub.add_argument("--csv-dialect", choices=DIALECTS, default="plain")
    sub.add_argument("--keep-previous-files", action="store_true")
    sub.add_argument("--by-name", action="store_true", help="files with unlike headers, matched by column name")

    sub = command("race-results", run_races, "flatten race documents into their load date")
    sub.add_argument("documents")
    sub.add_argument("output")
    sub.add_argument("--run-date", required=True)
    sub.add_argument("--json-lines", action="store_true", help="a document per line, not per file")
    sub.add_argument("--compression", choices=["gzip"], help="of the files written; default: none")

    sub = command("image-manifest", run_launches, "list the image files of launch documents")
    sub.add_argument("documents")
    sub.add_argument("output")
    sub.add_argument("--json-lines", action="store_true", help="a document per line, not per file")
    sub.add_argument("--this-run-only", action="store_true", help="leave earlier runs' files out")
    return top


def run_customer(spark, args):
    dialect = DIALECTS[args.csv].with_separator(";")
    return customer.run(
        spark,
        Endpoint.from_env("SOURCE"),
        Endpoint.from_env("TARGET"),
        args.base,
        args.run_date,
        args.source_table,
        args.staging_table,
        dialect,
        args.schema,
    )


def run_replicate(spark, args):
    report = replicate.run(
        spark,
        Endpoint.from_env("SOURCE"),
        Endpoint.from_env("TARGET"),
        args.tables,
        args.schema,
        args.prefix,
        at_once=args.at_once,
        content=not args.counts_only,
    ).collect()
    for row in report:
        print(*["-" if value is None else value for value in row], sep="\t")
    failed = [row.table_name for row in report if row.status != "loaded"]
    if failed:
        raise RuntimeError("not loaded: " + ", ".join(failed))
    return f"{len(report)} tables loaded"


def run_parquet_copy(spark, args):
    dialect = DIALECTS[args.csv_dialect]
    if args.max_bad_share is not None:
        if not args.schema:
            raise ValueError("--max-bad-share needs --schema")
        _, counts = parquet_copy.run_tolerant(
            spark, args.csv, args.parquet, args.schema, args.required, args.max_bad_share, dialect
        )
        return f"{args.parquet}: {counts.good} good rows, {counts.bad} bad rows"
    copy = parquet_copy.run(spark, args.csv, args.parquet, args.schema, dialect)
    return f"{args.parquet}: {copy.schema.simpleString()}"


def run_staging(spark, args):
    properties = None if args.no_properties else staging.FILE_FORMAT
    table = staging.run(
        spark,
        args.folder,
        args.table,
        args.schema,
        properties,
        dialect=DIALECTS[args.csv_dialect],
        keep_previous_files=args.keep_previous_files,
        by_name=args.by_name,
    )
    return f"{args.table}: {table.schema.simpleString()}"


def run_races(spark, args):
    return races.run(
        spark, args.documents, args.output, args.run_date, not args.json_lines, args.compression
    )


def run_launches(spark, args):
    return launches.run(spark, args.documents, args.output, not args.json_lines, not args.this_run_only)


def without_secrets(text: str) -> str:
    """``text`` without database URLs, passwords and store keys from the environment."""
    for side in ("SOURCE", "TARGET"):
        for name in (f"{side}_JDBC_URL", f"{side}_PASSWORD"):
            if os.environ.get(name):
                text = text.replace(os.environ[name], "***")
    for name in ("S3_ACCESS_KEY", "S3_SECRET_KEY"):
        if os.environ.get(name):
            text = text.replace(os.environ[name], "***")
    return re.sub(r"(?i)(password|user)=[^;&\s]*", r"\1=***", text)


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    settings = {**object_store_settings(), **dict(pair.split("=", 1) for pair in args.conf)}
    spark = build_session(f"haulage {args.command}", settings)
    try:
        print(args.run(spark, args))
        return 0
    except Exception as failure:
        print(f"{args.command} failed: {without_secrets(str(failure))}", file=sys.stderr)
        return 1
    finally:
        spark.stop()
