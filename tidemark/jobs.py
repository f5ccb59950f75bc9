"""Command line of the batch jobs, for ``spark-submit`` or ``python -m tidemark.jobs``.

A target holding a ``/`` is a path, any other a table name.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.operators.quality import quality_report, store_failures
from tidemark.operators.schema_ops import contract_violations
from tidemark.operators.staging import stage
from tidemark.plans import loads, marts
from tidemark.schemas import ACCOUNTS, AUDIT, ENTITIES, TRANSACTIONS, USERS
from tidemark.session import build_session
from tidemark.sources.parquet import probe_path, read_delivery, read_parquet


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    commands = top.add_subparsers(dest="command", required=True)

    for name, text in (
        ("raw-load", "load a delivery, without connector columns, into a table"),
        ("evolving-load", "load a delivery in the shape of the live table"),
    ):
        load = commands.add_parser(name, help=text)
        load.add_argument("--input", required=True)
        load.add_argument("--target", required=True)
        load.add_argument("--as-of", help="load time to stamp; default now")
        load.add_argument("--format", default="parquet")

    contract = commands.add_parser("contract", help="check a delivery for required tables and columns")
    contract.add_argument("--raw", required=True, help="folder with one folder per table")

    build = commands.add_parser("marts", help="build the dimensions and facts")
    build.add_argument("--raw", required=True, help="folder with one folder per table")
    build.add_argument("--out", required=True, help="folder for the marts")
    build.add_argument("--full-refresh", action="store_true")
    build.add_argument("--timestamp-type", default="timestamp")

    check = commands.add_parser("check", help="run the quality rules on the marts")
    check.add_argument("--marts", required=True)
    check.add_argument("--failures", help="folder for the failing rows")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one job; 0 if it went well and every check passed."""
    options = parser().parse_args(argv)
    session = spark or build_session(f"tidemark-{options.command}")
    job = {
        "raw-load": _raw_load,
        "evolving-load": _evolving_load,
        "contract": _contract,
        "marts": _marts,
        "check": _check,
    }[options.command]
    return job(session, options)


def _raw_load(spark: SparkSession, options: argparse.Namespace) -> int:
    return _report(loads.raw_load(spark, options.input, options.target, options.as_of, fmt=options.format))


def _evolving_load(spark: SparkSession, options: argparse.Namespace) -> int:
    return _report(loads.evolving_load(spark, options.input, options.target, options.as_of, fmt=options.format))


def _report(result: loads.LoadResult) -> int:
    print(json.dumps(vars(result)))
    return 0


def _contract(spark: SparkSession, options: argparse.Namespace) -> int:
    folders = {name: f"{options.raw}/{name}" for name in ENTITIES}
    # Read as the loads read them: a column of any file counts.
    found = {name: read_delivery(spark, path) for name, path in folders.items() if probe_path(spark, path) is not None}
    missing = contract_violations(found)
    print(json.dumps({"missing": missing}))
    return 1 if missing else 0


def _marts(spark: SparkSession, options: argparse.Namespace) -> int:
    staged = {
        entity.name: stage(
            read_delivery(spark, f"{options.raw}/{entity.name}"), entity, options.timestamp_type
        )
        for entity in (USERS, ACCOUNTS, TRANSACTIONS, AUDIT)
    }
    marts.load_dimension(marts.dim_users(staged["users"]), f"{options.out}/dim_users")
    marts.load_dimension(marts.dim_accounts(staged["accounts"]), f"{options.out}/dim_accounts")
    marts.load_fct_audit(staged["audit"], f"{options.out}/fct_audit")
    upserted = marts.load_fct_transactions(
        spark, staged["transactions"], staged["accounts"], f"{options.out}/fct_transactions", options.full_refresh
    )
    print(json.dumps({"fct_transactions": "full" if upserted is None else upserted.rows}))
    return 0


def _check(spark: SparkSession, options: argparse.Namespace) -> int:
    names = ("dim_users", "dim_accounts", "fct_transactions")
    frames = {name: marts.read_mart(spark, f"{options.marts}/{name}") for name in names}
    # one row per rule
    report = [row.asDict() for row in quality_report(frames).collect()]
    if options.failures:
        store_failures(frames, folder=options.failures)
    print(json.dumps(report))
    return 1 if any(line["failures"] for line in report) else 0


if __name__ == "__main__":
    sys.exit(main())
