"""Command line: the two publishing modes, with prompts turned into arguments.

    python -m tablekeep publish <application_root> [options]
    python -m tablekeep merge <table.parquet> [<table.parquet> ...] --target-schema S [options]

The report is printed as JSON lines and, with ``--report-dir``, written there
under a folder named after the run's UTC time.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from .functions.types import POLICIES
from .operators.report import report_totals
from .plans.publish import publish_application, publish_merge


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablekeep", description="Publish archived Parquet folders as Spark tables.")
    sub = p.add_subparsers(dest="mode", required=True)

    def common(sp):
        sp.add_argument("--replace-existing", action="store_true", help="replace tables that already exist")
        sp.add_argument("--verify-row-count", action="store_true", help="count the rows of every registered table")
        sp.add_argument("--policy", choices=POLICIES, default="native", help="column type policy")
        sp.add_argument("--type-map", help="JSON file: Spark type class name -> declared type (mapped policy)")
        sp.add_argument("--database-prefix", default="", help="prefix for every catalog database name")
        sp.add_argument("--database-location", help="parent folder for databases that get created")
        sp.add_argument("--report-dir", help="folder to write the JSON report into")
        sp.add_argument("--report-format", choices=("rows", "document"), default="rows",
                        help="JSON lines (one per table) or one nested JSON document")
        sp.add_argument("--files-dir", help="dataset to append the run's file list to")
        sp.add_argument("--workers", type=int, default=8, help="tables (or sources) handled concurrently")

    pub = sub.add_parser("publish", help="publish every table of an application root")
    pub.add_argument("root")
    pub.add_argument("--only-changed", action="store_true", help="replace only tables whose files differ from the last list")
    common(pub)
    mer = sub.add_parser("merge", help="publish one table merged from several applications")
    mer.add_argument("paths", nargs="+", help="<application>/parquet/<TABLE>.parquet folders")
    mer.add_argument("--target-schema", required=True)
    mer.add_argument("--on-conflict", choices=("error", "text"), default="error")
    common(mer)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s", stream=sys.stderr)
    mapping = None
    if args.type_map:
        with open(args.type_map, encoding="utf-8") as fh:
            mapping = json.load(fh)
    spark = (
        SparkSession.builder.appName("tablekeep")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    kw = dict(
        replace_existing=args.replace_existing,
        verify_row_count=args.verify_row_count,
        policy=args.policy,
        mapping=mapping,
        database_prefix=args.database_prefix,
        database_location=args.database_location,
        report_path=args.report_dir,
        report_format=args.report_format,
        files_path=args.files_dir,
    )
    if args.mode == "publish":
        report = publish_application(spark, args.root, max_workers=args.workers, only_changed=args.only_changed, **kw)
    else:
        report = publish_merge(
            spark, args.paths, args.target_schema, on_conflict=args.on_conflict, max_workers=args.workers, **kw
        )
    for line in report.toJSON().collect():
        print(line)
    totals = report_totals(report).first()
    print(json.dumps(totals.asDict()), file=sys.stderr)
    return 1 if totals.tables_failed else 0


if __name__ == "__main__":
    sys.exit(main())
