"""Job entry points: publish an application (O25) and publish a merge.

Publish an application::

    discover (one listing, manifest persisted)  ->  plan (one join against the catalog)
    -> per table, from a small driver pool: footer job + catalog DDL
    -> optional row counts (pushed into the scans of the registered tables:
       footers only, collected: one row per table)
    -> report DataFrame built from those per-table rows (a local relation:
       reading it again reruns nothing)

A bad table (no data file, unreadable schema, nothing left after dropping
archive columns, a failed DDL) becomes an ``error`` row; the run continues.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import astuple
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counts import footer_row_counts, row_counts_by_path
from ..operators.merge import PROVENANCE_COLUMN, merge_sources
from ..operators.project import ARCHIVE_COLUMNS, column_list, exposed_list, parallel_map
from ..operators.report import (
    MERGED_SCHEMA_PATH,
    NO_FILES_MESSAGE,
    PROCESS_APPLICATION,
    PROCESS_MERGE,
    SKIP_REASON_EXISTS,
    SKIP_REASON_UNCHANGED,
    changed_tables,
    error_text,
    load_report,
    outcome,
    published_files,
    read_file_list,
    write_file_list,
    write_report,
    write_report_document,
)
from ..functions.types import quote
from ..session import count_scan_conf, manifest_scan_conf, scoped_conf
from ..sources import fs
from ..sources.layout import TABLE_DIR_SCHEMA, TableDir, discover_tables, files_by_table, table_dirs
from ..sources.manifest import manifest_by_source, require_files
from ..sources.scan import table_layouts
from .registration import NotManagedError, ensure_database, plan_registration, register_merged, register_table


log = logging.getLogger("tablekeep")


def _log_outcome(row: dict) -> None:
    name = f"{row['schema_name']}.{row['table_name']}"
    if row["status"] == "error":
        log.warning("%s: error: %s", name, row["error_message"])
    elif row["status"] == "skipped":
        log.info("%s: skipped (%s)", name, row["skip_reason"])
    else:
        log.info("%s: %s as %s v%s", name, row["action"], row["catalog_table"], row["version"])


# Errors that come out the same on every attempt: never retried.
_DETERMINISTIC = (ValueError, LookupError, NotManagedError, AnalysisException)


def _once_more(fn: Callable, label: str) -> Callable:
    """Retry ``fn`` once on an unexpected (possibly transient) error, e.g. a
    catalog or file-system hiccup; a failed attempt leaves nothing behind that
    the next version would reuse."""

    def run(item):
        try:
            return fn(item)
        except _DETERMINISTIC:
            raise
        except Exception as exc:  # noqa: BLE001 - retried once, then reported
            log.warning("%s: retrying after %s", label.format(item=item), error_text(exc))
            return fn(item)

    return run


def _now() -> datetime:
    """UTC now at millisecond precision (what the JSON report keeps)."""
    now = datetime.now(timezone.utc)
    return now.replace(microsecond=now.microsecond // 1000 * 1000)


def _finish(
    spark: SparkSession,
    outcomes: list[dict],
    report_path: str | None,
    *,
    source_root: str | None,
    started_at: datetime,
    report_format: str = "rows",
    files: DataFrame | None = None,
    files_path: str | None = None,
) -> DataFrame:
    """Stamp the run and build the report.

    Every input (outcomes, verified counts) is already a per-table row on the
    driver, so the report is a local relation: reading it again recomputes
    nothing, and no checkpoint is needed to cut lineage.
    """
    finished_at = _now()
    for o in outcomes:
        o.update(source_root=source_root, started_at=started_at, finished_at=finished_at)
    if files_path and outcomes:
        with scoped_conf(spark, manifest_scan_conf(spark)):
            write_file_list(files, outcomes, files_path)
    report = load_report(spark, outcomes)
    if report_path and outcomes:  # like the archive tool: no report when nothing was processed
        if report_format == "document":
            write_report_document(report, report_path)
        else:
            write_report(report, report_path)
    return report


def _counts(
    spark: SparkSession,
    root: str,
    dirs: list[TableDir],
    max_workers: int = 8,
) -> tuple[dict[tuple[str, str], int], dict[tuple[str, str], str]]:
    """Row counts of the registered tables: ({(schema, table): rows}, {(schema, table): error}).

    Run now, from the files' footers. Only if that fails (say a file vanished after
    listing) are the tables counted one by one, so that the failure lands on
    its own table's report row.
    """
    if not dirs:
        return {}, {}

    def count(subset: list[TableDir]) -> list:
        return footer_row_counts(spark, root, subset).collect()

    errors: dict[tuple[str, str], str] = {}
    with scoped_conf(spark, count_scan_conf(spark)):  # set once: threads below share the session
        try:
            rows = count(dirs)
        except Exception:  # noqa: BLE001 - isolate the failing table(s)
            rows = []
            for d, res in zip(dirs, parallel_map(spark, lambda one: count([one]), dirs, max_workers)):
                if isinstance(res, Exception):
                    errors[(d.schema_name, d.table_name)] = error_text(res)
                else:
                    rows.extend(res)
    return {(r.schema_name, r.table_name): r.row_count for r in rows}, errors


def _compare_views(spark: SparkSession, published: list[dict], max_workers: int = 8) -> None:
    """Count what the published views return; a difference from the files' rows is an error.

    One ``count(*)`` per view in a single query; only if that fails are the views
    counted one by one, so that the failure lands on its own row.
    """
    if not published:
        return

    def count(subset: list[tuple[int, dict]]) -> dict[int, int]:
        parts = []
        for i, o in subset:
            db, table = o["catalog_table"].split(".", 1)
            parts.append(f"SELECT {i} AS i, count(*) AS n FROM {quote(db)}.{quote(table)}")
        return {r.i: r.n for r in spark.sql(" UNION ALL ".join(parts)).collect()}

    numbered = list(enumerate(published))
    with scoped_conf(spark, count_scan_conf(spark)):
        try:
            got: dict = count(numbered)
        except Exception:  # noqa: BLE001 - isolate the failing view(s)
            got = {}
            for (i, _), res in zip(numbered, parallel_map(spark, lambda one: count([one]), numbered, max_workers)):
                got[i] = res if isinstance(res, Exception) else res[i]
    for i, o in numbered:
        if isinstance(got[i], Exception):
            o.update(status="error", error_message=f"row count failed: {error_text(got[i])}")
        elif got[i] != o["row_count"]:
            o.update(status="error", error_message=f"the published table has {got[i]} rows, its files have {o['row_count']}")


def _unchanged(spark: SparkSession, files: DataFrame, files_path: str) -> set[str]:
    """Table folders whose files are those of their last publication (one row a table comes to the driver)."""
    changes = changed_tables(files, published_files(read_file_list(spark, files_path)))
    with scoped_conf(spark, manifest_scan_conf(spark)):
        return {r.table_path for r in changes.filter("n_added + n_removed + n_changed = 0").select("table_path").collect()}


def publish_application(
    spark: SparkSession,
    root: str,
    *,
    replace_existing: bool = False,
    verify_row_count: bool = False,
    policy: str = "native",
    mapping: dict[str, str] | None = None,
    drop: Iterable[str] = ARCHIVE_COLUMNS,
    database_location: str | None = None,
    database_prefix: str = "",
    report_path: str | None = None,
    report_format: str = "rows",
    files_path: str | None = None,
    only_changed: bool = False,
    max_workers: int = 8,
) -> DataFrame:
    """Publish every table of an application root; returns the report.

    ``report_path`` writes the report there: ``report_format="rows"`` as JSON
    lines (one per table), ``"document"`` as one nested JSON document.
    ``files_path`` appends the run's file list there (``read_file_list``).
    ``only_changed`` replaces, of the tables that exist, only those whose files
    differ from the ones they were last published with according to the lists
    in ``files_path``; the others are skipped, whatever the other arguments are.
    """
    if only_changed and not (files_path and replace_existing):
        raise ValueError("only_changed needs files_path and replace_existing")
    started_at = _now()
    run_id = uuid.uuid4().hex
    drop = tuple(drop)
    # List the data files once for discovery: the table list is read from this manifest.
    dirs = table_dirs(spark, root)
    files = files_by_table(spark, root, dirs).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # The table list is catalog metadata (one row per table folder): materialise
        # it once and plan on those rows instead of re-running discovery per action.
        listed = discover_tables(spark, root, dirs, files)
        with scoped_conf(spark, manifest_scan_conf(spark)):  # also fills the persisted manifest
            discovered = spark.createDataFrame(listed.collect(), listed.schema)
        plan = plan_registration(
            spark, discovered, replace_existing=replace_existing, database_prefix=database_prefix, on_collision="mark"
        ).collect()
        listed_dirs = spark.createDataFrame([astuple(d) for d in dirs], TABLE_DIR_SCHEMA)
        run_files = files.join(listed_dirs, ["schema_dir", "table_dir"])
        unchanged = _unchanged(spark, run_files, files_path) if only_changed else set()
        # Every discovered schema gets its database first, as the archive tool
        # creates each schema before its tables (even if they all fail).
        for db in sorted({r.catalog_database for r in plan}):
            ensure_database(spark, db, database_location)
        outcomes: list[dict] = []
        todo = []
        for r in plan:
            base = dict(
                run_id=run_id,
                process=PROCESS_APPLICATION,
                schema_name=r.schema_name,
                table_name=r.table_name,
                catalog_table=f"{r.catalog_database}.{r.catalog_table}",
                schema_path=r.schema_path,
                table_path=r.table_path,
                n_files=r.n_files,
                n_bytes=r.n_bytes,
            )
            if r.action == "collision":
                outcomes.append(outcome(**base, status="error", error_message=f"catalog name collision: {r.clash}"))
            elif r.n_files == 0:
                outcomes.append(outcome(**base, status="error", error_message=NO_FILES_MESSAGE.format(path=r.table_path)))
            elif r.action == "skip":
                outcomes.append(outcome(**base, status="skipped", action="skip", skip_reason=SKIP_REASON_EXISTS))
            elif r.action == "replace" and r.table_path in unchanged:
                outcomes.append(outcome(**base, status="skipped", action="skip", skip_reason=SKIP_REASON_UNCHANGED))
            else:
                todo.append((r, base))

        # The one listing also gives the layouts, with the same jobs for any number of tables.
        below = F.expr("substring(file_path, length(table_path) + 2)").alias("below")
        layouts = table_layouts(spark, run_files.select("table_path", below)) if todo else {}

        def publish_one(item):
            r, _ = item
            spark.sparkContext.setJobDescription(f"tablekeep publish {r.schema_name}.{r.table_name}")
            return register_table(
                spark,
                r.schema_name,
                r.table_name,
                r.table_path,
                policy=policy,
                mapping=mapping,
                drop=drop,
                database_location=database_location,
                database_prefix=database_prefix,
                layout=layouts.get(r.table_path),
            )

        done: set[tuple[str, str]] = set()
        attempt = _once_more(publish_one, "table {item[1][schema_name]}.{item[1][table_name]}")
        for (r, base), res in zip(todo, parallel_map(spark, attempt, todo, max_workers)):
            if isinstance(res, Exception):
                outcomes.append(outcome(**base, status="error", action=r.action, error_message=error_text(res)))
                continue
            cols = column_list(res.columns, mapping)
            outcomes.append(
                outcome(
                    **base, status="success", action=res.action, n_columns=len(cols), columns=cols,
                    exposed_columns=exposed_list(res.columns, policy, mapping), version=res.version,
                )
            )
            done.add((r.schema_name, r.table_name))
        if verify_row_count:
            registered = [d for d in dirs if (d.schema_name, d.table_name) in done]
            counts, count_errors = _counts(spark, root, registered, max_workers)
            for o in outcomes:
                key = (o["schema_name"], o["table_name"])
                if key in count_errors:
                    o.update(status="error", error_message=f"row count failed: {count_errors[key]}")
                elif o["status"] == "success":
                    o["row_count"] = counts.get(key, 0)
            _compare_views(spark, [o for o in outcomes if o["status"] == "success"], max_workers)
        for o in outcomes:
            _log_outcome(o)
        log.info("published %s: %d table(s)", root, len(outcomes))
        return _finish(
            spark, outcomes, report_path, source_root=root, started_at=started_at, report_format=report_format,
            files=run_files, files_path=files_path,
        )
    finally:
        files.unpersist()


def publish_merge(
    spark: SparkSession,
    paths: Sequence[str],
    target_schema: str,
    *,
    replace_existing: bool = False,
    verify_row_count: bool = False,
    policy: str = "native",
    mapping: dict[str, str] | None = None,
    on_conflict: str = "error",
    provenance_col: str | None = PROVENANCE_COLUMN,
    drop: Iterable[str] = ARCHIVE_COLUMNS,
    database_location: str | None = None,
    database_prefix: str = "",
    report_path: str | None = None,
    report_format: str = "rows",
    files_path: str | None = None,
    max_workers: int = 8,
) -> DataFrame:
    """Publish one merged table; the report has exactly one row.

    An invalid merge group (O13) raises before anything is registered; a
    failure after validation is an ``error`` row. ``files_path`` appends the
    list of all sources' files there.
    """
    started_at = _now()
    sources = merge_sources(spark, paths)
    table_name = sources[0].table_name
    qualified = [s.path for s in sources]

    def finish(row: dict) -> DataFrame:
        _log_outcome(row)
        files = None
        if files_path:
            found = [p for p in qualified if fs.is_dir(spark, p)]
            files = manifest_by_source(spark, found).withColumnRenamed("source_path", "table_path")
            files = files.withColumns({"schema_name": F.lit(target_schema), "table_name": F.lit(table_name)})
        return _finish(
            spark, [row], report_path, source_root=None, started_at=started_at, report_format=report_format,
            files=files, files_path=files_path,
        )

    base = dict(
        run_id=uuid.uuid4().hex,
        process=PROCESS_MERGE,
        schema_name=target_schema,
        table_name=table_name,
        schema_path=MERGED_SCHEMA_PATH,
        merge=True,
        source_applications=[s.application for s in sources],
        source_paths=qualified,
    )
    group = spark.createDataFrame([(target_schema, table_name)], "schema_name string, table_name string")
    planned = plan_registration(
        spark, group, replace_existing=replace_existing, database_prefix=database_prefix
    ).first()
    base["catalog_table"] = f"{planned.catalog_database}.{planned.catalog_table}"
    try:
        per_source = require_files(spark, qualified).agg(
            F.sum("n_files").alias("n_files"), F.sum("n_bytes").alias("n_bytes")
        ).first()
        base.update(n_files=int(per_source.n_files), n_bytes=int(per_source.n_bytes))
    except Exception as exc:  # noqa: BLE001 - reported
        return finish(outcome(**base, status="error", action=planned.action, error_message=error_text(exc)))
    if planned.action == "skip":
        return finish(outcome(**base, status="skipped", action="skip", skip_reason=SKIP_REASON_EXISTS))
    try:
        res = register_merged(
            spark,
            target_schema,
            qualified,
            policy=policy,
            mapping=mapping,
            on_conflict=on_conflict,
            provenance_col=provenance_col,
            drop=drop,
            database_location=database_location,
            database_prefix=database_prefix,
            max_workers=max_workers,
            check_files=False,
        )
    except Exception as exc:  # noqa: BLE001 - reported
        return finish(outcome(**base, status="error", action=planned.action, error_message=error_text(exc)))
    cols = column_list(res.columns, mapping)
    row = outcome(
        **base, status="success", action=res.action, n_columns=len(cols), columns=cols,
        exposed_columns=exposed_list(res.columns, policy, mapping), version=res.version,
    )
    if verify_row_count:
        try:
            with scoped_conf(spark, count_scan_conf(spark)):
                row["row_count"] = spark.table(res.quoted).count()
                in_files = row_counts_by_path(spark, qualified).agg(F.sum("row_count")).first()[0]
            if row["row_count"] != in_files:
                row.update(status="error", error_message=f"the published table has {row['row_count']} rows, its files have {in_files}")
        except Exception as exc:  # noqa: BLE001 - reported on the table's row
            row.update(status="error", error_message=f"row count failed: {error_text(exc)}")
    return finish(row)

