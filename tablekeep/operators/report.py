"""Run report.

The report is a flat DataFrame with one row per table instead of a nested
document: status ``success`` / ``skipped`` / ``error``, why, file and column
counts, the optional row count, and for merged tables the sources.

The files that a run found are a dataset of their own (``write_file_list``),
one row a file, partitioned by run: they are written by the tasks that listed
them and never come to the driver. ``changed_tables`` compares a listing with
the one of each table's last publication.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import fs

STATUSES = ("success", "skipped", "error")

# Fixed values (report texts, formats and document keys that must read like the
# archive tool's reports):
PROCESS_APPLICATION = "External Table Creation"
PROCESS_MERGE = "External Table Creation - Merge Applications"
MERGED_SCHEMA_PATH = "Merged Applications"
SKIP_REASON_EXISTS = "Table already exists and replace_existing is false"
NO_FILES_MESSAGE = "Parquet files not found in {path}"
SKIP_REASON_UNCHANGED = "Files unchanged since the table was published"
REPORT_NAME_TIME_FORMAT = "%d-%m-%Y_%H-%M-%S"
RUN_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("process", T.StringType(), False),
        T.StructField("schema_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("catalog_table", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("action", T.StringType(), True),
        T.StructField("skip_reason", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("schema_path", T.StringType(), True),
        T.StructField("table_path", T.StringType(), True),
        T.StructField("n_files", T.LongType(), True),
        T.StructField("n_bytes", T.LongType(), True),
        T.StructField("n_columns", T.IntegerType(), True),
        T.StructField("columns", T.ArrayType(T.StringType()), True),
        T.StructField("exposed_columns", T.ArrayType(T.StringType()), True),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("merge", T.BooleanType(), False),
        T.StructField("source_applications", T.ArrayType(T.StringType()), True),
        T.StructField("source_paths", T.ArrayType(T.StringType()), True),
        T.StructField("version", T.IntegerType(), True),
        T.StructField("source_root", T.StringType(), True),
        T.StructField("started_at", T.TimestampType(), True),
        T.StructField("finished_at", T.TimestampType(), True),
    ]
)

TOTALS_SCHEMA = "tables_total long, tables_succeeded long, tables_failed long, tables_skipped long"


def error_text(exc: BaseException) -> str:
    """Report text of a failure: the whole message."""
    return str(exc).strip()


def outcome(**fields) -> dict:
    """One report row as a dict; unspecified fields are NULL."""
    row = {f.name: None for f in REPORT_SCHEMA.fields}
    row["merge"] = False
    row.update(fields)
    if row["status"] not in STATUSES:
        raise ValueError(f"bad status {row['status']!r}")
    return row


def load_report(
    spark: SparkSession,
    outcomes: Iterable[Mapping],
    row_counts: DataFrame | None = None,
) -> DataFrame:
    """Per-table outcomes joined with the verified row counts.

    ``row_counts`` has (schema_name, table_name, row_count); counts are kept
    only for tables that were registered successfully.
    """
    names = [f.name for f in REPORT_SCHEMA.fields]
    rows = [tuple(o[n] for n in names) for o in outcomes]
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    if row_counts is None:
        return report
    counted = row_counts.select(
        "schema_name", "table_name", F.col("row_count").alias("_counted")
    )
    joined = report.join(counted, ["schema_name", "table_name"], "left")
    return joined.select(
        *[
            F.when(F.col("status") == "success", F.col("_counted")).alias("row_count")
            if n == "row_count"
            else F.col(n)
            for n in names
        ]
    )


def report_totals(report: DataFrame) -> DataFrame:
    """Run totals (succeeded, failed, skipped) in one aggregate."""
    return report.agg(
        F.count(F.lit(1)).alias("tables_total"),
        F.count_if(F.col("status") == "success").alias("tables_succeeded"),
        F.count_if(F.col("status") == "error").alias("tables_failed"),
        F.count_if(F.col("status") == "skipped").alias("tables_skipped"),
    )


def run_history(reports: DataFrame) -> DataFrame:
    """O24 over many runs: one row a table, from the reports of all runs (``read_report`` of their folder).

    (schema_name, table_name, n_runs, n_success, n_skipped, n_error, last_run, last_status, last_error,
    row_count): the last outcome by the run's start, and the rows of the last run that counted them. One
    aggregate with map-side combine, so neither a table with many runs nor a run with many tables is hot.
    """
    when = F.struct("started_at", "run_id")
    count = lambda status: F.count_if(F.col("status") == status)
    counted = F.when(F.col("row_count").isNotNull(), when)  # max_by leaves out rows whose ordering is null
    return reports.groupBy("schema_name", "table_name").agg(
        F.countDistinct("run_id").alias("n_runs"),
        count("success").alias("n_success"),
        count("skipped").alias("n_skipped"),
        count("error").alias("n_error"),
        F.max_by("run_id", when).alias("last_run"),
        F.max_by("status", when).alias("last_status"),
        F.max_by("error_message", when).alias("last_error"),
        F.max_by("row_count", counted).alias("row_count"),
    )


def report_name(prefix: str = "tablekeep", now: datetime | None = None, run_id: str | None = None) -> str:
    """Report folder name carrying the run's UTC time and id, so that runs of one second stay apart."""
    now = now or datetime.now(timezone.utc)
    return f"{prefix}-{now.strftime(REPORT_NAME_TIME_FORMAT)}-{run_id or uuid.uuid4().hex}"


def write_report(report: DataFrame, folder: str, name: str | None = None) -> str:
    """Write the report as JSON lines under ``folder/<name>``; returns the path."""
    path = f"{folder.rstrip('/')}/{name or report_name()}"
    report.write.mode("append").json(path)
    return path


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Read a written report back with its exact schema."""
    return spark.read.schema(REPORT_SCHEMA).json(path)


#: One row a file of a run's file list; ``status`` is that of its table in the run.
FILE_LIST_SCHEMA = (
    "schema_name string, table_name string, table_path string, file_path string, n_bytes long, "
    "modified_at timestamp, status string, listed_at timestamp, run_id string"
)
_TABLE_KEY = ["schema_name", "table_name", "table_path"]


def write_file_list(files: DataFrame, outcomes: Iterable[Mapping], folder: str) -> None:
    """Append the run's files (schema_name, table_name, table_path, file_path, n_bytes, modified_at) to ``folder``.

    ``outcomes`` are the run's finished report rows; files of tables without one are left out.
    """
    rows = [(o["schema_name"], o["table_name"], o["status"], o["started_at"], o["run_id"]) for o in outcomes]
    known = files.sparkSession.createDataFrame(rows, "schema_name string, table_name string, status string, listed_at timestamp, run_id string")
    listed = files.join(known, ["schema_name", "table_name"])
    names = [f.split()[0] for f in FILE_LIST_SCHEMA.split(", ")]
    listed.select(*names).write.mode("append").partitionBy("run_id").parquet(folder)


def read_file_list(spark: SparkSession, folder: str) -> DataFrame:
    """The file lists of all runs below ``folder``; empty where none has been written."""
    if not fs.is_dir(spark, folder):
        return spark.createDataFrame([], FILE_LIST_SCHEMA)
    return spark.read.schema(FILE_LIST_SCHEMA).parquet(folder)


def published_files(lists: DataFrame) -> DataFrame:
    """Of all file lists, the files that each table had when it was last published with success."""
    done = lists.filter("status = 'success'")
    last = done.groupBy(*_TABLE_KEY).agg(F.max(F.struct("listed_at", "run_id")).alias("last"))
    last = last.select(*_TABLE_KEY, F.col("last.run_id").alias("run_id"))
    return done.join(last, [*_TABLE_KEY, "run_id"], "left_semi")


def changed_tables(files: DataFrame, published: DataFrame) -> DataFrame:
    """One row for every table of ``files``: (schema_name, table_name, table_path, n_added, n_removed, n_changed).

    Files are matched by path, and changed when their size or time differs. The join is on the whole path, so a
    table with very many files is spread over all tasks, and the counts are combined before they are shuffled.
    """
    key = [*_TABLE_KEY, "file_path"]
    now = files.select(*key, F.struct("n_bytes", "modified_at").alias("now"))
    then = published.select(*key, F.struct("n_bytes", "modified_at").alias("then"))
    return (
        now.join(then, key, "full")
        .groupBy(*_TABLE_KEY)
        .agg(
            F.count_if(F.col("then").isNull()).alias("n_added"),
            F.count_if(F.col("now").isNull()).alias("n_removed"),
            F.count_if(F.col("now") != F.col("then")).alias("n_changed"),
            F.count("now").alias("n_now"),
        )
        .filter("n_now > 0")
        .drop("n_now")
    )


def _stamp(value) -> str | None:
    return value.strftime(RUN_TIME_FORMAT) if value is not None else None


def report_document(report: DataFrame) -> dict:
    """The report as one nested document: run fields, totals, schemas -> tables.

    Shaped like the archive tool's run report, with its key names plus our own (``run_id``, ``catalog_table``,
    ``parquet_bytes``, ``version``, ``total_tables_skipped``). The files of a
    table, of which there may be millions, are in the run's file list
    (``write_file_list``) under the same ``run_id``. The report has one row
    per table, so it is read to the driver whole.
    """
    rows = report.orderBy("schema_name", "table_name").collect()
    doc: dict = {}
    if rows:
        first = rows[0]
        doc["process"] = first.process
        doc["run_id"] = first.run_id
        doc["source_path"] = first.source_root if not first.merge else list(first.source_paths or [])
        doc["start_time"] = _stamp(first.started_at)
        doc["end_time"] = _stamp(first.finished_at)
    doc["total_tables_processed_successfully"] = sum(r.status == "success" for r in rows)
    doc["total_tables_errored_out"] = sum(r.status == "error" for r in rows)
    doc["total_tables_skipped"] = sum(r.status == "skipped" for r in rows)
    schemas: dict = {}
    for r in rows:
        schema = schemas.setdefault(r.schema_name, {"schema_folder_path": r.schema_path, "tables": {}})
        entry: dict = {"status": r.status}
        if r.catalog_table is not None:
            entry["catalog_table"] = r.catalog_table
        if r.n_files is not None:
            entry["parquet_files_count"] = r.n_files
            entry["parquet_bytes"] = r.n_bytes
        if r.columns is not None:
            entry["columns_count"] = r.n_columns
            entry["column_types"] = list(r.columns)
            entry["exposed_types"] = list(r.exposed_columns)
        if r.row_count is not None:
            entry["row_count"] = r.row_count
        if r.version is not None:
            entry["version"] = r.version
        if r.skip_reason is not None:
            entry["skip_reason"] = r.skip_reason
        if r.error_message is not None:
            entry["error_message"] = r.error_message
        if r.merge:
            entry["merge"] = True
            entry["source_applications"] = list(r.source_applications or [])
            entry["source_paths"] = list(r.source_paths or [])
        schema["tables"][r.table_name] = entry
    doc["schemas"] = schemas
    return doc


def write_report_document(report: DataFrame, folder: str, name: str | None = None) -> str:
    """O20 as one JSON document ``folder/<name>.json`` (only when a table was processed)."""
    path = f"{folder.rstrip('/')}/{name or report_name()}.json"
    fs.write_text(report.sparkSession, path, json.dumps(report_document(report), indent=4))
    return path
