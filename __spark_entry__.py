"""

value-hash).

Every query first stages whole driver tables into the archive folder layouts
the publisher reads (``<app>/parquet/<TABLE>.parquet/``) under a fresh folder
of the shared work directory, then runs one operator on them. Applications are
split by ``orders.o_orderstatus`` (F, O, P), so the three together hold every
row. Published databases get a per-call prefix so repeated calls never collide.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # the package sits next to this file

from tablekeep import staging  # noqa: E402
from tablekeep.operators.counts import footer_row_counts, row_counts, row_counts_by_path
from tablekeep.operators.merge import merge_group, merge_tables
from tablekeep.operators.project import conform_types, describe_tables, drop_columns, parallel_map
from tablekeep.operators.report import read_file_list, read_report, report_totals, run_history, write_report
from tablekeep.plans.publish import publish_application, publish_merge
from tablekeep.plans.registration import (
    plan_registration,
    register_merged,
    register_table,
    registered_tables,
    replace_table,
)
from tablekeep.functions.names import catalog_name, database_name
from tablekeep.functions.types import quote
from tablekeep.sources import fs
from tablekeep.sources.layout import discover_tables, empty_tables, table_dirs
from tablekeep.sources.manifest import manifest_by_source
from tablekeep.sources.scan import scan_table, scan_tables

SMOKE_DIR = "/root/testdata/sf0.001"

REPORT_COLUMNS = ["schema_name", "table_name", "status", "action", "n_files", "n_columns", "row_count"]


def _ctx(spark: SparkSession, label: str) -> tuple[str, str]:
    """(fresh staging folder, unique database prefix)."""
    return staging.new_base(spark, label), f"q{uuid.uuid4().hex[:8]}_"


def _table(spark: SparkSession, prefix: str, schema: str, table: str) -> DataFrame:
    """A published table by its folder names (catalog names are normalised, then quoted)."""
    return spark.table(f"{quote(database_name(schema, prefix))}.{quote(catalog_name(table))}")


# ---------------------------------------------------------------- scans


def q_scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested sub-folder + junk files; recursive lookup reads exactly the data files."""
    base, _ = _ctx(spark, "scan_table")
    orders = staging.read_table(spark, sf_dir, "orders")
    path = f"{base}/app/parquet/ORDERS.parquet"
    staging.write_files(orders.filter(F.col("o_orderstatus").eqNullSafe("F")), path)
    staging.write_files(orders.filter(~F.col("o_orderstatus").eqNullSafe("F")), f"{path}/more/deeper")
    fs.write_text(spark, f"{path}/.partial.parquet", "junk")
    fs.write_text(spark, f"{path}/_temporary.parquet", "junk")
    return scan_table(spark, path)


def q_scan_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files disagree on columns; the missing column reads as NULL."""
    base, _ = _ctx(spark, "scan_merge_schema")
    return scan_table(spark, staging.stage_schema_drift(spark, sf_dir, base))


def q_scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key=value folders give the partition column back."""
    base, _ = _ctx(spark, "scan_partitioned")
    return scan_table(spark, staging.stage_partitioned(spark, sf_dir, base))


def q_scan_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 (+O6): one scan over three applications, provenance from the file path."""
    base, _ = _ctx(spark, "scan_tables")
    apps = staging.stage_applications(spark, sf_dir, base)
    df = scan_tables(spark, list(apps.values()), provenance={p: a for a, p in apps.items()})
    return drop_columns(df)


def q_scan_tables_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 as the merge read: one scan, merged schema, NULL where a source lacks a column."""
    base, _ = _ctx(spark, "scan_tables_missing")
    apps = staging.stage_applications(spark, sf_dir, base, drop_in={"appO": "o_orderpriority"})
    df = scan_tables(spark, list(apps.values()), provenance={p: a for a, p in apps.items()})
    return drop_columns(df)


# ---------------------------------------------------------------- projections


def q_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "drop_columns")
    path = staging.stage_table(spark, sf_dir, base, "orders", archive_column=True)
    return drop_columns(scan_table(spark, path))


def q_map_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "map_types")
    path = staging.stage_table(spark, sf_dir, base, "lineitem", archive_column=True)
    return conform_types(drop_columns(scan_table(spark, path)), "mapped")


def q_describe_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "describe_tables")
    root = staging.stage_archive(spark, sf_dir, base)
    return describe_tables(spark, discover_tables(spark, root)).drop("nullable", "error_message")


# ---------------------------------------------------------------- discovery


def q_discover_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "discover_tables")
    root = staging.stage_archive(spark, sf_dir, base)
    return discover_tables(spark, root).select("schema_name", "table_name", "n_files")


def q_empty_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "empty_tables")
    root = staging.stage_archive(spark, sf_dir, base)
    return empty_tables(spark, root).select("schema_name", "table_name")


def q_file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2/O3: one row per data file of every table folder, as its place in the layout.

    (schema_name, table_name, sub_folder): the folder a file sits in below its
    table folder ('' at the top). Paths themselves are temporary, so they are
    projected away; hidden and junk files must not appear.
    """
    base, _ = _ctx(spark, "file_manifest")
    root = staging.stage_archive(spark, sf_dir, base)
    dirs = table_dirs(spark, root)
    names = spark.createDataFrame(
        [(d.table_path, d.schema_name, d.table_name) for d in dirs], "source_path string, schema_name string, table_name string"
    )
    files = manifest_by_source(spark, [d.table_path for d in dirs]).join(names, "source_path")
    below = F.expr("substring(file_path, length(source_path) + 2)")
    return files.select("schema_name", "table_name", F.regexp_extract(below, r"^(.*)/[^/]+$", 1).alias("sub_folder"))


# ---------------------------------------------------------------- merge


def q_merge_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O13 joined with per-source file and row counts."""
    base, _ = _ctx(spark, "merge_group")
    apps = staging.stage_applications(spark, sf_dir, base)
    paths = list(apps.values())
    files = manifest_by_source(spark, paths).groupBy("source_path").agg(F.count(F.lit(1)).alias("n_files"))
    return (
        merge_group(spark, paths)
        .join(files, "source_path")
        .join(row_counts_by_path(spark, paths), "source_path")
        .select("source_application", "table_name", "n_files", "row_count")
    )


def q_merge_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "merge_tables")
    apps = staging.stage_applications(spark, sf_dir, base)
    return merge_tables(spark, list(apps.values()))


def q_merge_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "merge_missing_columns")
    apps = staging.stage_applications(spark, sf_dir, base, drop_in={"appO": "o_orderpriority"})
    return merge_tables(spark, list(apps.values()))


def q_merge_type_conflict_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B19 with on_conflict='text': int in one source, bigint in others -> text."""
    base, _ = _ctx(spark, "merge_type_conflict")
    apps = staging.stage_applications(spark, sf_dir, base, cast_in={"appO": ("o_custkey", "int")})
    return merge_tables(spark, list(apps.values()), on_conflict="text")


# ---------------------------------------------------------------- counts


def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "row_counts")
    root = staging.stage_archive(spark, sf_dir, base)
    return row_counts(spark, root)


def q_row_counts_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O21 over a root whose child schemas are the three applications."""
    base, _ = _ctx(spark, "row_counts_apps")
    staging.stage_applications(spark, sf_dir, base)
    return row_counts(spark, base)


def q_row_counts_hot_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O21 with a hot source: documents per language as schemas ('en' holds most rows)."""
    base, _ = _ctx(spark, "row_counts_hot")
    staging.stage_split(spark, sf_dir, base, "documents", "lang", app_prefix="docs_")
    return row_counts(spark, base)


# ---------------------------------------------------------------- registration


def q_plan_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "plan_registration")
    root = staging.stage_archive(spark, sf_dir, base)
    tables = discover_tables(spark, root)
    for r in tables.filter(F.col("table_name").isin("REGION", "ORDERS")).collect():
        register_table(spark, r.schema_name, r.table_name, r.table_path, database_prefix=prefix, database_location=base)
    return plan_registration(spark, tables, replace_existing=False, database_prefix=prefix).select(
        "schema_name", "table_name", "exists", "action"
    )


def q_register_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "register_table")
    path = staging.stage_table(spark, sf_dir, base, "orders", archive_column=True)
    reg = register_table(spark, "shop", "ORDERS", path, database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_register_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "register_mapped")
    path = staging.stage_table(spark, sf_dir, base, "lineitem", archive_column=True)
    reg = register_table(spark, "shop", "LINEITEM", path, policy="mapped", database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_register_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "register_partitioned")
    path = staging.stage_partitioned(spark, sf_dir, base)
    reg = register_table(spark, "shop", "ORDERS", path, database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v1 holds two columns of orders, v2 all of them; the view ends on v2."""
    base, prefix = _ctx(spark, "replace_table")
    v1 = staging.stage_table(spark, sf_dir, base, "orders", app="v1", columns=["o_orderkey", "o_custkey"])
    v2 = staging.stage_table(spark, sf_dir, base, "orders", app="v2", archive_column=True)
    register_table(spark, "shop", "ORDERS", v1, database_prefix=prefix, database_location=base)
    reg = replace_table(spark, "shop", "ORDERS", v2, database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_skip_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second publish with replace_existing=False leaves the table alone."""
    base, prefix = _ctx(spark, "skip_existing")
    staging.stage_table(spark, sf_dir, f"{base}/one", "orders", app="shop", archive_column=True)
    staging.stage_table(spark, sf_dir, f"{base}/two", "customer", app="shop", table="ORDERS")
    publish_application(spark, f"{base}/one", database_prefix=prefix, database_location=base)
    publish_application(spark, f"{base}/two", database_prefix=prefix, database_location=base)
    return _table(spark, prefix, "shop", "orders")


def q_register_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "register_merged")
    apps = staging.stage_applications(spark, sf_dir, base)
    reg = register_merged(spark, "merged", list(apps.values()), database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_register_merged_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O19 + O7: the merged view under the mapped type policy."""
    base, prefix = _ctx(spark, "register_merged_mapped")
    apps = staging.stage_applications(spark, sf_dir, base)
    reg = register_merged(
        spark, "merged", list(apps.values()), policy="mapped", database_prefix=prefix, database_location=base
    )
    return spark.table(reg.quoted)


def q_register_merged_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark SQL over the merged view: per-application aggregates."""
    base, prefix = _ctx(spark, "register_merged_summary")
    apps = staging.stage_applications(spark, sf_dir, base, drop_in={"appP": "o_orderpriority"})
    reg = register_merged(spark, "merged", list(apps.values()), database_prefix=prefix, database_location=base)
    return spark.sql(
        f"""
        SELECT source_application,
               count(*) AS n_rows,
               sum(o_orderkey) AS sum_orderkey,
               count(o_orderpriority) AS n_priority,
               min(o_orderdate) AS first_order,
               max(o_orderdate) AS last_order
        FROM {reg.quoted}
        GROUP BY source_application
        """
    )


# ---------------------------------------------------------------- jobs and report


def q_publish_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "publish_application")
    root = staging.stage_archive(spark, sf_dir, base)
    report = publish_application(spark, root, verify_row_count=True, database_prefix=prefix, database_location=base)
    return report.select(*REPORT_COLUMNS)


def q_publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "publish_replace")
    root = staging.stage_archive(spark, sf_dir, base)
    publish_application(spark, root, database_prefix=prefix, database_location=base)
    report = publish_application(
        spark, root, replace_existing=True, verify_row_count=True, database_prefix=prefix, database_location=base
    )
    return report.select(*REPORT_COLUMNS, "version")


def q_publish_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "publish_merge")
    apps = staging.stage_applications(spark, sf_dir, base)
    report = publish_merge(
        spark, list(apps.values()), "merged", verify_row_count=True, database_prefix=prefix, database_location=base
    )
    return report.select(
        *REPORT_COLUMNS, "merge", F.array_join("source_applications", ",").alias("source_applications")
    )


def q_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "report_totals")
    root = staging.stage_archive(spark, sf_dir, base)
    return report_totals(
        publish_application(spark, root, verify_row_count=True, database_prefix=prefix, database_location=base)
    )


def q_write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "write_report")
    root = staging.stage_archive(spark, sf_dir, base)
    report = publish_application(spark, root, verify_row_count=True, database_prefix=prefix, database_location=base)
    path = write_report(report, f"{base}/reports")
    return read_report(spark, path).select(*REPORT_COLUMNS)


# ---------------------------------------------------------------- other driver tables, whole texts


def q_scan_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4 over raw web pages: every html text read back whole."""
    base, _ = _ctx(spark, "scan_pages")
    return scan_table(spark, staging.stage_table(spark, sf_dir, base, "pages"))


def q_map_types_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _ctx(spark, "map_types_events")
    path = staging.stage_table(spark, sf_dir, base, "events", archive_column=True)
    return conform_types(drop_columns(scan_table(spark, path)), "mapped")


def q_merge_documents_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O14 with a hot source: ``documents`` split by language (most rows are 'en')."""
    base, _ = _ctx(spark, "merge_documents")
    apps = staging.stage_split(spark, sf_dir, base, "documents", "lang", app_prefix="docs_")
    return merge_tables(spark, list(apps.values()))


def q_register_merged_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "merged_conversations")
    apps = staging.stage_split(spark, sf_dir, base, "conversations", "role", app_prefix="chat_")
    reg = register_merged(spark, "chats", list(apps.values()), database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_register_documents_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O17 + O7 over whole documents: bigint ids exposed as text, texts untouched."""
    base, prefix = _ctx(spark, "register_documents")
    path = staging.stage_table(spark, sf_dir, base, "documents", archive_column=True)
    reg = register_table(spark, "corpus", "DOCUMENTS", path, policy="mapped", database_prefix=prefix, database_location=base)
    return spark.table(reg.quoted)


def q_merge_embeddings_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O14 with ten sources (one per label) carrying float arrays."""
    base, _ = _ctx(spark, "merge_embeddings")
    apps = staging.stage_split(spark, sf_dir, base, "embeddings", "label", app_prefix="emb_")
    return merge_tables(spark, list(apps.values()))


def q_publish_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O25 over every driver table in one application root."""
    base, prefix = _ctx(spark, "publish_all_tables")
    root, _ = staging.stage_all_tables(spark, sf_dir, base)
    report = publish_application(spark, root, verify_row_count=True, database_prefix=prefix, database_location=base)
    return report.select("schema_name", "table_name", "status", "action", "n_columns", "row_count")


def _stage_mixed(spark: SparkSession, sf_dir: str, base: str, app: str = "app") -> str:
    """``orders``: F orders flat, O orders in ``o_orderstatus=O/``, the others in a plain sub-folder."""
    orders = staging.read_table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    path = f"{base}/{app}/parquet/ORDERS.parquet"
    staging.write_files(orders.filter(status.eqNullSafe("F")), path)
    staging.write_files(orders.filter(status.eqNullSafe("O")).drop("o_orderstatus"), f"{path}/o_orderstatus=O")
    staging.write_files(orders.filter(~status.eqNullSafe("F") & ~status.eqNullSafe("O")), f"{path}/more")
    return path


def q_scan_mixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat, plain and key=value folders in one table; no row is lost and the key is filled in."""
    base, _ = _ctx(spark, "scan_mixed")
    return scan_table(spark, _stage_mixed(spark, sf_dir, base))


def q_register_mixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, prefix = _ctx(spark, "register_mixed")
    path = _stage_mixed(spark, sf_dir, base)
    register_table(spark, "app", "ORDERS", path, database_prefix=prefix, database_location=base)
    return _table(spark, prefix, "app", "ORDERS")


def q_publish_merge_mixed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O26 over two applications of mixed layout, with verified counts."""
    base, prefix = _ctx(spark, "merge_mixed")
    paths = [_stage_mixed(spark, sf_dir, base, app) for app in ("app1", "app2")]
    report = publish_merge(spark, paths, "merged", verify_row_count=True, database_prefix=prefix, database_location=base)
    return report.select("schema_name", "table_name", "status", "n_columns", "row_count")


def q_publish_versioned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders ``ORDERS`` and ``ORDERS__V1``, published three times; what is registered, with its rows."""
    base, prefix = _ctx(spark, "versioned_names")
    orders = staging.read_table(spark, sf_dir, "orders")
    path = f"{base}/shop/parquet"
    staging.write_files(orders, f"{path}/ORDERS.parquet")
    staging.write_files(orders.filter(F.col("o_orderstatus").eqNullSafe("F")), f"{path}/ORDERS__V1.parquet")
    for _ in range(3):
        report = publish_application(
            spark, f"{base}/shop", replace_existing=True, verify_row_count=True, database_prefix=prefix, database_location=base
        )
    listed = registered_tables(spark, [database_name("shop", prefix)]).select("table_name", "version")
    return listed.join(report.select("table_name", "status", "action", "row_count"), "table_name")


def q_replace_at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight replaces of one table at the same time, each by another copy of ``orders``; the view
    serves one of them whole."""
    base, prefix = _ctx(spark, "replace_at_once")
    copies = [staging.stage_table(spark, sf_dir, base, "orders", app=f"v{i}", archive_column=True) for i in range(4)]
    done = parallel_map(
        spark, lambda p: register_table(spark, "shop", "ORDERS", p, database_prefix=prefix, database_location=base), copies * 2, 4
    )
    for one in done:
        if isinstance(one, Exception):
            raise one
    return _table(spark, prefix, "shop", "orders")


def q_row_counts_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O21 with the counts pushed into the scans."""
    base, _ = _ctx(spark, "row_counts_footers")
    return footer_row_counts(spark, staging.stage_archive(spark, sf_dir, base))


def q_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O24 over two runs: the second skips what the first has published."""
    base, prefix = _ctx(spark, "run_history")
    root = staging.stage_archive(spark, sf_dir, base)
    for _ in range(2):
        publish_application(
            spark, root, verify_row_count=True, database_prefix=prefix, database_location=base, report_path=f"{base}/reports"
        )
    reports = read_report(spark, f"{base}/reports/*")
    return run_history(reports).drop("last_run", "last_error")


def _stage_years(spark: SparkSession, sf_dir: str, base: str) -> dict[str, str]:
    """``orders`` by priority: 1-URGENT in ``order_year=`` folders alone, 2-HIGH in such folders except for
    the F orders, which lie flat, the others without any folder; ``order_year`` is a date."""
    orders = staging.read_table(spark, sf_dir, "orders")
    year = F.trunc("o_orderdate", "year").alias("order_year")
    one, two = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    flat = F.col("o_orderstatus").eqNullSafe("F")
    paths = {app: f"{base}/{app}/parquet/ORDERS.parquet" for app in ("years", "mixed", "flat")}
    for app, rows in (("years", orders.filter(one)), ("mixed", orders.filter(two & ~flat))):
        rows.select("*", year).repartition("order_year").write.partitionBy("order_year").parquet(paths[app])
    staging.write_files(orders.filter(two & flat), f"{paths['mixed']}/rest")
    staging.write_files(orders.filter(F.coalesce(~one & ~two, F.lit(True))), paths["flat"])
    return paths


def q_merge_mixed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O14 over sources whose key folders differ: the key is a date in each."""
    base, _ = _ctx(spark, "merge_mixed_keys")
    return merge_tables(spark, list(_stage_years(spark, sf_dir, base).values()))


def q_scan_tables_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 over the same sources: one scan, with the key and the source label from the files' paths."""
    base, _ = _ctx(spark, "scan_tables_partitioned")
    apps = _stage_years(spark, sf_dir, base)
    return scan_tables(spark, list(apps.values()), provenance={p: a for a, p in apps.items()})


def q_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every table in the file list of a run."""
    base, prefix = _ctx(spark, "report_files")
    root = staging.stage_archive(spark, sf_dir, base)
    publish_application(spark, root, database_prefix=prefix, database_location=base, files_path=f"{base}/files")
    files = read_file_list(spark, f"{base}/files")
    return files.groupBy("schema_name", "table_name", "status").agg(F.countDistinct("file_path").alias("n_files"))


def q_publish_only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second publication after ORDERS has got its rows once more; what was replaced, with its rows."""
    base, prefix = _ctx(spark, "only_changed")
    root = staging.stage_archive(spark, sf_dir, base)
    options = dict(replace_existing=True, verify_row_count=True, database_prefix=prefix, database_location=base, files_path=f"{base}/files")
    publish_application(spark, root, **options)
    orders = discover_tables(spark, root).filter("table_name = 'ORDERS'").first()
    staging.write_files(staging.read_table(spark, sf_dir, "orders"), f"{orders.table_path}/again", scan=True)
    report = publish_application(spark, root, only_changed=True, **options)
    return report.select("schema_name", "table_name", "status", "action", "row_count")


# ---------------------------------------------------------------- contract


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: publish a staged application root at sf0.001 and return its report."""
    return q_publish_application(spark, SMOKE_DIR)


def training_data():
    """The module of the training-data queries, or None where that subpackage is left out."""
    try:
        import corpus_pipeline  # noqa: F401
        from tablekeep.llm import queries as module
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tablekeep.llm"):
            raise
        return None
    return module


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    module = training_data()
    return core_queries() | (module.QUERIES if module else {})


def oracle_sql() -> dict[str, str]:
    module = training_data()
    return core_oracles() | (module.ORACLES if module else {})


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_table": q_scan_table,
        "scan_merge_schema": q_scan_merge_schema,
        "scan_partitioned": q_scan_partitioned,
        "scan_tables": q_scan_tables,
        "scan_tables_missing_column": q_scan_tables_missing_column,
        "drop_columns": q_drop_columns,
        "map_types": q_map_types,
        "describe_tables": q_describe_tables,
        "discover_tables": q_discover_tables,
        "empty_tables": q_empty_tables,
        "file_manifest": q_file_manifest,
        "merge_group": q_merge_group,
        "merge_tables": q_merge_tables,
        "merge_missing_columns": q_merge_missing_columns,
        "merge_type_conflict_text": q_merge_type_conflict_text,
        "row_counts": q_row_counts,
        "row_counts_apps": q_row_counts_apps,
        "row_counts_hot_source": q_row_counts_hot_source,
        "plan_registration": q_plan_registration,
        "register_table": q_register_table,
        "register_mapped": q_register_mapped,
        "register_partitioned": q_register_partitioned,
        "replace_table": q_replace_table,
        "skip_existing": q_skip_existing,
        "register_merged": q_register_merged,
        "register_merged_summary": q_register_merged_summary,
        "register_merged_mapped": q_register_merged_mapped,
        "publish_application": q_publish_application,
        "publish_replace": q_publish_replace,
        "publish_merge": q_publish_merge,
        "report_totals": q_report_totals,
        "write_report": q_write_report,
        "scan_pages": q_scan_pages,
        "map_types_events": q_map_types_events,
        "merge_documents_by_lang": q_merge_documents_by_lang,
        "register_merged_conversations": q_register_merged_conversations,
        "publish_all_tables": q_publish_all_tables,
        "register_documents_mapped": q_register_documents_mapped,
        "merge_embeddings_by_label": q_merge_embeddings_by_label,
        "scan_mixed_layout": q_scan_mixed_layout,
        "register_mixed_layout": q_register_mixed_layout,
        "publish_merge_mixed_layout": q_publish_merge_mixed_layout,
        "publish_versioned_names": q_publish_versioned_names,
        "replace_at_once": q_replace_at_once,
        "row_counts_footers": q_row_counts_footers,
        "run_history": q_run_history,
        "merge_mixed_keys": q_merge_mixed_keys,
        "scan_tables_partitioned": q_scan_tables_partitioned,
        "report_files": q_report_files,
        "publish_only_changed": q_publish_only_changed,
    }


# ---------------------------------------------------------------- oracles

_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_APP = "'app' || o_orderstatus AS source_application"

_LINEITEM_MAPPED = """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey,
       CAST(l_partkey AS VARCHAR) AS l_partkey,
       CAST(l_suppkey AS VARCHAR) AS l_suppkey,
       l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus,
       CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem
"""

_KEYED_ORDERS = """
SELECT *, CASE WHEN o_orderpriority = '1-URGENT' OR (o_orderpriority = '2-HIGH' AND coalesce(o_orderstatus, '') <> 'F')
       THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS order_year,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'years' WHEN '2-HIGH' THEN 'mixed' ELSE 'flat' END AS source_application
FROM orders
"""

# Staged archive layout: (schema, TABLE, driver table, columns).
_ARCHIVE = [
    ("archive", "REGION", "region", 2),
    ("archive", "NATION", "nation", 3),
    ("archive", "CUSTOMER", "customer", 5),
    ("archive_SALES", "ORDERS", "orders", 6),
    ("archive_SALES", "LINEITEM", "lineitem", 11),
    ("archive_PARTS", "PART", "part", 6),
    ("archive_PARTS", "SUPPLIER", "supplier", 4),
]
_R = staging.ROWS_PER_FILE


def _files(rows_sql: str) -> str:
    """Part files staged for a row count: ceil(rows / ROWS_PER_FILE), at least one."""
    return f"greatest(1, ceil(({rows_sql}) / {_R}.0))"


def _files_sql(table: str) -> str:
    """Expected data files of a staged archive table (ORDERS keeps its F orders in a sub-folder)."""
    if table == "ORDERS":
        f_rows = "sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)"
        other_rows = "sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END)"
        return f"CAST({_files(f_rows)} + {_files(other_rows)} AS BIGINT)"
    return f"CAST({_files('count(*)')} AS BIGINT)"


def _report_sql(action: str, with_version: bool = False) -> str:
    version = ", 2 AS version" if with_version else ""
    empty_version = ", CAST(NULL AS INTEGER) AS version" if with_version else ""
    parts = [
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, 'success' AS status, '{action}' AS action, "
        f"{_files_sql(t)} AS n_files, {c} AS n_columns, count(*) AS row_count{version} FROM {src}"
        for s, t, src, c in _ARCHIVE
    ]
    parts.append(
        "SELECT 'archive_PARTS' AS schema_name, 'EMPTY' AS table_name, 'error' AS status, "
        "CAST(NULL AS VARCHAR) AS action, CAST(0 AS BIGINT) AS n_files, CAST(NULL AS INTEGER) AS n_columns, "
        f"CAST(NULL AS BIGINT) AS row_count{empty_version}"
    )
    return "\nUNION ALL\n".join(parts)


def _discover_sql() -> str:
    parts = [
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, {_files_sql(t)} AS n_files FROM {src}"
        for s, t, src, _ in _ARCHIVE
    ]
    parts.append("SELECT 'archive_PARTS', 'EMPTY', CAST(0 AS BIGINT)")
    return "\nUNION ALL\n".join(parts)


def _row_counts_sql() -> str:
    parts = [
        f"SELECT '{s}' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM {src}"
        for s, t, src, _ in _ARCHIVE
    ]
    parts.append("SELECT 'archive_PARTS', 'EMPTY', CAST(0 AS BIGINT)")
    return "\nUNION ALL\n".join(parts)


def _manifest_sql() -> str:
    """One row per staged data file: ceil(rows / ROWS_PER_FILE) files per folder."""

    def files_of(schema: str, table: str, sub: str, src: str, rows_sql: str) -> str:
        return (
            f"SELECT '{schema}' AS schema_name, '{table}' AS table_name, '{sub}' AS sub_folder "
            f"FROM (SELECT unnest(range(CAST({_files(rows_sql)} AS BIGINT))) AS i FROM {src})"
        )

    parts = []
    for s, t, src, _ in _ARCHIVE:
        if t == "ORDERS":
            parts.append(files_of(s, t, "", src, "sum(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END)"))
            parts.append(files_of(s, t, "batch_F", src, "sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)"))
        else:
            parts.append(files_of(s, t, "", src, "count(*)"))
    return "\nUNION ALL\n".join(parts)


def _describe_sql() -> str:
    schema_of = " ".join(f"WHEN '{src}' THEN '{s}'" for s, _, src, _ in _ARCHIVE)
    names = ", ".join(f"'{src}'" for _, _, src, _ in _ARCHIVE)
    return f"""
SELECT CASE table_name {schema_of} END AS schema_name,
       upper(table_name) AS table_name,
       CAST(ordinal_position AS INTEGER) AS ordinal,
       column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                      WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS spark_type,
       CASE data_type WHEN 'INTEGER' THEN 'INTEGER' WHEN 'DOUBLE' THEN 'DOUBLE PRECISION' ELSE 'TEXT' END
           AS declared_type
FROM information_schema.columns
WHERE table_name IN ({names}) AND table_schema = current_schema()
"""


_DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def _publish_all_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT 'warehouse' AS schema_name, '{t.upper()}' AS table_name, 'success' AS status, "
        f"'create' AS action, (SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns "
        f"WHERE table_name = '{t}' AND table_schema = current_schema()) AS n_columns, count(*) AS row_count FROM {t}"
        for t in _DRIVER_TABLES
    )


def core_oracles() -> dict[str, str]:
    merged = f"SELECT {_ORDERS}, {_APP} FROM orders"
    return {
        "scan_table": "SELECT * FROM orders",
        "scan_merge_schema": (
            "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
            "CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority FROM orders"
        ),
        "scan_partitioned": "SELECT * FROM orders",
        "scan_tables": merged,
        "scan_tables_missing_column": (
            "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
            f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority, {_APP} FROM orders"
        ),
        "drop_columns": "SELECT * FROM orders",
        "map_types": _LINEITEM_MAPPED,
        "describe_tables": _describe_sql(),
        "discover_tables": _discover_sql(),
        "empty_tables": "SELECT 'archive_PARTS' AS schema_name, 'EMPTY' AS table_name",
        "file_manifest": _manifest_sql(),
        "merge_group": (
            f"SELECT {_APP}, 'ORDERS' AS table_name, CAST({_files('count(*)')} AS BIGINT) AS n_files, "
            "count(*) AS row_count FROM orders GROUP BY o_orderstatus"
        ),
        "merge_tables": merged,
        "merge_missing_columns": (
            "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
            f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority, {_APP} FROM orders"
        ),
        "merge_type_conflict_text": (
            "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, "
            f"o_orderdate, o_orderpriority, {_APP} FROM orders"
        ),
        "row_counts": _row_counts_sql(),
        "row_counts_apps": (
            "SELECT 'app' || o_orderstatus AS schema_name, 'ORDERS' AS table_name, count(*) AS row_count "
            "FROM orders GROUP BY o_orderstatus"
        ),
        "row_counts_hot_source": (
            "SELECT 'docs_' || lang AS schema_name, 'DOCUMENTS' AS table_name, count(*) AS row_count "
            "FROM documents GROUP BY lang"
        ),
        "plan_registration": "SELECT * FROM (VALUES "
        + ", ".join(
            f"('{s}', '{t}', {str(t in ('REGION', 'ORDERS')).upper()}, "
            f"'{'skip' if t in ('REGION', 'ORDERS') else 'create'}')"
            for s, t, _, _ in _ARCHIVE
        )
        + ", ('archive_PARTS', 'EMPTY', FALSE, 'create')) AS t(schema_name, table_name, \"exists\", action)",
        "register_table": "SELECT * FROM orders",
        "register_mapped": _LINEITEM_MAPPED,
        "register_partitioned": "SELECT * FROM orders",
        "replace_table": "SELECT * FROM orders",
        "skip_existing": "SELECT * FROM orders",
        "register_merged": merged,
        "register_merged_mapped": (
            "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
            "o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, "
            f"{_APP} FROM orders"
        ),
        "register_merged_summary": (
            f"SELECT {_APP}, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_orderkey, "
            "count(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS n_priority, "
            "min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_orderstatus"
        ),
        "publish_application": _report_sql("create"),
        "publish_replace": _report_sql("replace", with_version=True),
        "publish_merge": (
            "SELECT 'merged' AS schema_name, 'ORDERS' AS table_name, 'success' AS status, 'create' AS action, "
            f"(SELECT CAST(sum({_files('c')}) AS BIGINT) FROM (SELECT count(*) AS c FROM orders "
            "GROUP BY o_orderstatus)) AS n_files, 6 AS n_columns, count(*) AS row_count, TRUE AS merge, "
            "'appF,appO,appP' AS source_applications FROM orders"
        ),
        "report_totals": (
            "SELECT CAST(8 AS BIGINT) AS tables_total, CAST(7 AS BIGINT) AS tables_succeeded, "
            "CAST(1 AS BIGINT) AS tables_failed, CAST(0 AS BIGINT) AS tables_skipped"
        ),
        "write_report": _report_sql("create"),
        "scan_pages": "SELECT * FROM pages",
        "map_types_events": (
            "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, "
            "CAST(user_id AS VARCHAR) AS user_id, event_type, value, props FROM events"
        ),
        "merge_documents_by_lang": (
            "SELECT doc_id, text, lang, source, n_chars, 'docs_' || lang AS source_application FROM documents"
        ),
        "register_merged_conversations": (
            "SELECT conv_id, turn, role, text, 'chat_' || role AS source_application FROM conversations"
        ),
        "publish_all_tables": _publish_all_sql(),
        "register_documents_mapped": (
            "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, "
            "CAST(n_chars AS VARCHAR) AS n_chars FROM documents"
        ),
        "merge_embeddings_by_label": (
            "SELECT vec_id, embedding, label, 'emb_' || CAST(label AS VARCHAR) AS source_application FROM embeddings"
        ),
        "scan_mixed_layout": "SELECT * FROM orders",
        "register_mixed_layout": "SELECT * FROM orders",
        "publish_merge_mixed_layout": (
            "SELECT 'merged' AS schema_name, 'ORDERS' AS table_name, 'success' AS status, 6 AS n_columns, "
            "2 * count(*) AS row_count FROM orders"
        ),
        "publish_versioned_names": (
            "SELECT 'ORDERS' AS table_name, 3 AS version, 'success' AS status, 'replace' AS action, count(*) AS row_count FROM orders "
            "UNION ALL SELECT 'ORDERS__V1', 3, 'success', 'replace', count(*) FROM orders WHERE o_orderstatus = 'F'"
        ),
        "replace_at_once": "SELECT * FROM orders",
        "merge_mixed_keys": _KEYED_ORDERS,
        "scan_tables_partitioned": _KEYED_ORDERS,
        "report_files": (
            f"SELECT schema_name, table_name, 'success' AS status, count(*) AS n_files FROM ({_manifest_sql()}) GROUP BY ALL"
        ),
        "publish_only_changed": (
            "SELECT schema_name, table_name, CASE table_name WHEN 'EMPTY' THEN 'error' WHEN 'ORDERS' THEN 'success' ELSE 'skipped' END AS status, "
            "CASE table_name WHEN 'EMPTY' THEN NULL WHEN 'ORDERS' THEN 'replace' ELSE 'skip' END AS action, "
            f"CASE table_name WHEN 'ORDERS' THEN 2 * row_count END AS row_count FROM ({_row_counts_sql()})"
        ),
        "row_counts_footers": _row_counts_sql(),
        "run_history": (
            "SELECT *, CAST(2 AS BIGINT) AS n_runs, CAST(CASE WHEN row_count IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_success, "
            "CAST(CASE WHEN row_count IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_skipped, "
            "CAST(CASE WHEN row_count IS NULL THEN 2 ELSE 0 END AS BIGINT) AS n_error, "
            "CASE WHEN row_count IS NULL THEN 'error' ELSE 'skipped' END AS last_status "
            f"FROM (SELECT schema_name, table_name, CASE WHEN table_name <> 'EMPTY' THEN row_count END AS row_count FROM ({_row_counts_sql()}))"
        ),
    }
