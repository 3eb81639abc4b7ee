"""Row-count verification.

All tables are counted by ONE query: a Parquet scan over every table folder
with a dummy user schema, so no schema is inferred (sources with incompatible
types do not clash) and the scan's ``ReadSchema`` is empty — only row-group
metadata is read. Rows are counted per data file, keyed by the raw
``_metadata.file_path`` (partial aggregation in each task, one row per file
after the shuffle). Files are mapped to tables by an equi-join with the file
manifest on that same raw key, where the table of each file was derived once
per file. Nothing derived from the path is filtered on above the per-file
aggregate, so Catalyst has no path expression to push down into the per-row
scan: the per-row work stays one hash update.

A publish run, which knows its tables, counts them with ``footer_row_counts``:
the count is pushed into the scan of each table, and no row is made at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scoped_conf
from ..sources import fs
from ..sources.layout import TABLE_DIR_SCHEMA, TableDir, files_by_table, table_dirs
from ..sources.manifest import LISTING_OPTIONS, manifest_by_source

_DUMMY_SCHEMA = "`__tablekeep_none` int"

ROW_COUNT_SCHEMA = T.StructType(
    [
        T.StructField("schema_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)


def rows_per_file(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(encoded_path, n_rows) for every data file below ``paths``; no column is read."""
    qualified = [fs.qualify(spark, p) for p in paths]
    scan = (
        spark.read.schema(_DUMMY_SCHEMA)
        .options(**LISTING_OPTIONS)
        .parquet(*[fs.glob_escape(p) for p in qualified])
    )
    return scan.groupBy(F.col("_metadata.file_path").alias("encoded_path")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def row_counts_by_path(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(source_path, row_count) for each folder in ``paths``; empty folders count 0."""
    qualified = [fs.qualify(spark, p) for p in paths]
    requested = spark.createDataFrame([(p,) for p in qualified], "source_path string")
    if not qualified:
        return requested.withColumn("row_count", F.lit(0).cast("long"))
    with_files = [p for p in qualified if fs.is_dir(spark, p)]
    if not with_files:
        return requested.withColumn("row_count", F.lit(0).cast("long"))
    files = manifest_by_source(spark, with_files).select("encoded_path", "source_path")
    per_source = (
        rows_per_file(spark, with_files)
        .join(files, "encoded_path")
        .groupBy("source_path")
        .agg(F.sum("n_rows").alias("row_count"))
    )
    return requested.join(per_source, "source_path", "left").select(
        "source_path", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")
    )


def row_counts(
    spark: SparkSession,
    root: str,
    dirs: list[TableDir] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """(schema_name, table_name, row_count) for every table below ``root``.

    ``dirs`` limits the count to those table folders; ``files`` (from
    ``files_by_table``) reuses a manifest already listed. The result is lazy;
    on a large archive run its action under footer-sized splits, as a publish
    run does::

        with scoped_conf(spark, count_scan_conf(spark)):
            counts = row_counts(spark, root).collect()
    """
    root_q = fs.qualify(spark, root)
    dirs = table_dirs(spark, root_q) if dirs is None else dirs
    if not dirs:
        return spark.createDataFrame([], ROW_COUNT_SCHEMA)
    listed = spark.createDataFrame([astuple(d) for d in dirs], TABLE_DIR_SCHEMA)
    files = files_by_table(spark, root_q, dirs) if files is None else files
    files = files.select("encoded_path", "schema_dir", "table_dir")
    per_table = (
        rows_per_file(spark, [d.table_path for d in dirs])
        .join(files, "encoded_path")
        .groupBy("schema_dir", "table_dir")
        .agg(F.sum("n_rows").alias("row_count"))
    )
    return listed.join(per_table, ["schema_dir", "table_dir"], "left").select(
        "schema_name", "table_name", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")
    )


#: Tables counted in one query of ``footer_row_counts``.
FOOTER_TABLES = 64


def footer_scan_conf(spark: SparkSession) -> dict[str, str]:
    """Session settings under which Parquet counts are answered from row-group metadata."""
    v1 = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList", "").split(",") if s and s != "parquet"]
    return {"spark.sql.sources.useV1SourceList": ",".join(v1), "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(i, n) for the i-th folder, to be made and run under ``footer_scan_conf``: the count is pushed into
    the scan of each folder, so that a task gives one number a file and no row is ever made. Without any
    file ``n`` is null."""
    parts = []
    for i, path in enumerate(paths):
        scan = spark.read.format("parquet").schema(_DUMMY_SCHEMA).options(**LISTING_OPTIONS).load(fs.glob_escape(fs.qualify(spark, path)))
        parts.append(scan.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n"))
    return reduce(DataFrame.unionAll, parts)


def footer_row_counts(spark: SparkSession, root: str, dirs: list[TableDir] | None = None) -> DataFrame:
    """O21 from row-group metadata alone: (schema_name, table_name, row_count), counted now.

    Unlike ``row_counts`` (one lazy scan of all files, whose rows are counted by file), this runs a query
    for every ``FOOTER_TABLES`` tables and returns a local relation of one row a table. Empty folders count 0.
    """
    root_q = fs.qualify(spark, root)
    dirs = table_dirs(spark, root_q) if dirs is None else dirs
    rows = []
    with scoped_conf(spark, footer_scan_conf(spark)):
        for lo in range(0, len(dirs), FOOTER_TABLES):
            part = dirs[lo : lo + FOOTER_TABLES]
            rows += [(part[r.i].schema_name, part[r.i].table_name, r.n or 0) for r in footer_counts(spark, [d.table_path for d in part]).collect()]
    return spark.createDataFrame(rows, ROW_COUNT_SCHEMA)
