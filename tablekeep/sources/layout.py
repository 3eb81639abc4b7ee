"""Archive layout discovery.

An application root holds schema folders; a schema folder holds ``parquet/``
with one ``<TABLE>.parquet/`` folder per table::

    root/parquet/<T>.parquet/**          the root itself is a schema
    root/<S>/parquet/<T>.parquet/**      child schema <S> (a child named
                                         ``parquet`` is never a schema)

A schema is valid when its ``parquet/`` folder holds at least one
``*.parquet`` *folder* (O10); flat files directly under ``parquet/`` are not
tables. The table folders come from two Hadoop globs (driver, metadata only:
one listing per schema folder); the data files below them come from one
parallel Spark listing for the whole root, aggregated per table.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths as P
from . import fs
from .manifest import file_manifest


@dataclass(frozen=True)
class TableDir:
    schema_name: str
    table_name: str
    schema_path: str
    table_path: str
    schema_dir: str  # "" for the root schema, else the child folder name
    table_dir: str  # "<T>.parquet"


TABLE_DIR_SCHEMA = T.StructType(
    [
        T.StructField("schema_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("schema_path", T.StringType(), False),
        T.StructField("table_path", T.StringType(), False),
        T.StructField("schema_dir", T.StringType(), False),
        T.StructField("table_dir", T.StringType(), False),
    ]
)


class DuplicateTableError(ValueError):
    """Two table folders resolve to the same (schema, table) pair."""


def _stem(name: str) -> str:
    return name[: -len(P.SUFFIX)] if name.endswith(P.SUFFIX) and name != P.SUFFIX else name


def table_dirs(spark: SparkSession, root: str) -> list[TableDir]:
    """All table folders of an application root, root schema first."""
    root_q = fs.qualify(spark, root)
    if not fs.is_dir(spark, root_q):
        raise FileNotFoundError(f"{root} does not exist or is not a directory")
    root_name = root_q.rstrip("/").rsplit("/", 1)[-1]
    base = fs.glob_escape(root_q)
    found: list[TableDir] = []
    for entry in sorted(fs.glob_dirs(spark, f"{base}/{P.PARQUET_DIR}/*{P.SUFFIX}"), key=lambda e: e.name):
        found.append(
            TableDir(root_name, _stem(entry.name), root_q, entry.path, "", entry.name)
        )
    children = fs.glob_dirs(spark, f"{base}/*/{P.PARQUET_DIR}/*{P.SUFFIX}")
    for entry in sorted(children, key=lambda e: e.path):
        rel = entry.path[len(root_q) + 1 :].split("/")
        if len(rel) != 3 or rel[0] == P.PARQUET_DIR:
            continue
        found.append(
            TableDir(rel[0], _stem(entry.name), f"{root_q}/{rel[0]}", entry.path, rel[0], entry.name)
        )
    dupes = [k for k, n in Counter((t.schema_name, t.table_name) for t in found).items() if n > 1]
    if dupes:
        raise DuplicateTableError(
            "table folders resolve to the same schema and table: "
            + ", ".join(f"{s}.{t}" for s, t in sorted(dupes))
        )
    return found


def table_dirs_df(spark: SparkSession, root: str) -> DataFrame:
    return spark.createDataFrame([astuple(t) for t in table_dirs(spark, root)], TABLE_DIR_SCHEMA)


def files_by_table(spark: SparkSession, root: str, dirs: list[TableDir] | None = None) -> DataFrame:
    """Manifest of every table folder below ``root`` tagged with its layout keys."""
    root_q = fs.qualify(spark, root)
    dirs = table_dirs(spark, root) if dirs is None else dirs
    manifest = file_manifest(spark, [t.table_path for t in dirs])
    keys = P.layout_keys(P.relative_to(F.col("file_path"), root_q))
    return (
        manifest.select("*", *[c.alias(k) for k, c in keys.items()])
        .filter(F.col("in_table"))
        .drop("in_table")
    )


def discover_tables(
    spark: SparkSession,
    root: str,
    dirs: list[TableDir] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """O1 + O22: one row per table folder with its data-file count and size.

    (schema_name, table_name, schema_path, table_path, n_files, n_bytes);
    a table folder without data files has ``n_files = 0``. ``dirs`` and
    ``files`` (from :func:`files_by_table`) can be passed to reuse a listing.
    """
    dirs = table_dirs(spark, root) if dirs is None else dirs
    files = files_by_table(spark, root, dirs) if files is None else files
    per_table = (
        files.groupBy("schema_dir", "table_dir")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
    )
    listed = spark.createDataFrame([astuple(t) for t in dirs], TABLE_DIR_SCHEMA)
    return listed.join(per_table, ["schema_dir", "table_dir"], "left").select(
        "schema_name",
        "table_name",
        "schema_path",
        "table_path",
        F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
        F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"),
    )


def discover_schemas(spark: SparkSession, root: str) -> DataFrame:
    """Valid schema folders (O10): those holding at least one table folder."""
    return (
        table_dirs_df(spark, root)
        .groupBy("schema_name", "schema_path")
        .agg(F.count(F.lit(1)).alias("n_tables"))
    )


def empty_tables(spark: SparkSession, root: str) -> DataFrame:
    """Table folders with no data file (an error row for that table only)."""
    return discover_tables(spark, root).filter(F.col("n_files") == 0).select(
        "schema_name", "table_name", "table_path"
    )
