"""File manifests (O2, O3) and the data-file predicate.

A manifest is a DataFrame with one row per data file. It comes from Spark's
``binaryFile`` source with the ``content`` column pruned away, so no file is
opened: Spark's file index lists the folders (in parallel on the executors once
a listing has more than ``spark.sql.sources.parallelPartitionDiscovery.threshold``
paths) and the scan only turns file statuses into rows. Spark still packs
files into tasks by byte size, so the actions this package runs on a manifest
use ``session.manifest_scan_conf`` (about one task per core); run your own
actions on a large manifest under it too.

Data-file predicate (O9): name matches ``*.parquet`` (case-sensitive glob on the
file name), regular file, and neither the file nor any folder below the listed
path starts with ``.`` or ``_`` (Spark's hidden-path rule). Schema inference,
row counts and registered tables all use this same file set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import manifest_scan_conf, scoped_conf
from . import fs

# Fixed value: data files are the "*.parquet" files (case-sensitive) below a table folder.
DATA_FILE_GLOB = "*.parquet"
LISTING_OPTIONS = {"recursiveFileLookup": "true", "pathGlobFilter": DATA_FILE_GLOB}

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("encoded_path", T.StringType(), False),
        T.StructField("n_bytes", T.LongType(), False),
        T.StructField("modified_at", T.TimestampType(), True),
    ]
)


class MissingDataFilesError(ValueError):
    """A requested table folder holds no data file."""


def file_manifest(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per data file below ``paths``: (file_path, encoded_path, n_bytes, modified_at).

    ``file_path`` is the qualified, decoded path (``file:/a b/x.parquet``);
    ``encoded_path`` is the same file as Spark's ``_metadata.file_path`` spells
    it (URL-encoded), the key that ties per-file scan results to the manifest.
    """
    paths = [fs.qualify(spark, p) for p in paths]
    if not paths:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return (
        spark.read.format("binaryFile")
        .options(**LISTING_OPTIONS)
        .load([fs.glob_escape(p) for p in paths])
        .select(
            F.col("path").alias("file_path"),
            F.col("_metadata.file_path").alias("encoded_path"),
            F.col("length").alias("n_bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def source_depths(sources: Sequence[str]) -> set[int]:
    """The numbers of path parts that the sources have."""
    return {s.count("/") + 1 for s in sources}


def assign_sources(files: DataFrame, sources: Sequence[str], path_col: str = "file_path") -> DataFrame:
    """Tag each file with the requested folder it lies under (``source_path``).

    A file's path is cut at the depth of the sources and equi-joined to the
    source list: one row a file goes into the join, or one for each distinct
    depth where the sources lie at several. Sources must not overlap (see
    ``merge_group``).
    """
    spark = files.sparkSession
    src = spark.createDataFrame([(s,) for s in sources], "source_path string")
    cuts = [F.substring_index(F.col(path_col), "/", depth) for depth in sorted(source_depths(sources))]
    cut = cuts[0] if len(cuts) == 1 else F.explode(F.array_distinct(F.array(*cuts)))
    return files.withColumn("source_path", cut).join(src, "source_path", "inner")


def manifest_by_source(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Manifest of several table folders with the folder each file came from (O3)."""
    qualified = [fs.qualify(spark, p) for p in paths]
    return assign_sources(file_manifest(spark, qualified), qualified)


def check_not_empty(spark: SparkSession, paths: Sequence[str]) -> None:
    """O3 without counting: raise unless every folder holds a data file.

    Stops at the first data file of each folder (driver metadata calls), so a
    pre-check never lists a whole archive; use :func:`require_files` when the
    per-folder file counts are needed too.
    """
    qualified = [fs.qualify(spark, p) for p in paths]
    missing = [p for p in qualified if not fs.is_dir(spark, p)]
    if missing:
        raise MissingDataFilesError(f"not a directory: {', '.join(missing)}")
    empty = sorted(p for p in qualified if fs.first_data_file(spark, p) is None)
    if empty:
        raise MissingDataFilesError(f"no Parquet files found in: {', '.join(empty)}")


def require_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """O3 contract: every requested folder must hold at least one data file.

    Returns the per-source (source_path, n_files, n_bytes) from one listing job
    as a small local DataFrame; raises naming every empty or missing folder
    (the whole group fails, as the archive tool does).
    """
    qualified = [fs.qualify(spark, p) for p in paths]
    missing = [p for p in qualified if not fs.is_dir(spark, p)]
    if missing:
        raise MissingDataFilesError(f"not a directory: {', '.join(missing)}")
    per_source = manifest_by_source(spark, qualified).groupBy("source_path").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("n_bytes").alias("n_bytes")
    )
    requested = spark.createDataFrame([(p,) for p in qualified], "source_path string")
    joined = requested.join(per_source, "source_path", "left").select(
        "source_path",
        F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
        F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"),
    )
    with scoped_conf(spark, manifest_scan_conf(spark)):
        rows = joined.collect()
    empty = sorted(r.source_path for r in rows if r.n_files == 0)
    if empty:
        raise MissingDataFilesError(f"no Parquet files found in: {', '.join(empty)}")
    return spark.createDataFrame(rows, "source_path string, n_files long, n_bytes long")
