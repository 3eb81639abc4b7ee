"""Projections: drop archive columns (O6), map types (O7), describe columns."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import conversion, declared_type, exposed_column, quote
from ..sources.scan import scan_table
from .report import error_text

# Fixed value: archive bookkeeping column removed from every table (exact, case-sensitive name).
ARCHIVE_COLUMNS: tuple[str, ...] = ("ArchiveCreationDate",)

DESCRIBE_SCHEMA = T.StructType(
    [
        T.StructField("schema_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), True),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("spark_type", T.StringType(), True),
        T.StructField("declared_type", T.StringType(), True),
        T.StructField("nullable", T.BooleanType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)


class NoColumnsLeftError(ValueError):
    """Every column of a table is an archive column."""


def kept_fields(schema: T.StructType, names: Iterable[str] = ARCHIVE_COLUMNS) -> list[T.StructField]:
    """Fields that survive O6; exact name comparison, unlike ``DataFrame.drop``."""
    excluded = set(names)
    kept = [f for f in schema.fields if f.name not in excluded]
    if not kept:
        raise NoColumnsLeftError("no columns left after removing archive columns")
    return kept


def drop_columns(df: DataFrame, names: Iterable[str] = ARCHIVE_COLUMNS) -> DataFrame:
    """Remove archive bookkeeping columns by exact name."""
    return df.select([F.col(quote(f.name)) for f in kept_fields(df.schema, names)])


def conform_types(df: DataFrame, policy: str = "mapped", mapping: dict[str, str] | None = None) -> DataFrame:
    """Expose each column per the type policy (unknown classes become text)."""
    return df.select([exposed_column(f.name, f.dataType, policy, mapping) for f in df.schema.fields])


def column_list(fields: Sequence[T.StructField], mapping: dict[str, str] | None = None) -> list[str]:
    """``name DECLARED`` entries of the report (the archive tool's column list)."""
    return [f"{f.name} {declared_type(f.dataType, mapping)}" for f in fields]


def exposed_list(fields: Sequence[T.StructField], policy: str, mapping: dict[str, str] | None = None) -> list[str]:
    """``name type`` entries of the report: the Spark type that the published view exposes."""
    return [f"{f.name} {conversion(f.dataType, policy, mapping)[1].simpleString()}" for f in fields]


def parallel_map(spark: SparkSession, fn: Callable, items: Sequence, max_workers: int = 8) -> list:
    """Run ``fn`` over ``items`` from a small driver thread pool.

    Each call submits its own Spark job (a footer read or a catalog call); the
    pool only overlaps their latencies. Pool threads inherit the caller's
    Spark local properties (job group, description, scheduler pool), so the
    jobs stay attributable and cancellable with the caller's group.
    Exceptions are returned, not raised.
    """

    def guarded(item):
        try:
            return fn(item)
        except Exception as exc:  # noqa: BLE001 - reported per table
            return exc

    if not items:
        return []
    target = inheritable_thread_target(spark)(guarded)
    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(items)))) as pool:
        return list(pool.map(target, items))


def read_schemas(
    spark: SparkSession, tables: Sequence[tuple[Hashable, str]], max_workers: int = 8
) -> dict[Hashable, T.StructType | Exception]:
    """Merged schema of each (key, table_path); a failure is returned per key."""
    results = parallel_map(spark, lambda kp: scan_table(spark, kp[1]).schema, list(tables), max_workers)
    return {key: res for (key, _), res in zip(tables, results)}


def describe_tables(
    spark: SparkSession,
    tables: DataFrame,
    *,
    drop: Iterable[str] = ARCHIVE_COLUMNS,
    mapping: dict[str, str] | None = None,
    max_workers: int = 8,
) -> DataFrame:
    """One row per column of every table (schema_name, table_name, table_path).

    Ordinals count from 1 after archive columns are removed. A table that cannot
    be read or has no column left is one row with just its name and the whole
    ``error_message``; tables that have no data file are left out.
    """
    if "n_files" in tables.columns:  # discovery output: empty folders have no schema to read
        tables = tables.filter(F.col("n_files") > 0)
    listing = [
        ((r.schema_name, r.table_name), r.table_path)
        for r in tables.select("schema_name", "table_name", "table_path").collect()
    ]
    schemas = read_schemas(spark, listing, max_workers)
    rows = []
    drop = tuple(drop)
    for (schema_name, table_name), _ in listing:
        schema = schemas[(schema_name, table_name)]
        try:
            if isinstance(schema, Exception):
                raise schema
            fields = kept_fields(schema, drop)
        except Exception as exc:  # noqa: BLE001 - reported per table
            rows.append((schema_name, table_name, None, None, None, None, None, error_text(exc)))
            continue
        for i, f in enumerate(fields, start=1):
            rows.append(
                (schema_name, table_name, i, f.name, f.dataType.simpleString(), declared_type(f.dataType, mapping), f.nullable, None)
            )
    return spark.createDataFrame(rows, DESCRIBE_SCHEMA)
