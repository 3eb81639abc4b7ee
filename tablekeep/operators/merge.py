"""Merging one logical table from several applications.

A merge group is a list of table folders ``<app>/parquet/<T>.parquet`` that
share one table name. The merged table is UNION ALL BY NAME over all their data
files: every column of any source, NULL where a source lacks it, no row
de-duplication, and a literal ``source_application`` per source. Each source is
its own scan branch, so a filter on the application prunes whole branches and
each source keeps its own file types (a branch casts only when it must).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths as P
from ..functions.types import conversion, quote, reshape_sql, same_type
from ..sources import fs
from ..sources.manifest import check_not_empty
from ..sources.scan import scan_table
from .project import ARCHIVE_COLUMNS, NoColumnsLeftError, parallel_map

PROVENANCE_COLUMN = "source_application"
CONFLICT_POLICIES = ("error", "text")

MERGE_GROUP_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("source_application", T.StringType(), False),
        T.StructField("source_path", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
    ]
)


class MergeGroupError(ValueError):
    """The paths do not form a valid merge group."""


class MergeConflictError(ValueError):
    """Sources disagree on a column's type and ``on_conflict='error'``."""


@dataclass(frozen=True)
class Source:
    ordinal: int
    application: str
    path: str  # qualified
    table_name: str


def merge_sources(spark: SparkSession, paths: Sequence[str]) -> list[Source]:
    """Validate a merge group and name each source's application.

    Rules: at least one path; each an existing directory named ``*.parquet``;
    no path given twice and none inside another (their files would be read
    twice); exactly one table name across all paths. The application is the
    folder two levels above the table folder (see :func:`application_names`).
    """
    if not paths:
        raise MergeGroupError("a merge needs one table folder at least")
    qualified = []
    for raw in paths:
        q = fs.qualify(spark, raw)
        if not fs.is_dir(spark, q):
            raise MergeGroupError(f"no folder at {raw}")
        if not q.rsplit("/", 1)[-1].endswith(P.SUFFIX):
            raise MergeGroupError(f"not a table folder (<table>{P.SUFFIX}): {raw}")
        qualified.append(q)
    check_disjoint(qualified)
    names = {q.rsplit("/", 1)[-1][: -len(P.SUFFIX)] for q in qualified}
    if len(names) != 1:
        raise MergeGroupError(f"a merge is of one table, these are {len(names)}: {', '.join(sorted(names))}")
    table = names.pop()
    return [Source(i, app, q, table) for i, (app, q) in enumerate(zip(application_names(qualified), qualified))]


def check_disjoint(paths: Sequence[str]) -> None:
    """Raise if a folder is given twice or lies inside another.

    Sorted with a closing slash, whatever lies inside a folder comes right after it, so neighbours tell.
    """
    ordered = sorted(p + "/" for p in paths)
    for a, b in zip(ordered, ordered[1:]):
        if a == b:
            raise MergeGroupError(f"path given twice: {a[:-1]}")
        if b.startswith(a):
            raise MergeGroupError(f"overlapping paths: {b[:-1]} lies inside {a[:-1]}")


def application_names(paths: Sequence[str]) -> list[str]:
    """One name per table folder: the folder two levels above, with as many of its
    parents as tell every two sources apart (``x/app`` and ``y/app``)."""
    above = [p.split("/")[:-2] for p in paths]
    depth = 1
    while True:
        names = ["/".join(parts[-depth:]) for parts in above]
        if len(set(names)) == len(set(map(tuple, above))) or depth >= max(map(len, above)):
            return names
        depth += 1


def merge_group(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """O13 as a DataFrame: (ordinal, source_application, source_path, table_name)."""
    return spark.createDataFrame(
        [(s.ordinal, s.application, s.path, s.table_name) for s in merge_sources(spark, paths)],
        MERGE_GROUP_SCHEMA,
    )


@dataclass(frozen=True)
class AlignedColumn:
    name: str
    dtype: T.DataType  # type in the merged table
    per_source: tuple  # source type or None when the source lacks the column
    as_text: bool  # conflicting types rendered as text in every source


def _widen(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """Type both merge to without loss, as Parquet schema merging allows.

    Structs merge field by field by name (case-insensitively, first-seen order),
    also inside arrays and map values; map keys must agree.
    """
    if same_type(a, b):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        other = {f.name.lower(): f for f in b.fields}
        if len(other) < len(b.fields) or len({f.name.lower() for f in a.fields}) < len(a.fields):
            return None  # names that differ only by case cannot be matched
        fields = []
        for f in a.fields:
            mate = other.pop(f.name.lower(), None)
            dtype = f.dataType if mate is None else _widen(f.dataType, mate.dataType)
            if dtype is None:
                return None
            fields.append(T.StructField(f.name, dtype, True))
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name.lower() in other])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = _widen(a.elementType, b.elementType)
        return element and T.ArrayType(element, True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and same_type(a.keyType, b.keyType):
        value = _widen(a.valueType, b.valueType)
        return value and T.MapType(a.keyType, value, True)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and a.scale == b.scale:
        return T.DecimalType(max(a.precision, b.precision), a.scale)
    return None


def align_schemas(
    schemas: Sequence[T.StructType],
    labels: Sequence[str],
    *,
    on_conflict: str = "error",
    drop: Iterable[str] = ARCHIVE_COLUMNS,
) -> list[AlignedColumn]:
    """Merged column list: first-seen order, widened types, conflicts resolved or raised."""
    if on_conflict not in CONFLICT_POLICIES:
        raise ValueError(f"on_conflict must be one of {CONFLICT_POLICIES}")
    drop = tuple(drop)
    order: list[str] = []
    spelled: dict[str, str] = {}
    types: dict[str, list] = {}
    for k, schema in enumerate(schemas):
        for f in schema.fields:
            if f.name in drop:
                continue
            key = f.name.lower()
            if key not in types:
                order.append(key)
                spelled[key] = f.name
                types[key] = [None] * len(schemas)
            elif types[key][k] is not None:
                raise MergeConflictError(f"{labels[k]} has columns whose names differ only by case: {f.name!r}")
            types[key][k] = f.dataType
    if not order:
        raise NoColumnsLeftError("no columns left after removing archive columns")
    out = []
    for key in order:
        seen = [(k, t) for k, t in enumerate(types[key]) if t is not None]
        merged = seen[0][1]
        conflict = None
        for k, t in seen[1:]:
            widened = _widen(merged, t)
            if widened is None:
                conflict = (seen[0][0], k, t)
                break
            merged = widened
        if conflict is not None:
            if on_conflict == "error":
                first, k, t = conflict
                raise MergeConflictError(
                    f"column {spelled[key]!r} has incompatible types: "
                    f"{seen[0][1].simpleString()} in {labels[first]} and {t.simpleString()} in {labels[k]}"
                )
            out.append(AlignedColumn(spelled[key], T.StringType(), tuple(types[key]), True))
        else:
            out.append(AlignedColumn(spelled[key], merged, tuple(types[key]), False))
    return out


def source_name(schema: T.StructType, name: str) -> str:
    """The spelling a source uses for a (case-insensitively matched) merged column."""
    for f in schema.fields:
        if f.name.lower() == name.lower():
            return f.name
    return name


def aligned_branch(df: DataFrame, k: int, columns: Sequence[AlignedColumn]) -> list:
    """Column expressions of source ``k`` in merged order (DataFrame form)."""
    exprs = []
    for c in columns:
        src_type = c.per_source[k]
        if src_type is None:
            exprs.append(F.lit(None).cast(c.dtype).alias(c.name))
            continue
        col = F.col(quote(source_name(df.schema, c.name)))
        if c.as_text:
            kind, _ = conversion(src_type, "mapped", {})
            col = F.to_json(col) if kind == "json" else col.cast(T.StringType())
        elif not same_type(src_type, c.dtype):
            col = F.expr(reshape_sql(quote(source_name(df.schema, c.name)), src_type, c.dtype))
        exprs.append(col.alias(c.name))
    return exprs


def merge_tables(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    provenance_col: str | None = PROVENANCE_COLUMN,
    on_conflict: str = "error",
    drop: Iterable[str] = ARCHIVE_COLUMNS,
    max_workers: int = 8,
    check_files: bool = True,
) -> DataFrame:
    """O14 + O15: UNION ALL BY NAME of the sources, with a provenance column.

    Sources are few (one per application), so each is a separate scan branch
    under one Union: no shuffle, and ``source_application = 'x'`` leaves one scan.
    A source without data files fails the whole group (O3), naming the folder.
    """
    sources = merge_sources(spark, paths)
    if check_files:
        check_not_empty(spark, [s.path for s in sources])
    frames = parallel_map(spark, lambda s: scan_table(spark, s.path), sources, max_workers)
    for s, df in zip(sources, frames):
        if isinstance(df, Exception):
            raise df
    labels = [f"{s.application} ({s.path})" for s in sources]
    columns = align_schemas([df.schema for df in frames], labels, on_conflict=on_conflict, drop=drop)
    if provenance_col and any(c.name.lower() == provenance_col.lower() for c in columns):
        raise ValueError(f"a source already has a column named {provenance_col!r}; choose another provenance_col")
    branches = []
    for k, (s, df) in enumerate(zip(sources, frames)):
        exprs = aligned_branch(df, k, columns)
        if provenance_col:
            exprs.append(F.lit(s.application).alias(provenance_col))
        branches.append(df.select(exprs))
    return reduce(DataFrame.union, branches)
