"""Catalog registration.

Every published table is two catalog objects:

* a **base table** under a unique name in the registry's own database
  (``tablekeep_bases``) — an external Parquet table over the table folder,
  declared with the inferred columns and the same read options the scan uses (so
  it reads exactly the manifest's files; ``key=value`` folders become partition
  columns that prune). Dropping it keeps the files.
* the **public view** ``<db>.<table>`` — drops archive columns and applies the
  type policy. Its properties record the original names, the version and the
  source folders; they mark the object as ours.

Replacing (O18) claims the next version in the registry (``registry.py``), makes
that version's bases, and swaps the view with one ``ALTER VIEW`` under the
table's lock: if anything fails before the swap, the old view keeps serving
the old base, and the failed version's own bases are dropped. A version that was
overtaken by a later one while it was made is not swapped in. Bases of earlier
versions are dropped by record at a later swap, when no reader can be left that
looked the view up before.

A merged table (O19) has one base table per source and the view is their UNION
ALL BY NAME with a literal ``source_application`` column, so a filter on the
application removes the other branches at planning time.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import catalog_name, catalog_name_col, database_name
from ..functions.types import check_policy, conversion, exposed_sql, quote, reshape_sql, same_type, sql_string, sql_type
from ..operators.merge import (
    PROVENANCE_COLUMN,
    AlignedColumn,
    align_schemas,
    merge_sources,
    source_name,
)
from ..operators.project import ARCHIVE_COLUMNS, kept_fields, parallel_map
from ..sources import fs
from ..sources.manifest import check_not_empty
from ..sources.scan import Layout, reader_options, scan_files, scan_table, table_layout
from .registry import Claim, Registry

log = logging.getLogger("tablekeep")

KEY = "tablekeep."
VERSION_KEY = KEY + "version"

EXISTING_SCHEMA = T.StructType(
    [
        T.StructField("catalog_database", T.StringType(), False),
        T.StructField("catalog_table", T.StringType(), False),
    ]
)


class NotManagedError(RuntimeError):
    """A catalog object with the target name exists and was not made here."""


class NameCollisionError(ValueError):
    """Different folder names normalise to the same catalog name."""


@dataclass
class Registration:
    catalog_table: str  # db.table as written in the catalog
    version: int
    action: str  # "create" | "replace"; "overtaken" where a later version was swapped in meanwhile
    columns: list[T.StructField] = field(default_factory=list)
    base_tables: list[str] = field(default_factory=list)

    @property
    def quoted(self) -> str:
        """The public name quoted for SQL and ``spark.table`` (names may look like numbers)."""
        db, table = self.catalog_table.split(".", 1)
        return f"{quote(db)}.{quote(table)}"


# ---------------------------------------------------------------- catalog state


def _db_exists(spark: SparkSession, db: str) -> bool:
    """``databaseExists`` parses its argument: quote, so names like ``2024`` work."""
    return bool(spark.catalog.databaseExists(quote(db)))


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """Create the database if absent; ``location`` is a parent folder for it."""
    if _db_exists(spark, db):
        return
    loc = f" LOCATION {sql_string(location.rstrip('/') + '/' + db + '.db')}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(db)}{loc}")


def table_properties(spark: SparkSession, db: str, table: str) -> dict[str, str] | None:
    """Properties of ``db.table``, or None when no such table or view exists."""
    if not _db_exists(spark, db) or not spark.catalog.tableExists(f"{quote(db)}.{quote(table)}"):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quote(db)}.{quote(table)}").collect()
    return {r.key: r.value for r in rows}


def schema_exists(spark: SparkSession, schema_name: str, database_prefix: str = "") -> bool:
    """Does the catalog database of a schema folder exist?"""
    return _db_exists(spark, database_name(schema_name, database_prefix))


def table_exists(spark: SparkSession, schema_name: str, table_name: str, database_prefix: str = "") -> bool:
    """Is there any table or view under the catalog name of (schema, table)?"""
    return table_properties(spark, database_name(schema_name, database_prefix), catalog_name(table_name)) is not None


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("catalog_database", T.StringType(), False),
        T.StructField("catalog_table", T.StringType(), False),
        T.StructField("schema_name", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("version", T.IntegerType(), True),
        T.StructField("policy", T.StringType(), True),
        T.StructField("merged", T.BooleanType(), True),
        T.StructField("sources", T.ArrayType(T.StringType()), True),
    ]
)


def registered_tables(spark: SparkSession, databases: Iterable[str]) -> DataFrame:
    """Tables published by tablekeep in ``databases``, with their original names.

    Read from the public views' properties (catalog metadata, one call per view).
    """
    rows = []
    for db in sorted(set(databases)):
        if not _db_exists(spark, db):
            continue
        for t in spark.sql(f"SHOW TABLES IN {quote(db)}").filter(~F.col("isTemporary")).collect():
            props = table_properties(spark, db, t.tableName) or {}
            if VERSION_KEY not in props:
                continue
            rows.append(
                (
                    db,
                    t.tableName,
                    props.get(KEY + "schema_name"),
                    props.get(KEY + "table_name"),
                    int(props[VERSION_KEY]),
                    props.get(KEY + "policy"),
                    props.get(KEY + "merged") == "true",
                    json.loads(props.get(KEY + "sources", "[]")),
                )
            )
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def existing_tables(spark: SparkSession, databases: Iterable[str]) -> DataFrame:
    """O12 as a DataFrame: (catalog_database, catalog_table) of every table/view."""
    frames = [
        spark.sql(f"SHOW TABLES IN {quote(db)}")
        .filter(~F.col("isTemporary"))
        .select(F.col("namespace").alias("catalog_database"), F.col("tableName").alias("catalog_table"))
        for db in sorted(set(databases))
        if _db_exists(spark, db)
    ]
    if not frames:
        return spark.createDataFrame([], EXISTING_SCHEMA)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def plan_registration(
    spark: SparkSession,
    tables: DataFrame,
    *,
    replace_existing: bool = False,
    target_schema: str | None = None,
    database_prefix: str = "",
    on_collision: str = "raise",
) -> DataFrame:
    """Add catalog names, ``exists`` and ``action`` (create/replace/skip).

    ``tables`` needs ``schema_name`` and ``table_name``. When two originals
    normalise to one catalog name, ``on_collision="raise"`` raises and
    ``"mark"`` gives those rows ``action = 'collision'`` and a ``clash`` text.
    """
    if on_collision not in ("raise", "mark"):
        raise ValueError("on_collision must be 'raise' or 'mark'")
    schema_col = F.lit(target_schema) if target_schema is not None else F.col("schema_name")
    prefix = catalog_name(database_prefix) if database_prefix else ""
    named = tables.withColumn(
        "catalog_database", F.concat(F.lit(prefix), catalog_name_col(schema_col))
    ).withColumn(
        "catalog_table", catalog_name_col(F.col("table_name"))
    )
    # One small job answers both questions: which names collide, which databases to look in.
    groups = (
        named.groupBy("catalog_database", "catalog_table")
        .agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.concat_ws(".", schema_col, "table_name")).alias("names"))
        .collect()
    )
    clashes = {
        (r.catalog_database, r.catalog_table): f"{', '.join(sorted(r.names))} -> {r.catalog_database}.{r.catalog_table}"
        for r in groups
        if r.n > 1
    }
    if clashes and on_collision == "raise":
        raise NameCollisionError("; ".join(clashes.values()))
    dbs = sorted({r.catalog_database for r in groups})
    existing = existing_tables(spark, dbs).withColumn("exists", F.lit(True))
    planned = named.join(existing, ["catalog_database", "catalog_table"], "left").withColumn(
        "exists", F.coalesce("exists", F.lit(False))
    )
    action = F.when(~F.col("exists"), F.lit("create")).otherwise(
        F.lit("replace") if replace_existing else F.lit("skip")
    )
    planned = planned.withColumn("action", action)
    if on_collision == "mark":
        clash_rows = spark.createDataFrame(
            [(d, t, text) for (d, t), text in clashes.items()],
            "catalog_database string, catalog_table string, clash string",
        )
        planned = planned.join(clash_rows, ["catalog_database", "catalog_table"], "left").withColumn(
            "action", F.when(F.col("clash").isNotNull(), F.lit("collision")).otherwise(F.col("action"))
        )
    return planned


_SERVED = re.compile(r"/\* tablekeep v(\d+) \*/")


def served_version(spark: SparkSession, db: str, table: str) -> int:
    """Version the public view serves (0 when absent); refuses objects not made here.

    The view's own text says it, so it is never out of step with what the view reads.
    """
    props = table_properties(spark, db, table)
    if props is None:
        return 0
    if VERSION_KEY not in props:
        raise NotManagedError(f"{db}.{table} exists and was not registered by tablekeep; not replacing it")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote(db)}.{quote(table)}").filter("col_name = 'View Text'").first()
    found = _SERVED.search(described.data_type) if described else None
    return int(found[1] if found else props[VERSION_KEY])


def _swap_view(spark: SparkSession, db: str, table: str, version: int, exists: bool, body: str, props: dict[str, str]) -> None:
    """Point the public view to ``body`` (a SELECT). ``CREATE OR REPLACE VIEW`` drops the view before it
    makes the new one, so a reader in between finds none; ``ALTER VIEW`` changes it in one step."""
    view, text = f"{quote(db)}.{quote(table)}", body.replace("SELECT ", f"SELECT /* tablekeep v{version} */ ", 1)
    properties = _properties_sql(props | {VERSION_KEY: str(version)})
    if exists:
        spark.sql(f"ALTER VIEW {view} AS {text}")
        spark.sql(f"ALTER VIEW {view} SET TBLPROPERTIES ({properties})")
    else:
        spark.sql(f"CREATE VIEW {view} TBLPROPERTIES ({properties}) AS {text}")


def _properties_sql(props: dict[str, str]) -> str:
    return ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items())


def _publish_version(
    spark: SparkSession,
    registry: Registry,
    claim: Claim,
    make_bases: Callable[[], None],
    body: str,
    props: dict[str, str],
) -> bool:
    """Make the claimed version's bases and swap the public view to them.

    Returns whether the version is served now; False when a later version was swapped in
    meanwhile. Whatever happens, only bases on the claim's own record are dropped here, and
    only while the view does not read them.
    """
    db, table = claim.db, claim.table
    swapped = False
    try:
        make_bases()
        with registry.lock(db, table):
            before = served_version(spark, db, table)
            if "dropped" in registry.events(db, table).get(claim.version, ()):
                raise TimeoutError(f"{db}.{table} v{claim.version} took so long that its bases were dropped as left behind")
            if before > claim.version:
                log.info("%s.%s v%s: overtaken by v%s", db, table, claim.version, before)
            else:
                try:
                    _swap_view(spark, db, table, claim.version, before > 0, body, props)
                except Exception:
                    # the view may read the new bases already: its properties come second
                    swapped = served_version(spark, db, table) == claim.version
                    if not swapped:
                        raise
                swapped = True
                registry.close(claim.record, "served")
                registry.retire(db, table, claim.version)
    except Exception:
        if not swapped:
            registry.drop_version(claim.record)
            raise
        log.warning("%s.%s v%s is served, but older versions were not retired", db, table, claim.version, exc_info=True)
    if not swapped:
        registry.drop_version(claim.record)
    return swapped


def _create_base(spark: SparkSession, name: str, path: str, schema: T.StructType, layout: Layout) -> None:
    spark.catalog.createTable(
        name,
        path=fs.glob_escape(path),  # the location is globbed when resolved: keep it literal
        source="parquet",
        schema=schema,
        **reader_options(spark, path, merge_schema=False, layout=layout),
    )


def _relation_sql(name: str, files: T.StructType, layout: Layout) -> str:
    """What a view reads: the base table, with the keys of a mixed layout taken from the file paths."""
    if not layout.mixed:
        return name
    columns = ", ".join(e if e == quote(n) else f"{e} AS {quote(n)}" for n, e in layout.columns_sql(files))
    return f"(SELECT {columns} FROM {name})"


# ---------------------------------------------------------------- one table


def register_table(
    spark: SparkSession,
    schema_name: str,
    table_name: str,
    table_path: str,
    schema: T.StructType | None = None,
    *,
    policy: str = "native",
    mapping: dict[str, str] | None = None,
    drop: Iterable[str] = ARCHIVE_COLUMNS,
    database_location: str | None = None,
    database_prefix: str = "",
    layout: Layout | None = None,
) -> Registration:
    """O17 (and O18 when the table exists): publish one table folder.

    ``schema`` is the folder's merged schema when already known (saves a footer
    job), ``layout`` the folder's (saves its listing). Either way the folder must hold data files: a catalog table over a
    missing or empty location would silently read zero rows (trap T4).
    """
    check_policy(policy, mapping)
    path = fs.qualify(spark, table_path)
    if layout is None:
        layout = table_layout(spark, path) if fs.is_dir(spark, path) else Layout()
    if schema is None or layout.mixed:
        files = scan_files(spark, path, layout).schema  # fails on a missing or file-less folder
        schema = scan_table(spark, path, layout).schema if layout.mixed else files
    else:
        check_not_empty(spark, [path])
        files = schema
    fields = kept_fields(schema, drop)
    db, table = database_name(schema_name, database_prefix), catalog_name(table_name)
    registry = Registry(spark, database_prefix, database_location)
    registry.check_name(db)
    ensure_database(spark, db, database_location)
    previous = served_version(spark, db, table)
    record = {"schema_name": schema_name, "table_name": table_name, "policy": policy, "merged": False, "sources": [path]}
    claim = registry.claim(db, table, 1, above=previous, **record)
    base = registry.base_name(claim.bases[0])
    select = ", ".join(exposed_sql(f.name, f.dataType, policy, mapping) for f in fields)
    served = _publish_version(
        spark,
        registry,
        claim,
        lambda: _create_base(spark, base, path, files, layout),
        f"SELECT {select} FROM {_relation_sql(base, files, layout)}",
        _view_properties(record),
    )
    return _registration(claim, served, previous, fields)


def _view_properties(record: dict) -> dict[str, str]:
    """Properties of a public view from its version's record; lists and flags as JSON."""
    return {KEY + k: v if isinstance(v, str) else json.dumps(v) for k, v in record.items()}


def _registration(claim: Claim, served: bool, previous: int, fields: list[T.StructField]) -> Registration:
    action = "overtaken" if not served else "replace" if previous else "create"
    return Registration(f"{claim.db}.{claim.table}", claim.version, action, fields, claim.bases if served else [])


def replace_table(spark: SparkSession, schema_name: str, table_name: str, table_path: str, **kwargs) -> Registration:
    """Atomically point an existing published table at a (new) folder."""
    db, table = database_name(schema_name, kwargs.get("database_prefix", "")), catalog_name(table_name)
    if table_properties(spark, db, table) is None:
        raise LookupError(f"{db}.{table} does not exist")
    return register_table(spark, schema_name, table_name, table_path, **kwargs)


# ---------------------------------------------------------------- merged table


def _branch_sql(
    relation: str,
    k: int,
    schema: T.StructType,
    columns: Sequence[AlignedColumn],
    app: str,
    provenance_col: str | None,
) -> str:
    """SELECT of source ``k`` in merged column order (names as the source spells them)."""
    parts = []
    for c in columns:
        src = c.per_source[k]
        if src is None:
            parts.append(f"CAST(NULL AS {sql_type(c.dtype)}) AS {quote(c.name)}")
            continue
        own, name = quote(source_name(schema, c.name)), quote(c.name)
        if c.as_text:
            kind, _ = conversion(src, "mapped", {})
            parts.append(f"to_json({own}) AS {name}" if kind == "json" else f"CAST({own} AS STRING) AS {name}")
        elif not same_type(src, c.dtype):
            parts.append(f"{reshape_sql(own, src, c.dtype)} AS {name}")
        else:
            parts.append(own if own == name else f"{own} AS {name}")
    if provenance_col:
        parts.append(f"{sql_string(app)} AS {quote(provenance_col)}")
    return f"SELECT {', '.join(parts)} FROM {relation}"


def register_merged(
    spark: SparkSession,
    target_schema: str,
    paths: Sequence[str],
    *,
    policy: str = "native",
    mapping: dict[str, str] | None = None,
    on_conflict: str = "error",
    provenance_col: str | None = PROVENANCE_COLUMN,
    drop: Iterable[str] = ARCHIVE_COLUMNS,
    database_location: str | None = None,
    database_prefix: str = "",
    max_workers: int = 8,
    check_files: bool = True,
) -> Registration:
    """Publish one logical table merged from several applications.

    ``check_files=False`` skips the O3 listing when the caller already did it.
    """
    check_policy(policy, mapping)
    sources = merge_sources(spark, paths)
    if check_files:
        check_not_empty(spark, [s.path for s in sources])

    def read(source):
        layout = table_layout(spark, source.path)
        files = scan_files(spark, source.path, layout).schema
        return layout, files, scan_table(spark, source.path, layout).schema if layout.mixed else files

    found = parallel_map(spark, read, sources, max_workers)
    for one in found:
        if isinstance(one, Exception):
            raise one
    layouts, files, schemas = ([one[i] for one in found] for i in range(3))
    labels = [f"{s.application} ({s.path})" for s in sources]
    columns = align_schemas(schemas, labels, on_conflict=on_conflict, drop=drop)
    if provenance_col and any(c.name.lower() == provenance_col.lower() for c in columns):
        raise ValueError(f"a source already has a column named {provenance_col!r}; choose another provenance_col")
    table_name = sources[0].table_name
    db, table = database_name(target_schema, database_prefix), catalog_name(table_name)
    registry = Registry(spark, database_prefix, database_location)
    registry.check_name(db)
    ensure_database(spark, db, database_location)
    previous = served_version(spark, db, table)
    record = {
        "schema_name": target_schema,
        "table_name": table_name,
        "policy": policy,
        "merged": True,
        "sources": [s.path for s in sources],
        "applications": [s.application for s in sources],
    }
    claim = registry.claim(db, table, len(sources), above=previous, **record)
    bases = [registry.base_name(b) for b in claim.bases]

    def make_bases() -> None:
        results = parallel_map(
            spark, lambda k: _create_base(spark, bases[k], sources[k].path, files[k], layouts[k]), range(len(sources)), max_workers
        )
        failures = [r for r in results if isinstance(r, Exception)]
        if failures:
            raise failures[0]

    union = " UNION ALL ".join(
        _branch_sql(_relation_sql(base, files[k], layouts[k]), k, schemas[k], columns, s.application, provenance_col)
        for k, (s, base) in enumerate(zip(sources, bases))
    )
    outer = [exposed_sql(c.name, c.dtype, policy, mapping) for c in columns]
    if provenance_col:
        outer.append(quote(provenance_col))
    body = f"SELECT {', '.join(outer)} FROM ({union}) AS merged"
    served = _publish_version(spark, registry, claim, make_bases, body, _view_properties(record))
    return _registration(claim, served, previous, [T.StructField(c.name, c.dtype, True) for c in columns])


def unregister(spark: SparkSession, schema_name: str, table_name: str, database_prefix: str = "") -> None:
    """Drop a published table: the view and the bases on its record (files stay).

    A replace that is under way in another writer is left to it.
    """
    db, table = database_name(schema_name, database_prefix), catalog_name(table_name)
    if not _db_exists(spark, db):
        return
    registry = Registry(spark, database_prefix)
    with registry.lock(db, table):
        served_version(spark, db, table)  # refuses objects that are not ours
        spark.sql(f"DROP VIEW IF EXISTS {quote(db)}.{quote(table)}")
        registry.retire(db, table, 0)
