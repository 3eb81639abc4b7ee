"""Ownership registry of published tables: versions, bases and the journal of replaces.

Base tables live in a database of their own (``tablekeep_bases``, with the
session's prefix) under unique names, so no folder can be named like one. What
belongs to whom is on record only: the registry is a folder below that database
with one small JSON document for each event of a published table,

* ``begun``   before any base is made: version, base names, sources, who and when;
* ``served``  after the public view was swapped to the version;
* ``dropped`` after the version's bases were dropped (retired, overtaken or failed).

Claiming a version is a compare-and-set: the ``begun`` document of a version is
created only if there is none, and whoever comes second takes the next number.
Views are swapped under a lock for each published table, and a version is never
swapped in over a later one. So of any number of simultaneous replaces the
latest version ends up served, each writer drops its own bases only, and
retired bases are those that the journal names. A replaced version keeps its
bases for ``GRACE_SECONDS``, for readers that have just looked the view up; the
first swap after that, or ``recover``, drops them.

A writer that dies leaves a ``begun`` document without an end. ``recover`` (and
every later swap of the same table) drops the bases it names once it is older
than ``STALE_SECONDS``, never by a name pattern. A lock left by a dead writer is
broken after the same time.

Creating a document only if there is none is atomic on HDFS and the common object
stores. On a local file system it is atomic among the threads of one driver.
"""

from __future__ import annotations

import json
import logging
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import catalog_name
from ..functions.types import quote, sql_string
from ..operators.project import parallel_map
from ..sources import fs

log = logging.getLogger("tablekeep")

#: Database of the base tables (behind the session's prefix); no schema folder can be published as it.
BASES = "tablekeep_bases"
#: Age at which an unfinished replace, or a lock, counts as left behind.
STALE_SECONDS = 3600.0
#: How long a replaced version can still be read by those who looked the view up before.
GRACE_SECONDS = 60.0
#: Longest wait for another writer's swap of the same table.
LOCK_SECONDS = 600.0

EVENTS = ("begun", "served", "dropped")

REGISTRY_COLUMNS = (
    "catalog_database string, catalog_table string, version int, event string, at double, writer string, schema_name string, "
    "table_name string, policy string, merged boolean, sources array<string>, applications array<string>, bases array<string>"
)

_locks_guard = threading.Lock()
_locks: dict[tuple[str, str], threading.Lock] = {}


class ReservedNameError(ValueError):
    """A schema folder has the name of the registry's own database."""


@dataclass
class Claim:
    """A version taken by one writer, and the bases it may make and drop."""

    db: str
    table: str
    version: int
    writer: str
    bases: list[str]
    record: dict = field(repr=False, default_factory=dict)


class Registry:
    def __init__(self, spark: SparkSession, database_prefix: str = "", location: str | None = None):
        self.spark = spark
        self.database = (catalog_name(database_prefix) if database_prefix else "") + BASES
        if not spark.catalog.databaseExists(quote(self.database)):
            at = f" LOCATION {sql_string(location.rstrip('/') + '/' + self.database + '.db')}" if location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(self.database)}{at}")
        info = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE DATABASE {quote(self.database)}").collect()}
        self.root = info["Location"].rstrip("/") + "/registry"

    def check_name(self, db: str) -> None:
        if db == self.database:
            raise ReservedNameError(f"the database {db} is reserved for base tables; publish the folder under another prefix")

    # ------------------------------------------------------------ journal

    def _folder(self, db: str, table: str) -> str:
        return f"{self.root}/{db}/{table}"

    def _document(self, db: str, table: str, version: int, event: str) -> str:
        return f"{self._folder(db, table)}/{version:09d}.{event}.json"

    def events(self, db: str, table: str) -> dict[int, set[str]]:
        """Events on record of each version of a published table."""
        out: dict[int, set[str]] = {}
        for entry in fs.children(self.spark, self._folder(db, table)):
            parts = entry.name.split(".")
            if len(parts) == 3 and parts[0].isdigit() and parts[1] in EVENTS and parts[2] == "json":
                out.setdefault(int(parts[0]), set()).add(parts[1])
        return out

    def read(self, db: str, table: str, version: int, event: str = "begun") -> dict:
        return json.loads(fs.read_text(self.spark, self._document(db, table, version, event)))

    def claim(self, db: str, table: str, n_bases: int, above: int = 0, **record) -> Claim:
        """Take the next free version, above any on record and ``above``; its ``begun`` document names
        the bases before they are made."""
        self.check_name(db)
        writer = uuid.uuid4().hex
        bases = [f"b{writer}_{k}" for k in range(n_bases)]
        version = max([above, *self.events(db, table)]) + 1
        while True:
            full = dict(record, catalog_database=db, catalog_table=table, version=version, writer=writer, bases=bases)
            if self._write(full, "begun"):
                return Claim(db, table, version, writer, bases, full)
            version += 1

    def _write(self, record: dict, event: str) -> bool:
        path = self._document(record["catalog_database"], record["catalog_table"], record["version"], event)
        return fs.create_new(self.spark, path, json.dumps(record | {"event": event, "at": time.time()}))

    def close(self, record: dict, event: str) -> None:
        self._write(record, event)

    # ------------------------------------------------------------ bases

    def base_name(self, base: str) -> str:
        return f"{quote(self.database)}.{quote(base)}"

    def drop_version(self, record: dict) -> None:
        """Drop the bases that a record names (external: the files stay) and write that down."""
        results = parallel_map(self.spark, lambda b: self.spark.sql(f"DROP TABLE IF EXISTS {self.base_name(b)}"), record["bases"])
        failures = [r for r in results if isinstance(r, Exception)]
        if failures:  # stays on record as not dropped: the next swap or recovery tries again
            log.warning("%s.%s v%s: cannot drop a base table: %s", record["catalog_database"], record["catalog_table"], record["version"], failures[0])
            return
        self.close(record, "dropped")

    def retire(self, db: str, table: str, served: int, stale_seconds: float | None = None, grace_seconds: float | None = None) -> list[int]:
        """Drop the bases of versions that were replaced, and of replaces left unfinished, once they are
        old enough. ``served`` is the version that the view serves (0: none).

        The caller holds the table's lock. Returns the versions dropped.
        """
        stale = STALE_SECONDS if stale_seconds is None else stale_seconds
        grace = GRACE_SECONDS if grace_seconds is None else grace_seconds
        now, replaced_at, out = time.time(), None, []
        for version, events in sorted(self.events(db, table).items(), reverse=True):
            if version != served and "begun" in events and "dropped" not in events:
                record = self.read(db, table, version)
                if "served" in events:
                    old = not served or (replaced_at is not None and now - replaced_at >= grace)
                else:
                    old = now - record["at"] >= stale
                if old:
                    self.drop_version(record)
                    out.append(version)
            if "served" in events:  # replaced the version below it
                replaced_at = self.read(db, table, version, "served")["at"] if "dropped" not in events or replaced_at is None else replaced_at
        return out

    # ------------------------------------------------------------ lock

    @contextmanager
    def lock(self, db: str, table: str) -> Iterator[None]:
        """One writer at a time for a published table, in this driver and beyond it."""
        path = f"{self._folder(db, table)}/swap.lock"
        with _locks_guard:
            own = _locks.setdefault((self.root, f"{db}.{table}"), threading.Lock())
        with own:
            until = time.monotonic() + LOCK_SECONDS
            while not fs.create_new(self.spark, path, json.dumps({"at": time.time()})):
                age = fs.age_seconds(self.spark, path)
                if age is not None and age >= STALE_SECONDS:
                    log.warning("%s.%s: breaking a lock left behind %.0f seconds ago", db, table, age)
                    fs.delete_file(self.spark, path)
                elif time.monotonic() > until:
                    raise TimeoutError(f"{db}.{table} is being replaced by another writer")
                else:
                    time.sleep(0.2)
            try:
                yield
            finally:
                fs.delete_file(self.spark, path)


def registry_events(spark: SparkSession, database_prefix: str = "") -> DataFrame:
    """Every event on record, one row each, read by Spark; also a catalog table ``registry`` beside the bases."""
    registry = Registry(spark, database_prefix)
    fs.mkdirs(spark, registry.root)
    name = f"{quote(registry.database)}.registry"
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({REGISTRY_COLUMNS}) USING json "
            f"OPTIONS (recursiveFileLookup 'true', pathGlobFilter '*.json') LOCATION {sql_string(fs.glob_escape(registry.root))}"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name).filter(F.col("event").isNotNull())


def published_versions(spark: SparkSession, database_prefix: str = "") -> DataFrame:
    """Every version of every published table with its state: ``begun`` (unfinished), ``served`` (now or
    before, and its bases are still there), or ``dropped``."""
    events = registry_events(spark, database_prefix)
    state = F.max(F.when(F.col("event") == "dropped", 2).when(F.col("event") == "served", 1).otherwise(0))
    first = [F.min_by(c, "at").alias(c) for c in ("schema_name", "table_name", "policy", "merged", "sources", "bases")]
    versions = events.groupBy("catalog_database", "catalog_table", "version").agg(state.alias("s"), F.min("at").alias("begun_at"), *first)
    named = F.element_at(F.array(*[F.lit(e) for e in EVENTS]), F.col("s") + 1)
    return versions.withColumn("state", named).drop("s")


def recover(spark: SparkSession, database_prefix: str = "", stale_seconds: float | None = None, grace_seconds: float | None = None) -> DataFrame:
    """Drop what dead writers and past replaces left: (catalog_database, catalog_table, version) of every
    version dropped.

    The tables concerned are found in the journal, with one Spark job over all tables. The bases on
    record are dropped, if the public view does not serve them (a writer may have died between the
    swap and its record: then the record is completed).
    """
    from .registration import served_version

    store = Registry(spark, database_prefix)
    open_ = published_versions(spark, database_prefix).filter("state <> 'dropped'").groupBy("catalog_database", "catalog_table")
    tables = open_.agg(F.count_if(F.col("state") == "begun").alias("begun"), F.count_if(F.col("state") == "served").alias("served"))
    rows = []
    for r in tables.filter("begun > 0 OR served > 1").collect():  # one row a table with something left
        db, table = r.catalog_database, r.catalog_table
        with store.lock(db, table):
            served = served_version(spark, db, table)
            if served and "served" not in store.events(db, table).get(served, {"served"}):
                store.close(store.read(db, table, served), "served")
            rows += [(db, table, v) for v in store.retire(db, table, served, stale_seconds, grace_seconds)]
    return spark.createDataFrame(rows, "catalog_database string, catalog_table string, version int")
