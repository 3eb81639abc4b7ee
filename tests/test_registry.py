"""The ownership registry: simultaneous replaces, names like ours, and writers that die."""

from __future__ import annotations

import threading
import time

import pytest
from conftest import SF_SMALL, write_df
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from tablekeep import staging
from tablekeep.operators.project import parallel_map
from tablekeep.plans import registration
from tablekeep.plans.publish import publish_application
from tablekeep.plans.registration import register_merged, register_table, registered_tables, unregister
from tablekeep.plans.registry import Registry, ReservedNameError, published_versions, recover, registry_events
from tablekeep.sources import fs


def names_in(spark, db):
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()}


def test_simultaneous_replaces_leave_a_readable_view(spark, base, prefix):
    """4 threads, ten rounds; a reader looks the view up all the while."""
    paths = [write_df(spark, [(i,)] * (i + 1), "id int", f"{base}/v{i}/parquet/T.parquet") for i in range(4)]
    schema = spark.read.parquet(paths[0]).schema
    view = f"{prefix}s.t"
    register_table(spark, "s", "T", paths[0], schema, database_prefix=prefix, database_location=base)
    stop, failures, reads = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                rows = [r.id for r in spark.table(view).collect()]
                assert rows and len(rows) == rows[0] + 1
                reads.append(rows[0])
                time.sleep(0.05)
            except Exception as exc:  # noqa: BLE001 - shown below
                failures.append(exc)

    reader = threading.Thread(target=inheritable_thread_target(spark)(read))
    reader.start()
    versions = []
    try:
        for _ in range(10):
            done = parallel_map(spark, lambda p: register_table(spark, "s", "T", p, schema, database_prefix=prefix, database_location=base), paths, 4)
            assert not [r for r in done if isinstance(r, Exception)]
            assert len({r.version for r in done}) == 4
            versions += [r.version for r in done]
            last = max(done, key=lambda r: r.version)
            assert last.action == "replace"
            i = done.index(last)
            assert [r.id for r in spark.table(view).collect()] == [i] * (i + 1)
    finally:
        stop.set()
        reader.join()
    assert failures == [] and len(reads) > 5
    assert sorted(versions) == list(range(2, 42))
    (now,) = registered_tables(spark, [f"{prefix}s"]).collect()
    assert now.version == 41
    recover(spark, prefix, grace_seconds=0)
    states = {r.version: r.state for r in published_versions(spark, prefix).collect()}
    assert len(states) == 41 and {v: s for v, s in states.items() if s != "dropped"} == {41: "served"}
    assert len(names_in(spark, f"{prefix}tablekeep_bases") - {"registry"}) == 1 and spark.table(view).count() >= 1


def test_simultaneous_merges(spark, base, prefix):
    apps = list(staging.stage_applications(spark, SF_SMALL, base).values())
    for _ in range(3):
        done = parallel_map(spark, lambda _: register_merged(spark, "m", apps, database_prefix=prefix, database_location=base), range(3), 3)
        assert not [r for r in done if isinstance(r, Exception)]
        assert spark.table(f"{prefix}m.orders").count() == 1500


def test_folders_named_like_versions(spark, base, prefix):
    """ORDERS and ORDERS__V1 side by side, published three times."""
    for name, rows in (("ORDERS", 3), ("ORDERS__V1", 5), ("ORDERS__V2_S0", 1)):
        write_df(spark, [(i,) for i in range(rows)], "id int", f"{base}/shop/parquet/{name}.parquet")
    for run in (1, 2, 3):
        report = publish_application(spark, f"{base}/shop", replace_existing=True, verify_row_count=True, database_prefix=prefix, database_location=base)
        rows = {r.table_name: (r.status, r.version, r.row_count) for r in report.collect()}
        assert rows == {"ORDERS": ("success", run, 3), "ORDERS__V1": ("success", run, 5), "ORDERS__V2_S0": ("success", run, 1)}
        listed = registered_tables(spark, [f"{prefix}shop"]).collect()
        assert {(r.table_name, r.version) for r in listed} == {(n, run) for n in rows}


def test_a_writer_that_dies_is_cleaned_up_by_record(spark, base, prefix, monkeypatch):
    """Death between making the base and swapping the view: nothing is undone, then recovery finds the base."""
    path = write_df(spark, [(1,)], "id int", f"{base}/a/parquet/T.parquet")
    register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    served = names_in(spark, f"{prefix}tablekeep_bases")

    class Death(BaseException):
        pass

    def die(self, db, table):
        raise Death

    with monkeypatch.context() as patch:
        patch.setattr(Registry, "lock", die)
        with pytest.raises(Death):
            register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    left = names_in(spark, f"{prefix}tablekeep_bases") - served
    assert len(left) == 1 and spark.table(f"{prefix}s.t").count() == 1
    spark.catalog.createTable(f"{prefix}tablekeep_bases.b_of_someone", path=path, source="parquet")
    assert recover(spark, prefix).collect() == []  # it might still be at work
    assert left <= names_in(spark, f"{prefix}tablekeep_bases")
    assert [tuple(r) for r in recover(spark, prefix, stale_seconds=0).collect()] == [(f"{prefix}s", "t", 2)]
    assert names_in(spark, f"{prefix}tablekeep_bases") - {"registry"} == served | {"b_of_someone"}
    assert {r.version: r.state for r in published_versions(spark, prefix).collect()} == {1: "served", 2: "dropped"}
    again = register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    assert again.version == 3 and spark.table(f"{prefix}s.t").count() == 1


def test_a_swap_without_its_record_is_completed(spark, base, prefix, monkeypatch):
    """Death between the swap and its record: the served bases are never dropped."""
    path = write_df(spark, [(1,)], "id int", f"{base}/a/parquet/T.parquet")

    def lose(self, record, event):
        if event == "served":
            raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Registry, "close", lose)
        reg = register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    assert reg.version == 1 and spark.table(reg.catalog_table).count() == 1
    assert recover(spark, prefix, stale_seconds=0).collect() == []
    assert spark.table(reg.catalog_table).count() == 1
    assert [r.state for r in published_versions(spark, prefix).collect()] == ["served"]


def test_the_version_is_that_of_the_text(spark, base, prefix, monkeypatch):
    """Death between the view's text and its properties: the text counts."""
    path = write_df(spark, [(1,)], "id int", f"{base}/a/parquet/T.parquet")
    register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    sql = spark.sql

    def lose(text, *args, **kwargs):
        if "SET TBLPROPERTIES" in text:
            raise OSError("lost")
        return sql(text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", lose)
        reg = register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    assert reg.version == 2 and registration.served_version(spark, f"{prefix}s", "t") == 2
    assert recover(spark, prefix, stale_seconds=0, grace_seconds=0).count() == 1  # version 1
    assert spark.table(reg.catalog_table).count() == 1


def test_failures_drop_their_own_bases_only(spark, base, prefix, monkeypatch):
    path = write_df(spark, [(1,)], "id int", f"{base}/a/parquet/T.parquet")
    reg = register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)

    def fail(*args, **kwargs):
        raise OSError("catalog gone")

    with monkeypatch.context() as patch:
        patch.setattr(registration, "_create_base", fail)
        with pytest.raises(OSError, match="catalog gone"):
            register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    assert names_in(spark, f"{prefix}tablekeep_bases") == set(reg.base_tables)
    assert spark.table(reg.catalog_table).count() == 1
    assert sorted((r.version, r.event) for r in registry_events(spark, prefix).collect()) == [(1, "begun"), (1, "served"), (2, "begun"), (2, "dropped")]


def test_an_overtaken_version_is_not_swapped_in(spark, base, prefix, monkeypatch):
    old, new = (write_df(spark, [(i,)], "id int", f"{base}/v{i}/parquet/T.parquet") for i in (1, 2))
    make = registration._create_base

    def slow(spark, name, path, *rest):
        make(spark, name, path, *rest)
        if "/v1/" in path:  # while this base is made, another writer replaces the table
            register_table(spark, "s", "T", new, database_prefix=prefix, database_location=base)

    with monkeypatch.context() as patch:
        patch.setattr(registration, "_create_base", slow)
        reg = register_table(spark, "s", "T", old, database_prefix=prefix, database_location=base)
    assert reg.action == "overtaken" and reg.version == 1 and reg.base_tables == []
    assert [r.id for r in spark.table(f"{prefix}s.t").collect()] == [2]
    assert len(names_in(spark, f"{prefix}tablekeep_bases")) == 1


def test_reserved_database(spark, base, prefix):
    path = write_df(spark, [(1,)], "id int", f"{base}/tablekeep_bases/parquet/T.parquet")
    with pytest.raises(ReservedNameError):
        register_table(spark, "Tablekeep_Bases", "T", path, database_prefix=prefix, database_location=base)
    report = publish_application(spark, f"{base}/tablekeep_bases", database_prefix=prefix, database_location=base).collect()
    assert [r.status for r in report] == ["error"] and "reserved" in report[0].error_message


def test_create_new_and_locks(spark, base, prefix):
    made = parallel_map(spark, lambda i: fs.create_new(spark, f"{base}/x.json", str(i)), range(8), 8)
    assert made.count(True) == 1 and fs.read_text(spark, f"{base}/x.json") == str(made.index(True))
    store, inside, most = Registry(spark, prefix, base), [], []

    def hold(_):
        with store.lock("d", "t"):
            inside.append(1)
            most.append(len(inside))
            inside.pop()

    assert parallel_map(spark, hold, range(12), 6) == [None] * 12 and set(most) == {1}
    assert fs.age_seconds(spark, f"{store.root}/d/t/swap.lock") is None


def test_unregister_drops_what_is_on_record(spark, base, prefix):
    path = write_df(spark, [(1,)], "id int", f"{base}/a/parquet/T.parquet")
    for _ in range(2):
        register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    unregister(spark, "s", "T", database_prefix=prefix)
    assert names_in(spark, f"{prefix}s") == set() and names_in(spark, f"{prefix}tablekeep_bases") == set()
    assert spark.read.parquet(path).count() == 1
    assert {r.state for r in published_versions(spark, prefix).filter(F.col("table_name") == "T").collect()} == {"dropped"}
    reg = register_table(spark, "s", "T", path, database_prefix=prefix, database_location=base)
    assert (reg.version, reg.action) == (3, "create")
