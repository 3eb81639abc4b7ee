"""Job entry points and the run report."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import SF_SMALL, write_df
from pyspark.sql import functions as F

from tablekeep import staging
from tablekeep.operators.merge import MergeGroupError
from tablekeep.operators.report import error_text, read_report, report_name, report_totals, write_report
import tablekeep.plans.publish as publish_mod
from tablekeep.plans.publish import publish_application, publish_merge
from tablekeep.sources import fs


def _by_table(report):
    return {(r.schema_name, r.table_name): r for r in report.collect()}


def test_publish_application_report(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    # a table whose only column is the archive column
    spark.sql("SELECT DATE'2024-01-01' AS ArchiveCreationDate").write.parquet(f"{root}/parquet/ONLYDATE.parquet")
    report = publish_application(spark, root, verify_row_count=True, database_prefix=prefix, database_location=base)
    rows = _by_table(report)
    assert len(rows) == 9
    orders = rows[("archive_SALES", "ORDERS")]
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    n_f = src.filter(F.col("o_orderstatus") == "F").count()
    want_files = staging.files_for(n_f) + staging.files_for(1500 - n_f)  # F orders sit in a sub-folder
    assert (orders.status, orders.action, orders.n_files, orders.n_columns, orders.row_count) == (
        "success", "create", want_files, 6, 1500
    )
    assert orders.columns[0] == "o_orderkey TEXT" and orders.version == 1
    empty = rows[("archive_PARTS", "EMPTY")]
    assert empty.status == "error" and "Parquet files not found" in empty.error_message  # B3: run continues
    only = rows[("archive", "ONLYDATE")]
    assert only.status == "error" and "no columns left" in only.error_message  # B15
    totals = report_totals(report).first()
    assert (totals.tables_total, totals.tables_succeeded, totals.tables_failed, totals.tables_skipped) == (9, 7, 2, 0)
    assert spark.table(f"{prefix}archive_sales.lineitem").count() == 6000


def test_rerun_skips_then_replaces(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    kw = dict(database_prefix=prefix, database_location=base)
    publish_application(spark, root, **kw)
    again = _by_table(publish_application(spark, root, verify_row_count=True, **kw))
    region = again[("archive", "REGION")]
    assert region.status == "skipped" and region.row_count is None and region.skip_reason.startswith("Table already")
    swapped = _by_table(publish_application(spark, root, replace_existing=True, verify_row_count=True, **kw))
    region = swapped[("archive", "REGION")]
    assert (region.status, region.action, region.version, region.row_count) == ("success", "replace", 2, 5)


def test_row_count_off_by_default(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    report = publish_application(spark, root, database_prefix=prefix, database_location=base)
    assert report.filter(F.col("row_count").isNotNull()).count() == 0


def test_publish_merge(spark, base, prefix):
    apps = staging.stage_applications(spark, SF_SMALL, base)
    kw = dict(database_prefix=prefix, database_location=base)
    row = publish_merge(spark, list(apps.values()), "merged", verify_row_count=True, **kw).first()
    per_app = spark.read.parquet(f"{SF_SMALL}/orders.parquet").groupBy("o_orderstatus").count().collect()
    want_files = sum(staging.files_for(r["count"]) for r in per_app)
    assert (row.status, row.merge, row.n_files, row.row_count) == ("success", True, want_files, 1500)
    assert row.source_applications == ["appF", "appO", "appP"]
    skipped = publish_merge(spark, list(apps.values()), "merged", **kw).first()
    assert skipped.status == "skipped"
    replaced = publish_merge(spark, list(apps.values()), "merged", replace_existing=True, **kw).first()
    assert (replaced.status, replaced.action, replaced.version) == ("success", "replace", 2)


def test_publish_merge_failure_is_an_error_row(spark, base, prefix):
    """A failed merge is reported and counted."""
    apps = staging.stage_applications(spark, SF_SMALL, base, cast_in={"appO": ("o_custkey", "int")})
    report = publish_merge(spark, list(apps.values()), "merged", database_prefix=prefix, database_location=base)
    row = report.first()
    assert row.status == "error" and "o_custkey" in row.error_message
    assert report_totals(report).first().tables_failed == 1


def test_publish_merge_empty_source(spark, base, prefix):
    a = write_df(spark, [(1,)], "id int", f"{base}/appA/parquet/T.parquet")
    fs.mkdirs(spark, f"{base}/appB/parquet/T.parquet")
    row = publish_merge(spark, [a, f"{base}/appB/parquet/T.parquet"], "m", database_prefix=prefix).first()
    assert row.status == "error" and "no Parquet files" in row.error_message


def test_publish_merge_invalid_group_raises(spark, base):
    a = write_df(spark, [(1,)], "id int", f"{base}/appA/parquet/T.parquet")
    b = write_df(spark, [(1,)], "id int", f"{base}/appB/parquet/U.parquet")
    with pytest.raises(MergeGroupError):
        publish_merge(spark, [a, b], "m")


def test_write_and_read_report(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    report = publish_application(
        spark, root, verify_row_count=True, database_prefix=prefix, database_location=base, report_path=f"{base}/rep"
    )
    written = [e.name for e in fs.children(spark, f"{base}/rep")]
    assert len(written) == 1 and written[0].startswith("tablekeep-")
    back = read_report(spark, f"{base}/rep/{written[0]}")
    assert back.exceptAll(report).count() == 0 and report.exceptAll(back).count() == 0
    path = write_report(report, f"{base}/rep2", name="run1")
    assert read_report(spark, path).count() == 8


def test_report_name_is_utc():
    when = dt.datetime(2024, 3, 5, 6, 7, 8, tzinfo=dt.timezone.utc)
    assert report_name("srv", when, "run1") == "srv-05-03-2024_06-07-08-run1"


def test_missing_root_raises(spark, base):
    with pytest.raises(FileNotFoundError):
        publish_application(spark, f"{base}/nothing")


def test_root_without_schemas(spark, base, prefix):
    fs.mkdirs(spark, f"{base}/bare/notes")
    report = publish_application(
        spark, f"{base}/bare", database_prefix=prefix, database_location=base, report_path=f"{base}/rep"
    )
    assert report.count() == 0
    assert not fs.exists(spark, f"{base}/rep")  # nothing processed, no report written


def test_count_failure_isolated_to_its_table(spark, base, prefix, monkeypatch):
    """If the one count job fails, folders are counted one by one and only the
    failing table becomes an error row (the others keep their counts)."""
    real = publish_mod.footer_row_counts

    def flaky(spark_, root_, dirs):
        if len(dirs) > 1 or dirs[0].table_name == "NATION":
            raise RuntimeError("file vanished")
        return real(spark_, root_, dirs)

    monkeypatch.setattr(publish_mod, "footer_row_counts", flaky)
    root = staging.stage_archive(spark, SF_SMALL, base)
    rows = _by_table(
        publish_application(spark, root, verify_row_count=True, database_prefix=prefix, database_location=base)
    )
    nation = rows[("archive", "NATION")]
    assert nation.status == "error" and "row count failed: file vanished" in nation.error_message
    assert rows[("archive", "REGION")].row_count == 5 and rows[("archive", "REGION")].status == "success"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("134217728b", "134217728", "128MB")


def test_error_text_is_whole():
    text = "boom\n: java.io.IOException: gone\n\tat x.y(z)" + "x" * 5000
    assert error_text(RuntimeError(text)) == text  # the whole message


def test_name_collision_is_an_error_row(spark, base, prefix):
    """T1 during a publish: the two clashing tables are error rows, the rest publish."""
    write_df(spark, [(1,)], "id int", f"{base}/r/parquet/Orders.parquet")
    write_df(spark, [(2,)], "id int", f"{base}/r/parquet/ORDERS.parquet")
    write_df(spark, [(3,)], "id int", f"{base}/r/parquet/OTHER.parquet")
    rows = _by_table(publish_application(spark, f"{base}/r", database_prefix=prefix, database_location=base))
    assert rows[("r", "Orders")].status == "error" and "collision" in rows[("r", "Orders")].error_message
    assert rows[("r", "ORDERS")].status == "error"
    assert rows[("r", "OTHER")].status == "success"


def test_b4_unreadable_table_is_an_error_row(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    fs.write_text(spark, f"{root}/parquet/BROKEN.parquet/part-0.parquet", "not a parquet file")
    rows = _by_table(publish_application(spark, root, database_prefix=prefix, database_location=base))
    broken = rows[("archive", "BROKEN")]
    assert broken.status == "error" and broken.error_message
    assert "not a Parquet file" in broken.error_message  # the whole message, cause included
    assert rows[("archive", "REGION")].status == "success"


def test_type_conflict_inside_one_table_is_an_error_row(spark, base, prefix):
    """B19 in publish mode: files of one table disagree on a type; that table fails alone."""
    root = f"{base}/r"
    write_df(spark, [(1,)], "id int", f"{root}/parquet/MIXED.parquet/a")
    write_df(spark, [(2,)], "id bigint", f"{root}/parquet/MIXED.parquet/b")
    write_df(spark, [(3,)], "id int", f"{root}/parquet/FINE.parquet")
    rows = _by_table(publish_application(spark, root, database_prefix=prefix, database_location=base))
    assert rows[("r", "MIXED")].status == "error" and "CANNOT_MERGE" in rows[("r", "MIXED")].error_message
    assert rows[("r", "FINE")].status == "success"


def test_report_document(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    publish_application(
        spark, root, verify_row_count=True, database_prefix=prefix, database_location=base,
        report_path=f"{base}/docs", report_format="document",
    )
    written = fs.children(spark, f"{base}/docs")
    assert len(written) == 1 and written[0].name.endswith(".json")
    doc = json.loads(fs.read_text(spark, written[0].path))
    assert doc["process"] == "External Table Creation"
    assert (doc["total_tables_processed_successfully"], doc["total_tables_errored_out"]) == (7, 1)
    orders = doc["schemas"]["archive_SALES"]["tables"]["ORDERS"]
    assert orders["status"] == "success" and orders["row_count"] == 1500 and orders["columns_count"] == 6
    assert orders["column_types"][0] == "o_orderkey TEXT"
    assert doc["schemas"]["archive_PARTS"]["tables"]["EMPTY"]["status"] == "error"
    assert doc["start_time"] <= doc["end_time"]


def test_transient_registration_error_is_retried_once(spark, base, prefix, monkeypatch):
    real = publish_mod.register_table
    calls = {"REGION": 0}

    def flaky(spark_, schema_name, table_name, *a, **k):
        if table_name == "REGION":
            calls["REGION"] += 1
            if calls["REGION"] == 1:
                raise RuntimeError("catalog hiccup")
        return real(spark_, schema_name, table_name, *a, **k)

    monkeypatch.setattr(publish_mod, "register_table", flaky)
    root = staging.stage_archive(spark, SF_SMALL, base)
    rows = _by_table(publish_application(spark, root, database_prefix=prefix, database_location=base))
    assert rows[("archive", "REGION")].status == "success" and calls["REGION"] == 2
    assert rows[("archive_PARTS", "EMPTY")].status == "error"  # deterministic errors are not retried


def test_schemas_are_created_even_when_their_tables_fail(spark, base, prefix):
    root = f"{base}/r"
    fs.mkdirs(spark, f"{root}/only_empty/parquet/E.parquet")
    write_df(spark, [(1,)], "id int", f"{root}/good/parquet/T.parquet")
    rows = _by_table(publish_application(spark, root, database_prefix=prefix, database_location=base))
    assert rows[("only_empty", "E")].status == "error"
    assert spark.catalog.databaseExists(f"{prefix}only_empty") and spark.catalog.databaseExists(f"{prefix}good")


def test_concurrent_publish_many_tables(spark, base, prefix):
    """30 tables in 3 new databases, 32 pool threads: every table lands, counts are right."""
    root = f"{base}/many"
    df = spark.range(7).selectExpr("CAST(id AS INT) AS id").coalesce(1)
    for s in range(3):
        for t in range(10):
            df.write.parquet(f"{root}/s{s}/parquet/T{t}.parquet")
    report = publish_application(
        spark, root, verify_row_count=True, database_prefix=prefix, database_location=base, max_workers=32
    )
    rows = report.collect()
    assert len(rows) == 30 and all(r.status == "success" and r.row_count == 7 for r in rows)
    assert sum(spark.table(r.catalog_table).count() for r in rows[:3]) == 21


def test_publish_merge_reconciles_types_as_text(spark, base, prefix):
    apps = staging.stage_applications(spark, SF_SMALL, base, cast_in={"appO": ("o_custkey", "int")})
    row = publish_merge(
        spark, list(apps.values()), "merged", on_conflict="text", verify_row_count=True,
        database_prefix=prefix, database_location=base,
    ).first()
    assert (row.status, row.row_count) == ("success", 1500)
    assert "o_custkey TEXT" in row.columns
    assert dict(spark.table(f"{prefix}merged.orders").dtypes)["o_custkey"] == "string"


def test_only_changed_tables_are_published_again(spark, base, prefix):
    from tablekeep.operators.report import SKIP_REASON_UNCHANGED, read_file_list

    root, lists = f"{base}/shop", f"{base}/files"
    paths = {t: f"{root}/parquet/{t}.parquet" for t in ("SAME", "MORE", "LESS", "BAD", "REWRITTEN")}
    for t, path in paths.items():
        for part in "ab":
            write_df(spark, [(1,)], "id long", f"{path}/{part}")
    fs.write_text(spark, f"{paths['BAD']}/junk.parquet", "junk")
    options = dict(replace_existing=True, verify_row_count=True, database_prefix=prefix, database_location=base, files_path=lists)
    first = _by_table(publish_application(spark, root, only_changed=True, **options))
    assert {t: r.status for (_, t), r in first.items()} == {t: "error" if t == "BAD" else "success" for t in paths}
    again = _by_table(publish_application(spark, root, only_changed=True, **options))
    assert {t for (_, t), r in again.items() if r.skip_reason == SKIP_REASON_UNCHANGED} == set(paths) - {"BAD"}
    assert again[("shop", "BAD")].status == "error"  # never published, so never unchanged

    write_df(spark, [(2,)], "id long", f"{paths['MORE']}/c")
    fs.delete_file(spark, [e.path for e in fs.children(spark, f"{paths['LESS']}/b") if e.path.endswith(".parquet")][0])
    write_df(spark, [(5,)], "id long", f"{paths['REWRITTEN']}/a")
    third = _by_table(publish_application(spark, root, only_changed=True, **options))
    assert {t: (r.status, r.row_count) for (_, t), r in third.items() if t != "BAD"} == {
        "SAME": ("skipped", None), "MORE": ("success", 3), "LESS": ("success", 1), "REWRITTEN": ("success", 2)
    }
    lists_of = read_file_list(spark, lists)
    assert lists_of.select("run_id").distinct().count() == 3
    assert lists_of.filter("table_name = 'MORE'").groupBy("listed_at").count().orderBy("listed_at").toPandas()["count"].tolist() == [2, 2, 3]
    with pytest.raises(ValueError, match="files_path"):
        publish_application(spark, root, only_changed=True)


def test_file_list_of_a_merge(spark, base, prefix):
    from tablekeep.operators.report import read_file_list

    paths = [write_df(spark, [(i,)], "id long", f"{base}/a{i}/parquet/T.parquet") for i in range(2)]
    report = publish_merge(spark, paths, "m", database_prefix=prefix, database_location=base, files_path=f"{base}/files")
    rows = read_file_list(spark, f"{base}/files").collect()
    assert {(r.schema_name, r.table_name, r.status, r.run_id) for r in rows} == {("m", "T", "success", report.first().run_id)}
    assert sorted(r.table_path for r in rows) == sorted(fs.qualify(spark, p) for p in paths)


def test_layouts_come_from_the_one_listing(spark, base, prefix, monkeypatch):
    """Flat, keyed, mixed and empty tables: no table folder is listed again for its layout."""
    from tablekeep.plans import registration
    from tablekeep.sources.scan import scan_table

    path = f"{base}/shop one/parquet"
    for table, folders in {"FLAT": [""], "KEYED": ["/d=2024-01-05", "/d=2024-02-06"], "MIXED": ["/part", "/d=2024-01-05/k=a b"]}.items():
        for i, folder in enumerate(folders):
            write_df(spark, [(i,)], "id long", f"{path}/{table}.parquet{folder}")
    fs.mkdirs(spark, f"{path}/EMPTY.parquet")
    want = {t: sorted(map(str, scan_table(spark, f"{path}/{t}.parquet").collect())) for t in ("FLAT", "KEYED", "MIXED")}

    def listed(*_):
        raise AssertionError("listed again")

    monkeypatch.setattr(registration, "table_layout", listed)
    report = publish_application(spark, f"{base}/shop one", verify_row_count=True, database_prefix=prefix, database_location=base)
    rows = {r.table_name: r for r in report.collect()}
    assert {t: r.status for t, r in rows.items()} == {"FLAT": "success", "KEYED": "success", "MIXED": "success", "EMPTY": "error"}
    for table, expected in want.items():
        published = spark.table(rows[table].catalog_table)
        assert sorted(map(str, published.collect())) == expected
        assert dict(published.dtypes).get("d", "date") == "date"
