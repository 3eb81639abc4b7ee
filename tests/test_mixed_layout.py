"""Folders that mix flat, nested and key=value files lose no row."""
import pytest
from conftest import plan_text, write_df
from tablekeep.plans.publish import publish_application, publish_merge
from tablekeep.plans.registration import register_table
from tablekeep.operators.merge import merge_tables
from tablekeep.sources import fs
from tablekeep.sources.manifest import assign_sources, file_manifest
from tablekeep.sources.scan import SourcePart, scan_table, scan_tables, table_layout


def mixed(spark, path):
    write_df(spark, [(i, "flat") for i in range(4)], "id long, kind string", path)
    for folder, ids in (("yr=0", (4, 5)), ("yr=1/mo=a b", (6,)), ("sub", (7, 8)), ("yr=__HIVE_DEFAULT_PARTITION__", (9,))):
        write_df(spark, [(i, "keyed") for i in ids], "id long, kind string", f"{path}/{folder}")
    return path


EXPECTED = {0: (None, None), 3: (None, None), 4: (0, None), 6: (1, "a b"), 8: (None, None), 9: (None, None)}


def check(rows):
    got = {r["id"]: (r["yr"], r["mo"]) for r in rows}
    assert sorted(got) == list(range(10)) and {k: got[k] for k in EXPECTED} == EXPECTED


def test_scan_and_register(spark, base, prefix):
    path = mixed(spark, f"{base}/shop/parquet/T.parquet")
    layout = table_layout(spark, path)
    assert layout.mixed and dict(layout.keys) == {"yr": "int", "mo": "string"}  # as in a folder of yr= levels alone
    check(scan_table(spark, path).collect())
    done = register_table(spark, "shop", "T", path, database_prefix=prefix, database_location=base)
    check(spark.table(done.quoted).collect())
    assert spark.table(done.quoted).filter("yr = 1").count() == 1


def test_publish_both_modes(spark, base, prefix):
    path = mixed(spark, f"{base}/shop/parquet/T.parquet")
    other = mixed(spark, f"{base}/shop2/parquet/T.parquet")
    row = publish_application(spark, f"{base}/shop", verify_row_count=True, database_prefix=prefix, database_location=base).first()
    assert (row.status, row.row_count) == ("success", 10)
    row = publish_merge(spark, [path, other], "both", verify_row_count=True, database_prefix=prefix, database_location=base).first()
    assert (row.status, row.row_count) == ("success", 20)


def test_a_view_with_fewer_rows_is_an_error(spark, base, prefix, monkeypatch):
    from tablekeep.plans import registration

    mixed(spark, f"{base}/shop/parquet/T.parquet")
    real = registration._relation_sql
    monkeypatch.setattr(registration, "_relation_sql", lambda *a: f"(SELECT * FROM {real(*a)} WHERE id > 2)")
    row = publish_application(spark, f"{base}/shop", verify_row_count=True, database_prefix=prefix, database_location=base).first()
    assert row.status == "error" and "7 rows" in row.error_message and "10" in row.error_message


def test_long_error_texts_stay_whole():
    from tablekeep.operators.report import error_text, report_name

    text = "x" * 10_000 + "\n\tat somewhere"
    assert error_text(ValueError(text)) == text
    assert report_name() != report_name()


KEYS = {  # values of one key, and its type in every layout
    "d": (["2024-01-05", "2024-02-06"], "date"),
    "t": (["2024-01-05", "2024-02-06 10:11:12"], "timestamp"),
    "i": (["7", "-12"], "int"),
    "l": (["7", "3000000000"], "bigint"),
    "f": (["1", "2.5"], "double"),
    "s": (["1d", "2f"], "string"),
    "n": (["__HIVE_DEFAULT_PARTITION__"], "string"),
}


def files_read(df):
    """Files that the scans of a run query opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") and "Adaptive" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(int(leaves.apply(i).metrics().apply("numFiles").value()) for i in range(leaves.size()))


@pytest.mark.parametrize("key", KEYS)
def test_one_key_type_whatever_the_layout(spark, base, prefix, key):
    from urllib.parse import quote as escape

    values, dtype = KEYS[key]
    uniform, with_flat = f"{base}/a/parquet/T.parquet", f"{base}/b/parquet/T.parquet"
    for path in (uniform, with_flat):
        for i, v in enumerate(values):
            write_df(spark, [(i,)], "id long", f"{path}/{key}={escape(v)}")
    write_df(spark, [(9,)], "id long", f"{with_flat}/flat")
    one, two = scan_table(spark, uniform), scan_table(spark, with_flat)
    assert dict(one.dtypes)[key] == dict(two.dtypes)[key] == dtype
    assert sorted(map(tuple, two.filter("id < 9").collect())) == sorted(map(tuple, one.collect()))
    assert [r[key] for r in two.filter("id = 9").collect()] == [None]
    merged = merge_tables(spark, [uniform, with_flat])
    assert dict(merged.dtypes)[key] == dtype and merged.count() == 2 * len(values) + 1
    scanned = scan_tables(spark, [uniform, with_flat], provenance={uniform: "a", with_flat: "b"})
    assert dict(scanned.dtypes)[key] == dtype
    assert sorted(map(str, scanned.select(*merged.columns).collect())) == sorted(map(str, merged.collect()))
    done = register_table(spark, "shop", "T", uniform, database_prefix=prefix, database_location=base)
    assert dict(spark.table(done.quoted).dtypes)[key] == dtype
    assert sorted(map(tuple, spark.table(done.quoted).select(*one.columns).collect())) == sorted(map(tuple, one.collect()))


def test_filters_on_keys_and_sources_leave_out_files(spark, base, prefix):
    paths = [f"{base}/app{i}/parquet/T.parquet" for i in range(3)]
    for path in paths:
        for d in range(1, 5):
            write_df(spark, [(d,)], "id long", f"{path}/d=2024-01-0{d}")
        write_df(spark, [(9,)], "id long", f"{path}/flat")
    assert files_read(scan_table(spark, paths[0])) == 5
    assert files_read(scan_table(spark, paths[0]).filter("d = DATE'2024-01-03'")) == 1
    done = register_table(spark, "shop", "T", paths[0], database_prefix=prefix, database_location=base)
    assert files_read(spark.table(done.quoted).filter("d >= DATE'2024-01-03'")) == 2
    df = scan_tables(spark, paths, provenance={p: f"app{i}" for i, p in enumerate(paths)})
    assert plan_text(df).count("FileScan parquet") == 1
    assert files_read(df) == 15 and files_read(df.filter("source_application = 'app1'")) == 5
    assert files_read(df.filter("source_application = 'app1' AND d = DATE'2024-01-02'")) == 1


def test_sources_at_several_depths(spark, base):
    paths = [f"{base}/a/parquet/T.parquet", f"{base}/x/y z/a+b/parquet/T.parquet", f"{base}/x/parquet/T.parquet"]
    for i, path in enumerate(paths):
        write_df(spark, [(i,)], "id long", f"{path}/k={i}" if i else path)
    df = scan_tables(spark, paths, provenance={p: f"s{i}" for i, p in enumerate(paths)})
    assert sorted(map(tuple, df.collect())) == [(0, None, "s0"), (1, 1, "s1"), (2, 2, "s2")]
    qualified = [fs.qualify(spark, p) for p in paths]
    files = assign_sources(file_manifest(spark, paths), qualified)
    assert sorted(r.source_path for r in files.collect()) == sorted(qualified)


def test_the_source_look_up_does_not_grow_the_plan(spark, base):
    path = write_df(spark, [(1,)], "id long", f"{base}/app7/parquet/T.parquet")
    many = [f"{base}/app{i}/parquet/T.parquet" for i in range(200)]
    label = SourcePart(spark, many).pick([f"app{i}" for i in range(200)])
    df = spark.read.parquet(path).select("id", label.alias("app"))
    assert [tuple(r) for r in df.collect()] == [(1, "app7")]
    assert files_read(df.filter("app = 'app8'")) == 0
    assert df._jdf.queryExecution().optimizedPlan().toString().count("CASE") == 0
