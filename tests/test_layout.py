"""Discovery, manifests and scans over the documented folder layouts."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, plan_text, write_df
from pyspark.sql import functions as F

from tablekeep import staging
from tablekeep.operators.counts import row_counts
from tablekeep.operators.merge import merge_tables
from tablekeep.plans.registration import register_merged
from tablekeep.sources import fs
from tablekeep.sources.layout import DuplicateTableError, discover_schemas, discover_tables, empty_tables
from tablekeep.sources.manifest import MissingDataFilesError, file_manifest, require_files
from tablekeep.sources.scan import partition_columns, scan_table


def _names(df):
    return sorted((r.schema_name, r.table_name) for r in df.collect())


def test_f1_root_is_a_schema(spark, base):
    staging.stage_table(spark, SF_SMALL, base, "orders", app="app", archive_column=True)
    tables = discover_tables(spark, f"{base}/app").collect()
    assert [(r.schema_name, r.table_name, r.n_files) for r in tables] == [("app", "ORDERS", staging.files_for(1500))]


def test_f2_child_schemas(spark, base):
    staging.stage_applications(spark, SF_SMALL, base)
    assert _names(discover_tables(spark, base)) == [("appF", "ORDERS"), ("appO", "ORDERS"), ("appP", "ORDERS")]


def test_f3_mixed_structure_and_noise(spark, base):
    root = staging.stage_archive(spark, SF_SMALL, base)
    names = _names(discover_tables(spark, root))
    assert ("archive", "REGION") in names and ("archive_SALES", "ORDERS") in names
    assert ("archive", "FLAT") not in names  # a flat file under parquet/ is no table
    assert len(names) == 8
    schemas = sorted(r.schema_name for r in discover_schemas(spark, root).collect())
    assert schemas == ["archive", "archive_PARTS", "archive_SALES"]  # notes/ has no parquet/


def test_f4_empty_table_directory(spark, base):
    root = staging.stage_archive(spark, SF_SMALL, base)
    assert _names(empty_tables(spark, root)) == [("archive_PARTS", "EMPTY")]
    counts = {(r.schema_name, r.table_name): r.row_count for r in row_counts(spark, root).collect()}
    assert counts[("archive_PARTS", "EMPTY")] == 0
    assert counts[("archive_SALES", "ORDERS")] == 1500


def test_f5_one_file_set_for_schema_and_rows(spark, base):
    """A.parquet and sub/d.parquet count; .b, _c, g.PARQUET do not."""
    table = f"{base}/app/parquet/T.parquet"
    write_df(spark, [(1,), (2,)], "id int", f"{base}/stage/a")
    write_df(spark, [(3,)], "id int", f"{base}/stage/d")
    write_df(spark, [(9,)], "id int", f"{base}/stage/x")

    def part_file(folder):
        return next(e.path for e in fs.children(spark, folder) if e.name.endswith(".parquet"))

    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()

    def copy(src, dst):
        p = jvm.org.apache.hadoop.fs.Path(src)
        jvm.org.apache.hadoop.fs.FileUtil.copy(
            p.getFileSystem(conf), p, p.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(dst), False, conf
        )

    copy(part_file(f"{base}/stage/a"), f"{table}/a.parquet")
    copy(part_file(f"{base}/stage/d"), f"{table}/sub/d.parquet")
    for junk in (".b.parquet", "_c.parquet", "g.PARQUET"):
        copy(part_file(f"{base}/stage/x"), f"{table}/{junk}")
    fs.write_text(spark, f"{base}/app/parquet/FLAT.parquet", "flat file")

    files = sorted(r.file_path.rsplit("/", 2)[-2] + "/" + r.file_path.rsplit("/", 1)[-1]
                   for r in file_manifest(spark, [table]).collect())
    assert files == ["T.parquet/a.parquet", "sub/d.parquet"]
    assert sorted(r.id for r in scan_table(spark, table).collect()) == [1, 2, 3]
    assert [r.row_count for r in row_counts(spark, f"{base}/app").collect()] == [3]
    assert _names(discover_tables(spark, f"{base}/app")) == [("app", "T")]


def test_f6_schema_merge_fills_nulls(spark, base):
    path = staging.stage_schema_drift(spark, SF_SMALL, base)
    df = scan_table(spark, path)
    assert "o_orderpriority" in df.columns
    nulls = df.filter(F.col("o_orderpriority").isNull()).groupBy("o_orderstatus").count().collect()
    assert [r.o_orderstatus for r in nulls] == ["O"]


def test_f8_spaces_and_percent_in_paths(spark, base):
    root = f"{base}/app C"
    write_df(spark, [(1, "x"), (2, "y")], "id int, name string", f"{root}/a b%c+d/parquet/ITEMS.parquet")
    write_df(spark, [(3, "z")], "id int, name string", f"{root}/parquet/ITEMS.parquet/in [dir]")
    assert _names(discover_tables(spark, root)) == [("a b%c+d", "ITEMS"), ("app C", "ITEMS")]
    counts = sorted((r.schema_name, r.row_count) for r in row_counts(spark, root).collect())
    assert counts == [("a b%c+d", 2), ("app C", 1)]


def test_f9_partition_folders(spark, base):
    path = staging.stage_partitioned(spark, SF_SMALL, base)
    assert partition_columns(spark, path) == ["o_orderstatus"]
    df = scan_table(spark, path)
    assert "o_orderstatus" in df.columns and df.count() == 1500
    pruned = df.filter(F.col("o_orderstatus") == "O")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan_text(pruned)
    assert [r.row_count for r in row_counts(spark, f"{base}/app_part").collect()] == [1500]


def test_b14_duplicate_schema_and_table(spark, base):
    root = f"{base}/dup"
    write_df(spark, [(1,)], "id int", f"{root}/parquet/T.parquet")
    write_df(spark, [(2,)], "id int", f"{root}/dup/parquet/T.parquet")
    with pytest.raises(DuplicateTableError):
        discover_tables(spark, root)


def test_o10_schema_needs_a_table_folder(spark, base):
    root = f"{base}/r"
    fs.mkdirs(spark, f"{root}/empty_schema/parquet")
    fs.write_text(spark, f"{root}/flat_only/parquet/X.parquet", "a file")
    write_df(spark, [(1,)], "id int", f"{root}/ok/parquet/T.parquet")
    assert _names(discover_tables(spark, root)) == [("ok", "T")]


def test_missing_root_raises(spark, base):
    with pytest.raises(FileNotFoundError):
        discover_tables(spark, f"{base}/nope")


def test_o3_require_files_fails_whole_group(spark, base):
    ok = write_df(spark, [(1,)], "id int", f"{base}/a/parquet/T.parquet")
    fs.mkdirs(spark, f"{base}/b/parquet/T.parquet")
    assert require_files(spark, [ok]).first().n_files == 1
    with pytest.raises(MissingDataFilesError, match="b/parquet/T.parquet"):
        require_files(spark, [ok, f"{base}/b/parquet/T.parquet"])


def test_manifest_reads_no_file_content(spark, base):
    root = staging.stage_archive(spark, SF_SMALL, base)
    plan = plan_text(file_manifest(spark, [f"{root}/parquet/REGION.parquet"]))
    assert "content" not in plan.split("ReadSchema:")[1]


def test_o2_single_file_manifest(spark, base):
    """O2 also takes one file."""
    folder = write_df(spark, [(1,), (2,)], "id int", f"{base}/one")
    part = next(e.path for e in fs.children(spark, folder) if e.name.endswith(".parquet"))
    rows = file_manifest(spark, [part]).collect()
    assert len(rows) == 1 and rows[0].file_path == part and rows[0].n_bytes > 0


def test_glob_characters_in_folder_names(spark, base, prefix):
    """Folder names with [ ] { } ? * are taken literally everywhere, registration included."""
    root = f"{base}/root[1]"
    a = write_df(spark, [(1,), (2,), (3,)], "id int", f"{root}/app{{a,b}}/parquet/T*x.parquet")
    b = write_df(spark, [(4,)], "id int", f"{root}/app?c/parquet/T*x.parquet")
    assert _names(discover_tables(spark, root)) == [("app?c", "T*x"), ("app{a,b}", "T*x")]
    assert sorted((r.schema_name, r.row_count) for r in row_counts(spark, root).collect()) == [("app?c", 1), ("app{a,b}", 3)]
    assert merge_tables(spark, [a, b]).count() == 4
    reg = register_merged(spark, "g", [a, b], database_prefix=prefix, database_location=base)
    assert sorted(r.id for r in spark.table(reg.catalog_table).collect()) == [1, 2, 3, 4]


def test_first_data_file_follows_the_manifest_rules(spark, base):
    table = f"{base}/t/parquet/T.parquet"
    fs.write_text(spark, f"{table}/.hidden.parquet", "x")
    fs.write_text(spark, f"{table}/_tmp/inner.parquet", "x")
    fs.write_text(spark, f"{table}/notes.txt", "x")
    assert fs.first_data_file(spark, table) is None
    fs.write_text(spark, f"{table}/deep/er/real.parquet", "x")
    assert fs.first_data_file(spark, table).endswith("deep/er/real.parquet")
    assert fs.first_data_file(spark, f"{base}/missing") is None


def test_scan_of_a_single_file(spark, base):
    folder = write_df(spark, [(1,), (2,)], "id int", f"{base}/one")
    part = next(e.path for e in fs.children(spark, folder) if e.name.endswith(".parquet"))
    assert sorted(r.id for r in scan_table(spark, part).collect()) == [1, 2]
