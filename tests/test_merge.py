"""Merge groups (O13), merged tables (O14, O15) and the one-scan merge read."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, plan_text, write_df
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeep import staging
from tablekeep.operators.merge import (
    MergeConflictError,
    MergeGroupError,
    align_schemas,
    merge_group,
    merge_sources,
    merge_tables,
)
from tablekeep.operators.project import NoColumnsLeftError
from tablekeep.plans.registration import register_merged
from tablekeep.sources import fs
from tablekeep.sources.manifest import MissingDataFilesError
from tablekeep.sources.scan import scan_tables


def test_merge_group_names_applications(spark, base):
    apps = staging.stage_applications(spark, SF_SMALL, base)
    rows = merge_group(spark, list(apps.values())).orderBy("ordinal").collect()
    assert [(r.source_application, r.table_name) for r in rows] == [("appF", "ORDERS"), ("appO", "ORDERS"), ("appP", "ORDERS")]


@pytest.mark.parametrize(
    "case, match",
    [
        ("empty", "at least"),
        ("missing", "no folder at"),
        ("not_parquet", "not a table folder"),
        ("duplicate", "given twice"),
        ("overlap", "overlapping"),
        ("two_tables", "one table, these are 2: A, ORDERS"),
    ],
)
def test_merge_group_rules(spark, base, case, match):
    apps = staging.stage_applications(spark, SF_SMALL, base)
    first = apps["appF"]
    other = write_df(spark, [(1,)], "id int", f"{base}/x/parquet/A.parquet")
    plain = write_df(spark, [(1,)], "id int", f"{base}/x/parquet/plain")
    nested = write_df(spark, [(1,)], "id int", f"{first}/inner/parquet/ORDERS.parquet")
    paths = {
        "empty": [],
        "missing": [first, f"{base}/nope/parquet/ORDERS.parquet"],
        "not_parquet": [first, plain],
        "duplicate": [first, first + "/"],
        "overlap": [first, nested],
        "two_tables": [first, other],
    }[case]
    with pytest.raises(MergeGroupError, match=match):
        merge_sources(spark, paths)


def test_merge_is_union_all_by_name_without_dedupe(spark, base):
    a = write_df(spark, [(1, "x"), (1, "x")], "id int, name string", f"{base}/A/parquet/T.parquet")
    b = write_df(spark, [("y", 1)], "name string, id int", f"{base}/B/parquet/T.parquet")
    rows = sorted(tuple(r) for r in merge_tables(spark, [a, b]).collect())
    assert rows == [(1, "x", "A"), (1, "x", "A"), (1, "y", "B")]


def test_merge_missing_columns_and_pruning(spark, base):
    apps = staging.stage_applications(spark, SF_SMALL, base, drop_in={"appO": "o_orderpriority"})
    df = merge_tables(spark, list(apps.values()))
    assert "ArchiveCreationDate" not in df.columns
    nulls = df.filter(F.col("o_orderpriority").isNull()).select("source_application").distinct().collect()
    assert [r.source_application for r in nulls] == ["appO"]
    pruned = df.filter(F.col("source_application") == "appO")
    assert plan_text(pruned).count("FileScan parquet") == 1
    assert plan_text(df).count("FileScan parquet") == 3


@pytest.mark.parametrize(
    "type_a, type_b",
    [("int", "bigint"), ("int", "string"), ("decimal(10,2)", "decimal(12,4)")],
)
def test_f7_type_conflict_is_named(spark, base, type_a, type_b):
    a, b = f"{base}/appA/parquet/ITEMS.parquet", f"{base}/appB/parquet/ITEMS.parquet"
    one = spark.createDataFrame([(1,)], "id int")
    one.selectExpr(f"CAST(id AS {type_a}) AS id").write.parquet(a)
    one.selectExpr(f"CAST(id AS {type_b}) AS id").write.parquet(b)
    with pytest.raises(MergeConflictError, match=r"'id'.*appA.*appB"):
        merge_tables(spark, [a, b])
    as_text = merge_tables(spark, [a, b], on_conflict="text")
    assert dict(as_text.dtypes)["id"] == "string"
    assert as_text.count() == 2
    with pytest.raises(Exception, match="CANNOT_MERGE_SCHEMAS"):  # the single merged read fails like the tool
        scan_tables(spark, [a, b]).schema


def test_decimals_of_equal_scale_widen(spark, base):
    a = write_df(spark, [(1,)], "id int", f"{base}/appA/parquet/D.parquet")
    spark.read.parquet(a).selectExpr("CAST(id AS decimal(10,2)) AS v").write.parquet(f"{base}/appB/parquet/D.parquet")
    spark.read.parquet(a).selectExpr("CAST(id AS decimal(12,2)) AS v").write.parquet(f"{base}/appC/parquet/D.parquet")
    df = merge_tables(spark, [f"{base}/appB/parquet/D.parquet", f"{base}/appC/parquet/D.parquet"])
    assert dict(df.dtypes)["v"] == "decimal(12,2)"


def test_provenance_column_clash(spark, base):
    a = write_df(spark, [(1, "z")], "id int, source_application string", f"{base}/A/parquet/T.parquet")
    with pytest.raises(ValueError, match="source_application"):
        merge_tables(spark, [a])
    assert merge_tables(spark, [a], provenance_col="origin_app").columns[-1] == "origin_app"


def test_only_archive_column_is_an_error(spark, base):
    """F10 / B15 in merge mode."""
    a = f"{base}/A/parquet/T.parquet"
    spark.sql("SELECT DATE'2024-01-01' AS ArchiveCreationDate").write.parquet(a)
    with pytest.raises(NoColumnsLeftError):
        merge_tables(spark, [a])


def test_scan_tables_single_scan_with_provenance(spark, base):
    apps = staging.stage_applications(spark, SF_SMALL, base)
    df = scan_tables(spark, list(apps.values()), provenance={p: a for a, p in apps.items()})
    assert plan_text(df).count("FileScan parquet") == 1
    counts = {r.source_application: r["count"] for r in df.groupBy("source_application").count().collect()}
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    want = {f"app{r.o_orderstatus}": r["count"] for r in orders.groupBy("o_orderstatus").count().collect()}
    assert counts == want


def test_merge_with_spaces_in_application(spark, base):
    a = write_df(spark, [(1,)], "id int", f"{base}/app one/parquet/T.parquet")
    b = write_df(spark, [(2,)], "id int", f"{base}/app+two%/parquet/T.parquet")
    fs.write_text(spark, f"{b}/.junk.parquet", "junk")
    rows = sorted(tuple(r) for r in merge_tables(spark, [a, b]).collect())
    assert rows == [(1, "app one"), (2, "app+two%")]
    scanned = scan_tables(spark, [a, b], provenance={a: "one", b: "two"})
    assert sorted(tuple(r) for r in scanned.collect()) == [(1, "one"), (2, "two")]


def test_b2_partitioned_sources_keep_partition_column(spark, base, prefix):
    """B2 in merge mode: each partitioned source is read alone, so the column survives."""
    a = staging.stage_partitioned(spark, SF_SMALL, base, app="appX")
    b = staging.stage_partitioned(spark, SF_SMALL, base, app="appY")
    df = merge_tables(spark, [a, b])
    assert "o_orderstatus" in df.columns and df.count() == 3000
    reg = register_merged(spark, "m", [a, b], database_prefix=prefix, database_location=base)
    view = spark.table(reg.catalog_table)
    assert view.filter(F.col("o_orderstatus") == "F").count() == 2 * spark.read.parquet(
        f"{SF_SMALL}/orders.parquet"
    ).filter(F.col("o_orderstatus") == "F").count()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan_text(view.filter(F.col("o_orderstatus") == "F"))


def test_case_twins_in_one_source_are_refused():
    twin = T.StructType([T.StructField("ID", T.IntegerType()), T.StructField("id", T.IntegerType())])
    with pytest.raises(MergeConflictError, match="differ only by case"):
        align_schemas([twin], ["appA"])


def test_empty_source_fails_the_group(spark, base):
    a = write_df(spark, [(1,)], "id int", f"{base}/A/parquet/T.parquet")
    fs.mkdirs(spark, f"{base}/B/parquet/T.parquet")
    with pytest.raises(MissingDataFilesError, match="B/parquet/T.parquet"):
        merge_tables(spark, [a, f"{base}/B/parquet/T.parquet"])


def test_disjoint_paths_are_found_by_their_neighbours():
    import random
    import time

    from tablekeep.operators.merge import MergeGroupError, check_disjoint

    rng = random.Random(1)
    for _ in range(2000):
        paths = ["/".join(rng.choice(["a", "a-", "a!", "b"]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 4))]
        clash = any(i != j and (p == q or q.startswith(p + "/")) for i, p in enumerate(paths) for j, q in enumerate(paths))
        try:
            check_disjoint(paths)
            assert not clash
        except MergeGroupError:
            assert clash
    many, begin = [f"/archive/app{i}/parquet/T.parquet" for i in range(10_000)], time.perf_counter()
    check_disjoint(many)
    assert time.perf_counter() - begin < 1
