"""Catalog registration: create / skip / replace, atomic swap, merged views."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL, plan_text, write_df
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeep import staging
from tablekeep.plans.registration import (
    NameCollisionError,
    NotManagedError,
    existing_tables,
    plan_registration,
    register_merged,
    register_table,
    registered_tables,
    replace_table,
    schema_exists,
    table_exists,
    table_properties,
    unregister,
)
from tablekeep.plans import registry
from tablekeep.plans.publish import publish_merge
from tablekeep.session import scoped_conf
from tablekeep.sources import fs
from tablekeep.sources.layout import discover_tables
from tablekeep.sources.manifest import MissingDataFilesError


def names_in(spark, db):
    return {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()}


def test_register_creates_external_base_and_view(spark, base, prefix):
    path = staging.stage_table(spark, SF_SMALL, base, "orders", archive_column=True)
    reg = register_table(spark, "Shop", "ORDERS", path, database_prefix=prefix, database_location=base)
    assert reg.catalog_table == f"{prefix}shop.orders" and reg.action == "create" and reg.version == 1
    view = spark.table(reg.catalog_table)
    assert "ArchiveCreationDate" not in view.columns and view.count() == 1500
    props = table_properties(spark, f"{prefix}shop", "orders")
    assert props["tablekeep.schema_name"] == "Shop" and props["tablekeep.table_name"] == "ORDERS"
    spark.sql(f"DROP TABLE {prefix}tablekeep_bases.{reg.base_tables[0]}")
    assert fs.exists(spark, path)  # external: files stay


def test_pushdown_and_pruning_reach_the_scan(spark, base, prefix):
    path = staging.stage_table(spark, SF_SMALL, base, "orders", archive_column=True)
    reg = register_table(spark, "shop", "ORDERS", path, database_prefix=prefix, database_location=base)
    q = spark.table(reg.catalog_table).filter(F.col("o_orderkey") < 10).select("o_orderkey", "o_totalprice")
    plan = plan_text(q)
    assert "PushedFilters: [IsNotNull(o_orderkey), LessThan(o_orderkey,10)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_partitioned_registration_prunes(spark, base, prefix):
    path = staging.stage_partitioned(spark, SF_SMALL, base)
    reg = register_table(spark, "shop", "ORDERS", path, database_prefix=prefix, database_location=base)
    view = spark.table(reg.catalog_table)
    assert view.count() == 1500
    plan = plan_text(view.filter(F.col("o_orderstatus") == "P"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan


def test_mapped_policy_view(spark, base, prefix):
    path = staging.stage_table(spark, SF_SMALL, base, "embeddings", archive_column=True)
    reg = register_table(spark, "ml", "EMB", path, policy="mapped", database_prefix=prefix, database_location=base)
    types = dict(spark.table(reg.catalog_table).dtypes)
    assert types == {"vec_id": "string", "embedding": "string", "label": "int"}
    assert spark.table(reg.catalog_table).first().embedding.startswith("[")


def test_replace_is_atomic(spark, base, prefix, monkeypatch):
    v1 = staging.stage_table(spark, SF_SMALL, base, "orders", app="v1", columns=["o_orderkey"])
    v2 = staging.stage_table(spark, SF_SMALL, base, "orders", app="v2")
    broken = f"{base}/v3/parquet/ORDERS.parquet"
    fs.write_text(spark, f"{broken}/part-0.parquet", "this is not parquet")
    register_table(spark, "shop", "ORDERS", v1, database_prefix=prefix, database_location=base)
    with pytest.raises(Exception):
        replace_table(spark, "shop", "ORDERS", broken, database_prefix=prefix, database_location=base)
    assert spark.table(f"{prefix}shop.orders").columns == ["o_orderkey"]  # old definition still serves
    reg = replace_table(spark, "shop", "ORDERS", v2, database_prefix=prefix, database_location=base)
    assert reg.action == "replace" and reg.version == 2  # the broken folder never got as far as a version
    assert len(spark.table(reg.catalog_table).columns) == 6
    assert names_in(spark, f"{prefix}shop") == {"orders"}
    assert len(names_in(spark, f"{prefix}tablekeep_bases")) == 2  # the version just replaced stays for readers
    monkeypatch.setattr(registry, "GRACE_SECONDS", 0)
    third = replace_table(spark, "shop", "ORDERS", v1, database_prefix=prefix, database_location=base)
    assert names_in(spark, f"{prefix}tablekeep_bases") == set(third.base_tables)
    assert third.version > reg.version


def test_not_ours_is_never_replaced(spark, base, prefix):
    """A same-named object made by someone else is refused."""
    spark.sql(f"CREATE DATABASE {prefix}shop LOCATION '{base}/db'")
    spark.sql(f"CREATE VIEW {prefix}shop.orders AS SELECT 1 AS x")
    path = staging.stage_table(spark, SF_SMALL, base, "orders")
    with pytest.raises(NotManagedError):
        register_table(spark, "shop", "ORDERS", path, database_prefix=prefix)
    assert spark.table(f"{prefix}shop.orders").columns == ["x"]


def test_plan_actions_and_existence(spark, base, prefix):
    root = staging.stage_archive(spark, SF_SMALL, base)
    tables = discover_tables(spark, root)
    region = tables.filter(F.col("table_name") == "REGION").first()
    register_table(spark, region.schema_name, "REGION", region.table_path, database_prefix=prefix, database_location=base)
    existing = {(r.catalog_database, r.catalog_table) for r in existing_tables(spark, [f"{prefix}archive"]).collect()}
    assert (f"{prefix}archive", "region") in existing
    keep = {r.table_name: r.action for r in plan_registration(spark, tables, database_prefix=prefix).collect()}
    assert keep["REGION"] == "skip" and keep["NATION"] == "create"
    swap = {r.table_name: r.action for r in plan_registration(spark, tables, replace_existing=True, database_prefix=prefix).collect()}
    assert swap["REGION"] == "replace"


def test_name_collision(spark, base):
    """``Orders`` and ``ORDERS`` are one catalog name."""
    write_df(spark, [(1,)], "id int", f"{base}/r/parquet/Orders.parquet")
    write_df(spark, [(2,)], "id int", f"{base}/r/parquet/ORDERS.parquet")
    with pytest.raises(NameCollisionError, match="orders"):
        plan_registration(spark, discover_tables(spark, f"{base}/r"))


def test_register_merged_view(spark, base, prefix):
    apps = staging.stage_applications(spark, SF_SMALL, base, drop_in={"appO": "o_orderpriority"})
    reg = register_merged(spark, "merged", list(apps.values()), database_prefix=prefix, database_location=base)
    view = spark.table(reg.catalog_table)
    assert view.count() == 1500
    assert "ArchiveCreationDate" not in view.columns and view.columns[-1] == "source_application"
    pruned = view.filter(F.col("source_application") == "appO")
    assert plan_text(pruned).count("FileScan parquet") == 1
    assert pruned.filter(F.col("o_orderpriority").isNotNull()).count() == 0
    props = table_properties(spark, f"{prefix}merged", "orders")
    assert props["tablekeep.merged"] == "true"
    again = register_merged(spark, "merged", list(apps.values()), database_prefix=prefix, database_location=base)
    assert again.version == 2 and spark.table(again.catalog_table).count() == 1500
    assert names_in(spark, f"{prefix}merged") == {"orders"}
    assert names_in(spark, f"{prefix}tablekeep_bases") == {*reg.base_tables, *again.base_tables}


def test_register_merged_type_conflict(spark, base, prefix):
    apps = staging.stage_applications(spark, SF_SMALL, base, cast_in={"appO": ("o_custkey", "int")})
    with pytest.raises(ValueError, match="o_custkey"):
        register_merged(spark, "merged", list(apps.values()), database_prefix=prefix, database_location=base)
    assert not spark.catalog.databaseExists(f"{prefix}merged") or not spark.catalog.tableExists(f"{prefix}merged.orders")
    reg = register_merged(
        spark, "merged", list(apps.values()), on_conflict="text", database_prefix=prefix, database_location=base
    )
    assert dict(spark.table(reg.catalog_table).dtypes)["o_custkey"] == "string"


def test_unregister_keeps_files(spark, base, prefix):
    path = staging.stage_table(spark, SF_SMALL, base, "region")
    register_table(spark, "geo", "REGION", path, database_prefix=prefix, database_location=base)
    unregister(spark, "geo", "REGION", database_prefix=prefix)
    assert spark.sql(f"SHOW TABLES IN {prefix}geo").count() == 0
    assert spark.read.parquet(path).count() == 5


def test_existence_and_registry(spark, base, prefix):
    path = staging.stage_table(spark, SF_SMALL, base, "region", app="geo")
    assert not schema_exists(spark, "Geo Data", prefix)
    register_table(spark, "Geo Data", "Region-List", path, database_prefix=prefix, database_location=base)
    assert schema_exists(spark, "Geo Data", prefix) and table_exists(spark, "Geo Data", "Region-List", prefix)
    assert not table_exists(spark, "Geo Data", "Other", prefix)
    rows = registered_tables(spark, [f"{prefix}geo_data"]).collect()
    assert [(r.catalog_table, r.schema_name, r.table_name, r.version, r.merged) for r in rows] == [
        ("region_list", "Geo Data", "Region-List", 1, False)
    ]
    assert rows[0].sources[0].endswith("geo/parquet/REGION.parquet")


def test_tables_named_like_ours_are_left_alone(spark, base, prefix):
    """Bases are known by record, never by a name pattern."""
    path = staging.stage_table(spark, SF_SMALL, base, "region")
    register_table(spark, "geo", "REGION", path, database_prefix=prefix, database_location=base)
    spark.catalog.createTable(f"{prefix}geo.region__v2", path=path, source="parquet")
    for version in (2, 3):
        reg = register_table(spark, "geo", "REGION", path, database_prefix=prefix, database_location=base)
        assert reg.version == version and spark.table(reg.catalog_table).count() == 5
    unregister(spark, "geo", "REGION", database_prefix=prefix)
    assert names_in(spark, f"{prefix}geo") == {"region__v2"} and names_in(spark, f"{prefix}tablekeep_bases") == set()


def test_merged_view_with_case_different_spellings(spark, base, prefix):
    a = write_df(spark, [(1, "x")], "ID int, name string", f"{base}/A/parquet/T.parquet")
    b = write_df(spark, [(2, "y")], "id int, NAME string", f"{base}/B/parquet/T.parquet")
    with scoped_conf(spark, {"spark.sql.caseSensitive": "true"}):
        reg = register_merged(spark, "m", [a, b], database_prefix=prefix, database_location=base)
        rows = sorted(tuple(r) for r in spark.table(reg.catalog_table).collect())
    assert rows == [(1, "x", "A"), (2, "y", "B")]


def test_t4_no_silent_empty_table(spark, base, prefix):
    schema = T.StructType([T.StructField("id", T.IntegerType())])
    fs.mkdirs(spark, f"{base}/e/parquet/E.parquet")
    with pytest.raises(MissingDataFilesError):
        register_table(spark, "e", "E", f"{base}/e/parquet/E.parquet", schema, database_prefix=prefix)
    with pytest.raises(MissingDataFilesError):
        register_table(spark, "e", "E", f"{base}/nowhere/parquet/E.parquet", schema, database_prefix=prefix)
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA|Unable to infer"):
        register_table(spark, "e", "E", f"{base}/e/parquet/E.parquet", database_prefix=prefix)


def test_b11_identifiers_are_escaped(spark, base, prefix):
    path = f"{base}/odd/parquet/ODD.parquet"
    spark.sql("SELECT 1 AS `a b`, 2 AS `x``y`, 3 AS `dotted.name`, DATE'2024-01-01' AS ArchiveCreationDate").write.parquet(path)
    reg = register_table(spark, "o'd d", "ODD", path, policy="mapped", database_prefix=prefix, database_location=base)
    assert reg.catalog_table == f"{prefix}o_d_d.odd"
    view = spark.table(reg.catalog_table)
    assert view.columns == ["a b", "x`y", "dotted.name"]
    assert tuple(view.first()) == (1, 2, 3)
    assert table_properties(spark, f"{prefix}o_d_d", "odd")["tablekeep.schema_name"] == "o'd d"


def test_numeric_folder_names(spark, base, prefix):
    """A schema folder named like a number still becomes a usable database."""
    path = write_df(spark, [(1,), (2,)], "id int", f"{base}/2024/parquet/2025.parquet")
    reg = register_table(spark, "2024", "2025", path, database_location=base)
    assert reg.catalog_table == "2024.2025"
    assert spark.table("`2024`.`2025`").count() == 2
    report = publish_merge(spark, [path], "2024", replace_existing=True, verify_row_count=True, database_location=base)
    row = report.first()
    assert row.status == "success" and row.row_count == 2


def test_new_partition_folder_after_refresh(spark, base, prefix):
    """T5: partitions are inferred from folders at read time; no MSCK needed."""
    path = f"{base}/app/parquet/P.parquet"
    spark.range(10).selectExpr("id", "'a' AS k").write.partitionBy("k").parquet(path)
    reg = register_table(spark, "app", "P", path, database_prefix=prefix, database_location=base)
    assert spark.table(reg.quoted).count() == 10
    spark.range(5).selectExpr("id").write.parquet(f"{path}/k=b")
    spark.sql(f"REFRESH TABLE {reg.quoted}")
    assert spark.table(reg.quoted).filter("k = 'b'").count() == 5
