"""Row counts (O21): one scan, no columns read, bounded number of jobs."""

from __future__ import annotations

import uuid

from conftest import SF_SMALL, plan_text, write_df

from tablekeep import staging
from tablekeep.operators.counts import FOOTER_TABLES, footer_counts, footer_row_counts, footer_scan_conf, row_counts, row_counts_by_path, rows_per_file
from tablekeep.session import count_scan_conf, manifest_scan_conf, scoped_conf
from tablekeep.sources.layout import discover_tables, table_dirs
from tablekeep.sources.manifest import file_manifest


def test_one_scan_reads_no_columns(spark, base):
    root = staging.stage_archive(spark, SF_SMALL, base)
    df = row_counts(spark, root)
    plan = plan_text(df)
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<>" in plan


def test_counts_match_source_tables(spark, base):
    root = staging.stage_archive(spark, SF_SMALL, base)
    got = {(r.schema_name, r.table_name): r.row_count for r in row_counts(spark, root).collect()}
    for schema, table, source in staging.ARCHIVE_LAYOUT:
        want = spark.read.parquet(f"{SF_SMALL}/{source}.parquet").count()
        assert got[(schema or "archive", table)] == want


def test_zero_row_file_counts_zero(spark, base):
    write_df(spark, [], "id int", f"{base}/r/parquet/EMPTYROWS.parquet")
    write_df(spark, [(1,)], "id int", f"{base}/r/parquet/ONE.parquet")
    got = {r.table_name: r.row_count for r in row_counts(spark, f"{base}/r").collect()}
    assert got == {"EMPTYROWS": 0, "ONE": 1}


def test_counts_by_path(spark, base):
    apps = staging.stage_applications(spark, SF_SMALL, base)
    got = {r.source_path.rsplit("/", 3)[-3]: r.row_count for r in row_counts_by_path(spark, list(apps.values())).collect()}
    assert sum(got.values()) == 1500 and set(got) == {"appF", "appO", "appP"}
    per_app = spark.read.parquet(f"{SF_SMALL}/orders.parquet").groupBy("o_orderstatus").count().collect()
    assert rows_per_file(spark, list(apps.values())).count() == sum(staging.files_for(r["count"]) for r in per_app)


def _jobs(spark, fn):
    sc = spark.sparkContext
    group = f"jobs-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def _stage_many(spark, root, n_schemas, per_schema=10):
    df = spark.range(10).selectExpr("CAST(id AS INT) AS id").coalesce(1)
    for s in range(n_schemas):
        for t in range(per_schema):
            df.write.parquet(f"{root}/s{s}/parquet/T{t}.parquet")


def test_many_tables_constant_jobs(spark, base):
    """Scale check: discovery and counts run the same few jobs for 40 or 80
    tables, never one per table. Counts: two parallel listings (data scan and
    manifest) plus the aggregation/join stages AQE runs as separate jobs."""
    small, large = f"{base}/forty", f"{base}/eighty"
    _stage_many(spark, small, 4)
    _stage_many(spark, large, 8)
    jobs = {}
    for name, root in (("small", small), ("large", large)):
        jobs[name] = (
            _jobs(spark, lambda: discover_tables(spark, root).collect()),
            _jobs(spark, lambda: row_counts(spark, root).collect()),
        )
    assert jobs["small"] == jobs["large"], jobs
    assert max(jobs["large"]) <= 8, jobs
    assert sum(r.row_count for r in row_counts(spark, large).collect()) == 800


def test_no_path_parsing_below_the_per_file_aggregate(spark, base):
    """Regression guard: path decoding/splitting must run once per file, never per row.

    The only operators between the Parquet scan and the first aggregate are
    projections of ``_metadata``; a Filter there would mean a path expression
    was pushed into the per-row scan.
    """
    root = staging.stage_archive(spark, SF_SMALL, base)
    plan = plan_text(row_counts(spark, root))
    below = plan.split("FileScan parquet")[0].rsplit("HashAggregate", 1)[-1]  # nodes between scan and aggregate
    assert "Project" in below
    assert "UrlCodec" not in below and "split(" not in below and "Filter" not in below


def test_counts_by_path_for_missing_folders(spark, base):
    rows = row_counts_by_path(spark, [f"{base}/nope/parquet/T.parquet"]).collect()
    assert [r.row_count for r in rows] == [0]


def test_metadata_scans_get_large_splits(spark, base):
    """Listing-only and footer-only scans are packed about one task per core,
    not one per file (emulated: a 64 KiB session split against larger files)."""
    root = staging.stage_archive(spark, "/root/testdata/sf0.01", base)
    paths = [d.table_path for d in table_dirs(spark, root)]
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "1024"}):
        small = file_manifest(spark, paths).rdd.getNumPartitions()
        with scoped_conf(spark, manifest_scan_conf(spark)):
            big = file_manifest(spark, paths).rdd.getNumPartitions()
        scan = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(*paths)
        tasks = scan.rdd.getNumPartitions()
        with scoped_conf(spark, count_scan_conf(spark)):
            fewer = spark.read.schema("x int").option("recursiveFileLookup", "true").parquet(*paths).rdd.getNumPartitions()
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "65536"
    assert big < small and big <= 2 * spark.sparkContext.defaultParallelism  # whole files bin-packed
    assert fewer < tasks


def test_counts_from_footers(spark, base):
    """The count is pushed into the scans; nested, hidden and partitioned files as in the row scan."""
    root = staging.stage_archive(spark, SF_SMALL, base)
    dirs = table_dirs(spark, root)
    with scoped_conf(spark, footer_scan_conf(spark) | {"spark.sql.maxMetadataStringLength": "10000"}):
        plan = plan_text(footer_counts(spark, [d.table_path for d in dirs]))
    assert plan.count("PushedAggregation: [COUNT(*)]") == len(dirs)
    whole = sorted(map(tuple, row_counts(spark, root).collect()))
    assert sorted(map(tuple, footer_row_counts(spark, root).collect())) == whole and len(whole) == 8
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the session is as before


def test_counts_from_footers_of_many_tables(spark, base):
    n = FOOTER_TABLES + 3
    for i in range(n):
        write_df(spark, [(j,) for j in range(i % 5)], "id int", f"{base}/r/parquet/T{i}.parquet/k={i}")
    got = {r.table_name: r.row_count for r in footer_row_counts(spark, f"{base}/r").collect()}
    assert got == {f"T{i}": i % 5 for i in range(n)}
