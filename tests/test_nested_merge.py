"""Merging sources whose nested types differ; application names; types in the report."""

from __future__ import annotations

import pytest

from tablekeep import publish_merge
from tablekeep.functions.types import check_policy
from tablekeep.operators.merge import MergeConflictError, application_names, merge_tables
from tablekeep.session import scratch

ONE = "id long, s struct<a: int, n: struct<x: int>>, l array<struct<a: int>>, m map<string, struct<a: int>>"
TWO = "id long, s struct<A: int, b: string, n: struct<x: int, y: string>>, l array<struct<a: int, b: string>>, m map<string, struct<b: string, a: int>>"


@pytest.fixture(scope="module")
def sources(spark):
    root = scratch(spark, "nested")
    one = [(1, (1, (2,)), [(1,), None], {"k": (1,)}), (2, None, None, None), (3, (None, None), [], {})]
    two = [(4, (4, "b", (5, "y")), [(1, "z")], {"k": ("b", 7), "n": None})]
    paths = [f"{root}/{app}/parquet/T.parquet" for app in ("app1", "app2")]
    for path, rows, kind in zip(paths, (one, two), (ONE, TWO)):
        spark.createDataFrame(rows, kind).write.parquet(path)
    return paths


WANT = [
    (1, {"a": 1, "n": {"x": 2, "y": None}, "b": None}, [{"a": 1, "b": None}, None], {"k": {"a": 1, "b": None}}, "app1"),
    (2, None, None, None, "app1"),
    (3, {"a": None, "n": None, "b": None}, [], {}, "app1"),
    (4, {"a": 4, "n": {"x": 5, "y": "y"}, "b": "b"}, [{"a": 1, "b": "z"}], {"k": {"a": 7, "b": "b"}, "n": None}, "app2"),
]


def plain(df):
    return sorted((tuple(r.asDict(recursive=True).values()) for r in df.collect()), key=lambda r: r[0])


def test_merge_of_nested_types(spark, sources):
    assert plain(merge_tables(spark, sources)) == WANT
    assert plain(merge_tables(spark, sources[::-1])) != [] and merge_tables(spark, sources[::-1]).count() == 4


def test_published_merge_of_nested_types(spark, sources):
    report = publish_merge(spark, sources, "nested_merge_t", verify_row_count=True).first()
    assert (report.status, report.row_count, report.error_message) == ("success", 4, None)
    assert plain(spark.table("nested_merge_t.t")) == WANT
    assert report.columns[0] == "id TEXT" and report.exposed_columns[0] == "id bigint"


def test_leaves_that_differ_still_conflict(spark, tmp_path):
    paths = [f"{tmp_path}/{app}/parquet/T.parquet" for app in ("a", "b")]
    for path, kind in zip(paths, ("struct<a: int>", "struct<a: string>")):
        spark.createDataFrame([], f"s {kind}").write.parquet(path)
    with pytest.raises(MergeConflictError):
        merge_tables(spark, paths, check_files=False)


def test_application_names_are_distinct():
    two = ["/x/app/parquet/T.parquet", "/y/app/parquet/T.parquet"]
    assert application_names(two) == ["x/app", "y/app"]
    assert application_names([two[0], "/x/other/parquet/T.parquet"]) == ["app", "other"]
    assert application_names([two[0]]) == ["app"]


def test_unknown_declared_type_is_refused():
    with pytest.raises(ValueError, match="VARCHARX"):
        check_policy("mapped", {"LongType": "VARCHARX"})
    check_policy("mapped", {"LongType": "bigint"})
