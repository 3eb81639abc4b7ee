"""Command line: both modes end to end on a small staged layout."""

from __future__ import annotations

import json

from conftest import SF_SMALL

from tablekeep import staging
from tablekeep.__main__ import main
from tablekeep.sources import fs


def test_cli_publish_and_merge(spark, base, prefix, capsys, tmp_path):
    apps = staging.stage_applications(spark, SF_SMALL, base)
    code = main(["publish", base, "--verify-row-count", "--database-prefix", prefix,
                 "--database-location", base, "--report-dir", f"{base}/reports"])
    out = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert code == 0 and sorted(r["schema_name"] for r in out) == ["appF", "appO", "appP"]
    assert sum(r["row_count"] for r in out) == 1500
    assert len(fs.children(spark, f"{base}/reports")) == 1

    type_map = tmp_path / "types.json"
    type_map.write_text(json.dumps({"LongType": "BIGINT", "StringType": "TEXT"}))
    code = main(["merge", *apps.values(), "--target-schema", "merged", "--policy", "mapped",
                 "--type-map", str(type_map), "--database-prefix", prefix, "--database-location", base])
    row = json.loads(capsys.readouterr().out.splitlines()[0])
    assert code == 0 and row["status"] == "success" and row["merge"] is True
    types = dict(spark.table(f"{prefix}merged.orders").dtypes)
    assert types["o_orderkey"] == "bigint" and types["o_totalprice"] == "string"


def test_cli_document_report_and_failure_exit_code(spark, base, prefix, capsys):
    root = f"{base}/r"
    spark.range(3).write.parquet(f"{root}/parquet/OK.parquet")
    fs.mkdirs(spark, f"{root}/parquet/EMPTY.parquet")
    code = main(["publish", root, "--database-prefix", prefix, "--database-location", base,
                 "--report-dir", f"{base}/docs", "--report-format", "document"])
    capsys.readouterr()
    assert code == 1  # a failed table makes the run exit non-zero (B17)
    doc = json.loads(fs.read_text(spark, fs.children(spark, f"{base}/docs")[0].path))
    assert doc["schemas"]["r"]["tables"]["OK"]["status"] == "success"
    assert doc["schemas"]["r"]["tables"]["EMPTY"]["status"] == "error"
