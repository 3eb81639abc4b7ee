"""Benchmark the publisher's headline operations; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG_DIR (optional: write Spark's event log there, for stage and
task times; each timed step is a Spark job group named after the step).

Staging (untimed) writes every driver table into one application root — each
table split into part files in proportion to its rows — plus ``orders`` split
into three applications for the merge. The timed pipeline runs three times
with fresh catalog names: a cold round (JIT, codegen and file-status caches
warming up), then two warm rounds; the faster warm round is reported whole
(steps are never mixed across rounds). Steps:

  discover          O1   one listing of all table folders + per-table aggregate
  describe          O8   merged schema of every table (footer jobs, driver pool)
  row_counts        O21  one scan over every table, no column read
  merge_scan        O14  full read of the merged applications (all columns)
  scan_tables       O5   the same rows through one multi-path scan
  publish_app       O25  discover + plan + register + verified counts + report
  republish_skip    O25  second run: every table skipped (metadata only)
  publish_merge     O26  merged registration + verified count
  merged_view_sql        aggregate over the registered merged view
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tablekeep import staging  # noqa: E402
from tablekeep.operators.counts import row_counts  # noqa: E402
from tablekeep.operators.merge import merge_tables  # noqa: E402
from tablekeep.operators.project import describe_tables  # noqa: E402
from tablekeep.plans.publish import publish_application, publish_merge  # noqa: E402
from tablekeep.session import local_session  # noqa: E402
from tablekeep.sources.layout import discover_tables  # noqa: E402
from tablekeep.sources.scan import scan_tables  # noqa: E402

ROWS_PER_FILE = 25_000


def stage(spark, sf_dir: str, base: str) -> tuple[str, dict[str, str], dict]:
    root, stats = staging.stage_all_tables(spark, sf_dir, base, name="archive", rows_per_file=ROWS_PER_FILE)
    apps = staging.stage_applications(spark, sf_dir, f"{base}/apps", n_files=4)
    return root, apps, stats


ROUND = {"name": "cold"}


def timed(results: dict, name: str, fn):
    from pyspark import SparkContext

    sc = SparkContext.getOrCreate()
    sc.setJobGroup(f"bench-{ROUND['name']}-{name}", name)
    t0 = time.perf_counter()
    try:
        out = fn()
    finally:
        results[name] = round(time.perf_counter() - t0, 3)
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    log_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir} if log_dir else {}
    spark = local_session(cpus, app="tablekeep-bench", **extra)
    base = staging.new_base(spark, "bench")
    t0 = time.perf_counter()
    root, apps, stats = stage(spark, sf_dir, base)
    stage_sec = round(time.perf_counter() - t0, 3)
    paths = list(apps.values())
    cold, cold_ok = pipeline(spark, base, root, apps, paths, stats)
    warm = []
    for name in ("warm1", "warm2"):
        ROUND["name"] = name
        warm.append(pipeline(spark, base, root, apps, paths, stats))
    q, ok = min(warm, key=lambda run: sum(run[0].values()))
    ok = ok and all(run_ok for _, run_ok in warm)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "publish_pipeline_total",
                "value": round(sum(q.values()), 3),
                "unit": "sec",
                "queries": q,
                "sf": float(sf.group(1)) if sf else sf_dir,
                "cores": int(cpus) if cpus.isdigit() else cpus,
                "tables": stats["tables"] + len(apps),
                "files": stats["files"] + 4 * len(apps),
                "rows": stats["rows"],
                "stage_sec": stage_sec,
                "cold_total_sec": round(sum(cold.values()), 3),
                "warm_totals_sec": [round(sum(run.values()), 3) for run, _ in warm],
                "checks_ok": ok and cold_ok,
            }
        )
    )


def pipeline(spark, base, root, apps, paths, stats):
    prefix = f"b{uuid.uuid4().hex[:8]}_"
    kw = dict(database_prefix=prefix, database_location=f"{base}/catalog")
    q: dict[str, float] = {}

    discovered = timed(q, "discover", lambda: discover_tables(spark, root).collect())
    timed(q, "describe", lambda: describe_tables(spark, discover_tables(spark, root)).collect())
    counts = timed(q, "row_counts", lambda: row_counts(spark, root).collect())
    timed(q, "merge_scan", lambda: merge_tables(spark, paths).write.format("noop").mode("overwrite").save())
    timed(
        q,
        "scan_tables",
        lambda: scan_tables(spark, paths, provenance={p: a for a, p in apps.items()})
        .write.format("noop")
        .mode("overwrite")
        .save(),
    )
    report = timed(q, "publish_app", lambda: publish_application(spark, root, verify_row_count=True, **kw).collect())
    timed(q, "republish_skip", lambda: publish_application(spark, root, **kw).collect())
    merged = timed(
        q, "publish_merge", lambda: publish_merge(spark, paths, "merged", verify_row_count=True, **kw).first()
    )
    timed(
        q,
        "merged_view_sql",
        lambda: spark.table(f"{prefix}merged.orders")
        .groupBy("source_application")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"), F.max("o_orderdate").alias("last"))
        .collect(),
    )

    ok = (
        len(discovered) == stats["tables"]
        and sum(r.row_count for r in counts) == stats["rows"]
        and all(r.status == "success" for r in report)
        and merged.status == "success"
    )
    return q, ok


if __name__ == "__main__":
    main()
