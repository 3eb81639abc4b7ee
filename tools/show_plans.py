"""Print the physical plans of the headline operators (for PLANS.md).

Usage: python tools/show_plans.py [sf_dir] > plans.txt

Paths under the scratch folder are shortened to ``<scratch>`` so the output
is stable across runs.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tablekeep import staging  # noqa: E402
from tablekeep.operators.counts import row_counts  # noqa: E402
from tablekeep.operators.merge import merge_tables  # noqa: E402
from tablekeep.plans.registration import register_merged, register_table  # noqa: E402
from tablekeep.session import local_session  # noqa: E402
from tablekeep.sources.layout import discover_tables  # noqa: E402


def plan(df) -> str:
    text = df._sc._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted"
    )
    return re.sub(r"file:[^\s,\]]*/tablekeep/[^/\s,\]]+", "<scratch>", str(text))


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8, app="tablekeep-plans")
    base = staging.new_base(spark, "plans")
    root = staging.stage_archive(spark, sf_dir, base)
    apps = staging.stage_applications(spark, sf_dir, f"{base}/apps", drop_in={"appO": "o_orderpriority"})
    part = staging.stage_partitioned(spark, sf_dir, base)
    merged = register_merged(spark, "m", list(apps.values()), database_prefix="plans_", database_location=base)
    single = register_table(spark, "shop", "PARTORDERS", part, database_prefix="plans_", database_location=base)
    shown = {
        "O1 discover_tables": discover_tables(spark, root),
        "O21 row_counts": row_counts(spark, root),
        "O14 merge_tables, filtered to one application": merge_tables(spark, list(apps.values())).filter(
            F.col("source_application") == "appP"
        ),
        "O19 merged view, filter on a column one source lacks": spark.sql(
            f"SELECT o_orderkey, o_totalprice FROM {merged.catalog_table} "
            "WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000"
        ),
        "O17 registered key=value table, partition + value filter": spark.sql(
            f"SELECT o_orderkey FROM {single.catalog_table} WHERE o_orderstatus = 'F' AND o_orderkey < 100"
        ),
    }
    for title, df in shown.items():
        print(f"### {title}\n")
        print("```")
        print(plan(df).strip())
        print("```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
