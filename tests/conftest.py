from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablekeep import staging  # noqa: E402
from tablekeep.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, app="tablekeep-tests")


@pytest.fixture()
def base(spark, request):
    """A fresh staging folder per test (never reused, never cleared)."""
    return staging.new_base(spark, request.node.name.replace("[", "_").replace("]", "")[:40])


@pytest.fixture()
def prefix(base):
    """Unique database prefix so tests never see each other's catalog objects."""
    return "t" + base.rsplit("-", 1)[-1] + "_"


def plan_text(df) -> str:
    """Physical plan as text (initial plan under AQE)."""
    return df._jdf.queryExecution().executedPlan().toString()


def write_df(spark, rows, schema, path, n_files=1):
    spark.createDataFrame(rows, schema).repartition(n_files).write.mode("overwrite").parquet(path)
    return path
