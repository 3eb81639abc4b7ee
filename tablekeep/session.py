"""Session helpers: the shared work folder and a local session for tests/bench."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged layouts, checkpoints and reports.

    On a cluster this is the folder the cluster names in ``spark.checkpoint.dir``
    (reachable from every executor). Only when the session has none — local
    tests — is a temporary folder created and installed as the checkpoint dir.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        if configured:
            spark.sparkContext.setCheckpointDir(configured)
        elif not str(spark.sparkContext.master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tablekeep-"))
        current = spark.sparkContext.getCheckpointDir()
    return str(current).rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared work folder."""
    return f"{work_dir(spark)}/tablekeep/{label}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", app: str = "tablekeep", **conf) -> SparkSession:
    """Local session used by tests and ``bench.py`` (UI off, UTC, AQE on)."""
    warehouse = tempfile.mkdtemp(prefix="tablekeep-wh-")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


_conf_lock = threading.Lock()
_conf_held: dict[tuple[int, str], tuple[str | None, list[str]]] = {}  # (session, key) -> (value before, values in force)


@contextmanager
def scoped_conf(spark: SparkSession, conf: dict[str, str]):
    """Set session confs for the actions run inside the block, then restore them.

    Blocks may overlap in threads that share the session: the value from before
    the first of them comes back when the last one ends, in whatever order they end.
    """
    with _conf_lock:
        for k, v in conf.items():
            _conf_held.setdefault((id(spark), k), (spark.conf.get(k, None), []))[1].append(v)
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _conf_lock:
            for k, v in conf.items():
                before, values = _conf_held[id(spark), k]
                values.remove(v)
                if not values:
                    del _conf_held[id(spark), k]
                now = values[-1] if values else before
                if now is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, now)


# A count-only scan reads footers, not column bytes: 1 GiB splits cut the task
# count 8x against the 128 MiB default without adding memory per task.
COUNT_SCAN_SPLIT_BYTES = 1 << 30


# A manifest scan (binaryFile with the content pruned) opens no file at all, but
# Spark still packs files into tasks by byte size: 128 MiB would mean one task
# per data file. With a 64 GiB cap Spark's own bytes-per-core limit decides,
# i.e. about one task per core.
MANIFEST_SCAN_SPLIT_BYTES = 64 << 30


def _split_conf(spark: SparkSession, floor: int) -> dict[str, str]:
    try:
        current = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    except Exception:  # noqa: BLE001 - no JVM session (Spark Connect): keep the session's value
        return {}
    return {"spark.sql.files.maxPartitionBytes": str(max(current, floor))}


def count_scan_conf(spark: SparkSession) -> dict[str, str]:
    """Split size for a count-only scan: at least 1 GiB, never below the session's."""
    return _split_conf(spark, COUNT_SCAN_SPLIT_BYTES)


def manifest_scan_conf(spark: SparkSession) -> dict[str, str]:
    """Split size for a listing-only (manifest) scan: at least 64 GiB."""
    return _split_conf(spark, MANIFEST_SCAN_SPLIT_BYTES)
