"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch

#: Bytes of one part that ``spooled`` brings to the driver at a time.
SPOOL_BYTES = 1 << 25


def share_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once a session; for sessions that were started
    without it on their path (``--py-files`` does the same)."""
    sc = spark.sparkContext
    if getattr(sc, "_tablekeep_shared", False):
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="tablekeep-py-")) / "tablekeep_package.zip"  # read by the driver's file server only
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._tablekeep_shared = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Just the wanted columns, as ``new=old`` names.

    Columns are taken by position, so extra columns (also ones that clash with
    the operator's own names, or differ only by case) never get in the way.
    """
    columns = list(df.columns)
    flat = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return flat.select(*[F.col(f"c{columns.index(old)}").alias(new) for new, old in wanted.items()])


def packed(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with neutral column names ``c0, c1, ...``, and the names to put back with ``toDF``."""
    names = list(df.columns)
    return df.toDF(*[f"c{i}" for i in range(len(names))]), names


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: it is computed once, and
    lost executors cannot take it away."""
    path = scratch(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spooled(spark: SparkSession, df: DataFrame, label: str) -> pd.DataFrame:
    """All rows of ``df`` (doc_id, y, ..., x binary), ordered; each ``x`` is an array of bytes.

    The rows come to the driver in parts of about ``SPOOL_BYTES`` and ``x`` goes to a file there that
    is mapped into memory, so that neither the driver's memory nor ``spark.driver.maxResultSize``
    bounds their total.
    """
    saved = written(spark, df, label)
    total = saved.agg(F.sum(F.octet_length("x").cast("long"))).first()[0] or 0
    rows, at = [], 0
    with tempfile.TemporaryFile() as file:
        for row in saved.repartition(max(8, -(-total // SPOOL_BYTES))).toLocalIterator():
            *others, x = row
            file.write(x)
            rows.append((*others, at, at + len(x), zlib.crc32(x)))
            at += len(x)
        file.flush()
        raw = np.memmap(file, np.uint8, "r") if at else np.zeros(0, np.uint8)
    got = pd.DataFrame(rows, columns=[*saved.columns[:-1], "start", "stop", "crc"]).sort_values(["doc_id", "y", "crc"], kind="stable")
    got["x"] = [raw[a:b] for a, b in zip(got["start"], got["stop"])]
    return got.drop(columns=["start", "stop", "crc"])


def fold(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(-1))


def batches_of(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, stop) row ranges holding at most ``max_bytes`` of text each (one row at least)."""
    _, offsets = text_bytes(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array and the row offsets into them (nulls are empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]
