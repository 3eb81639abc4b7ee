"""Hadoop FileSystem access through the Spark session.

Everything here goes through the JVM's Hadoop ``FileSystem`` so that the same
code works for local folders, HDFS and object stores. Only directory-level
metadata is touched on the driver (globbing the table folders of an archive);
listing the data files below them is left to Spark's parallel file index.

These helpers need the Py4J gateway; under Spark Connect there is none and they
raise ``RuntimeError`` (trap T9 in the survey).
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_GLOB_CHARS = "\\*?[]{}"


def _jvm(spark: SparkSession):
    jvm = getattr(spark, "_jvm", None) or getattr(spark.sparkContext, "_jvm", None)
    if jvm is None:  # pragma: no cover - Spark Connect
        raise RuntimeError("Hadoop FileSystem access needs a classic (non-Connect) Spark session")
    return jvm


def _hpath(spark: SparkSession, path: str):
    return _jvm(spark).org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, hpath):
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def glob_escape(path: str) -> str:
    """Escape Hadoop glob characters so a literal folder name is not expanded."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified, *decoded* path (``file:/a b``), the form ``binaryFile`` reports."""
    hp = _hpath(spark, path)
    return str(_fs(spark, hp).makeQualified(hp).toString()).rstrip("/") or "/"


def encoded(spark: SparkSession, qualified_path: str) -> str:
    """URL-encoded form of a qualified path, the form of ``_metadata.file_path``."""
    return str(_hpath(spark, qualified_path).toUri().toString())


def exists(spark: SparkSession, path: str) -> bool:
    hp = _hpath(spark, path)
    return bool(_fs(spark, hp).exists(hp))


def is_dir(spark: SparkSession, path: str) -> bool:
    hp = _hpath(spark, path)
    fs = _fs(spark, hp)
    return bool(fs.exists(hp) and fs.getFileStatus(hp).isDirectory())


@dataclass(frozen=True)
class Entry:
    path: str  # qualified, decoded
    name: str
    is_dir: bool


def glob_dirs(spark: SparkSession, pattern: str) -> list[Entry]:
    """Directories matching a Hadoop glob pattern (driver-side metadata call)."""
    hp = _hpath(spark, pattern)
    statuses = _fs(spark, hp).globStatus(hp)
    if statuses is None:
        return []
    out = []
    for st in statuses:
        if st.isDirectory():
            p = st.getPath()
            out.append(Entry(str(p.toString()), str(p.getName()), True))
    return out


def children(spark: SparkSession, path: str) -> list[Entry]:
    """Immediate children of a directory."""
    hp = _hpath(spark, path)
    fs = _fs(spark, hp)
    if not fs.exists(hp):
        return []
    return [
        Entry(str(st.getPath().toString()), str(st.getPath().getName()), bool(st.isDirectory()))
        for st in fs.listStatus(hp)
    ]


def mkdirs(spark: SparkSession, path: str) -> None:
    hp = _hpath(spark, path)
    _fs(spark, hp).mkdirs(hp)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file (a report document, or a stray file in a staged fixture)."""
    hp = _hpath(spark, path)
    out = _fs(spark, hp).create(hp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


_create_guard = threading.Lock()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file only if there is none of that name; whether this call made it."""
    hp = _hpath(spark, path)
    fs = _fs(spark, hp)
    with _create_guard:  # a local file system checks and creates in two steps
        try:
            out = fs.create(hp, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
    return True


def age_seconds(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written; None where there is none."""
    hp = _hpath(spark, path)
    fs = _fs(spark, hp)
    if not fs.exists(hp):
        return None
    return time.time() - fs.getFileStatus(hp).getModificationTime() / 1000.0


def delete_file(spark: SparkSession, path: str) -> None:
    hp = _hpath(spark, path)
    _fs(spark, hp).delete(hp, False)


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small text file (reports, fixtures)."""
    hp = _hpath(spark, path)
    stream = _fs(spark, hp).open(hp)
    try:
        jvm = _jvm(spark)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def first_data_file(spark: SparkSession, path: str, suffix: str = ".parquet") -> str | None:
    """The first data file below ``path`` under the manifest's rules, or None.

    A recursive Hadoop iterator that stops at the first match: a few metadata
    calls to prove a folder is not empty, instead of listing every file. Same
    predicate as the manifest: name ends with ``suffix`` and no name below
    ``path`` starts with ``.`` or ``_``.
    """
    hp = _hpath(spark, path)
    fs = _fs(spark, hp)
    if not fs.exists(hp):
        return None
    base = str(fs.makeQualified(hp).toString()).rstrip("/")
    it = fs.listFiles(hp, True)
    while it.hasNext():
        status = it.next()
        full = str(status.getPath().toString())
        rel = full[len(base) + 1 :] if full.startswith(base + "/") else status.getPath().getName()
        parts = rel.split("/")
        if parts[-1].endswith(suffix) and not any(p.startswith((".", "_")) for p in parts):
            return full
    return None
