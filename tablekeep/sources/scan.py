"""Table scans.

``scan_table`` reads one table folder with ``mergeSchema`` so that the columns
are the union over all data files (a file lacking a column reads it as NULL).
Flat and nested folders are read with ``recursiveFileLookup``; folders in which
all files lie below the same ``key=value`` levels are read with partition
discovery, so the partition columns appear and filters on them prune folders
(B2). Where files mix these shapes every file is read and the keys are taken
from its path, so no row is lost; a filter on a key is then a filter on
``_metadata.file_path``, by which Spark leaves out whole files before it plans
the tasks. A key has the same type in both cases (``KEY_TYPES``).

``scan_tables`` is one scan over many table folders (the merge scan): one file
listing and one footer job for all of them, and Spark packs small files of
different sources into the same tasks. Source labels and keys come from the
path's source part by a constant look-up, so neither the plan's operators nor
the work per row grows with the number of sources.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import quote, sql_string
from ..session import manifest_scan_conf, scoped_conf
from . import fs
from .manifest import DATA_FILE_GLOB, assign_sources, file_manifest, source_depths

# Fixed value: folder value that Hive and Spark write for NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Layout:
    """How a table folder names its sub-folders.

    ``keys``: (name, type) of every ``key=value`` folder level seen; ``uniform``:
    all files lie below the same keys and no other folder, so that partition
    discovery reads the folder; ``prefix``: length of the folder's encoded path.
    """

    keys: tuple[tuple[str, str], ...] = ()
    uniform: bool = True
    prefix: int = 0

    @property
    def mixed(self) -> bool:
        return bool(self.keys) and not self.uniform

    def value_sql(self, name: str, dtype: str, below: str = "") -> str:
        """The value of a key in a file's path below the table folder (SQL ``below``); NULL where the file has none."""
        below = below or f"substring(_metadata.file_path, {self.prefix + 1})"
        pattern = sql_string("/" + re.escape(name) + "=([^/]*)/")
        raw = f"replace(regexp_extract({below}, {pattern}, 1), '+', '%2B')"
        once = f"coalesce(try_url_decode({raw}), {raw})"
        text = f"nullif(coalesce(try_url_decode(replace({once}, '+', '%2B')), {once}), '{NULL_PARTITION}')"
        return f"CAST(nullif({text}, '') AS {dtype})"

    def columns_sql(self, files: T.StructType, below: str = "") -> list[tuple[str, str]]:
        """(name, expression) of the table's columns over the file columns ``files``."""
        keys = {name.lower(): (name, dtype) for name, dtype in self.keys}
        out = []
        for f in files.fields:
            if f.name.lower() in keys:
                name, _ = keys.pop(f.name.lower())
                own = self.value_sql(name, f.dataType.simpleString(), below)
                out.append((f.name, f"coalesce({quote(f.name)}, {own})"))
            else:
                out.append((f.name, quote(f.name)))
        return out + [(name, self.value_sql(name, dtype, below)) for name, dtype in keys.values()]


#: Patterns of key values, from the narrowest type on. Whole numbers beyond bigint are decimals; anything that
#: fits no pattern makes the key a string (so "1d" and "2f" stay texts), as does a key without any value.
KEY_TYPES = {
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "decimal(38,0)": r"^[+-]?[0-9]{1,38}$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$",
}


def table_layouts(spark: SparkSession, files: DataFrame) -> dict[str, Layout]:
    """The layout of every table folder among ``files``: (table_path, below), a file's path below its table folder.

    Aggregates over the listing, the same two for any number of tables: the
    driver gets one row for each distinct sequence of folder names of a table
    and one for each of its keys, never one for each file.
    """
    parts = F.split("below", "/")
    files = files.select("table_path", F.slice(parts, F.lit(1), F.size(parts) - 1).alias("folders"))
    levels = F.transform("folders", lambda d: F.when(F.contains(d, F.lit("=")), F.substring_index(d, "=", 1)).otherwise(F.lit("/")))
    seen: dict[str, list[list[str]]] = {}
    kinds: dict[str, dict[str, str]] = {}
    with scoped_conf(spark, manifest_scan_conf(spark)):
        for r in files.select("table_path", levels.alias("levels")).distinct().collect():
            seen.setdefault(r.table_path, []).append(r.levels)
        if any(n != "/" for shapes in seen.values() for one in shapes for n in one):
            folder = files.select("table_path", F.explode("folders").alias("folder")).filter("contains(folder, '=')")
            raw = F.expr("substring(folder, instr(folder, '=') + 1)")
            text = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)
            name = F.substring_index("folder", "=", 1).alias("name")
            values = folder.select("table_path", name, F.nullif(F.nullif(text, F.lit(NULL_PARTITION)), F.lit("")).alias("value"))
            value = F.col("value")
            fits = [F.bool_and(F.when(value.isNotNull(), value.rlike(p) & value.try_cast(t).isNotNull())).alias(t) for t, p in KEY_TYPES.items()]
            for r in values.groupBy("table_path", "name").agg(*fits).collect():
                kinds.setdefault(r.table_path, {})[r.name] = next((t for t in KEY_TYPES if r[t]), "string")
    out = {}
    for path, shapes in seen.items():
        names = dict.fromkeys(n for one in sorted(shapes) for n in one if n != "/")
        uniform = len(shapes) == 1 and "/" not in shapes[0] and len(set(shapes[0])) == len(shapes[0])
        out[path] = Layout(tuple((n, kinds[path][n]) for n in names), uniform, len(fs.encoded(spark, path))) if names else Layout()
    return out


def table_layout(spark: SparkSession, table_path: str) -> Layout:
    """The layout of all data files of a folder, from their listing."""
    q = fs.qualify(spark, table_path)
    files = file_manifest(spark, [q]).select(F.lit(q).alias("table_path"), F.expr(f"substring(file_path, {len(q) + 2})").alias("below"))
    return table_layouts(spark, files).get(q, Layout())


def partition_columns(spark: SparkSession, table_path: str) -> list[str]:
    """Names of the ``key=value`` folders below a table folder (B2)."""
    return [name for name, _ in table_layout(spark, table_path).keys]


def reader_options(spark: SparkSession, table_path: str, *, merge_schema: bool = True, layout: Layout | None = None) -> dict[str, str]:
    """Options that read exactly the table's data files (shared with registration)."""
    layout = table_layout(spark, table_path) if layout is None else layout
    opts = {"pathGlobFilter": DATA_FILE_GLOB}
    if merge_schema:
        opts["mergeSchema"] = "true"
    if layout.keys and layout.uniform:
        opts["basePath"] = fs.qualify(spark, table_path)
    else:
        opts["recursiveFileLookup"] = "true"
    return opts


def scan_files(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """The file columns of a table folder (and its partition columns where the layout is uniform)."""
    q = fs.qualify(spark, path)
    reader = spark.read.options(**reader_options(spark, q, layout=layout))
    df = reader.parquet(fs.glob_escape(q))
    if not layout.keys or not layout.uniform:
        return df
    kinds = {name.lower(): dtype for name, dtype in layout.keys}
    fields = [T.StructField(f.name, T._parse_datatype_string(kinds.get(f.name.lower(), f.dataType.simpleString()))) if f.name.lower() in kinds else f for f in df.schema.fields]
    typed = T.StructType(fields)
    return df if typed == df.schema else reader.schema(typed).parquet(fs.glob_escape(q))


def scan_table(spark: SparkSession, path: str, layout: Layout | None = None) -> DataFrame:
    """The table folder as a DataFrame, columns merged over all its files.

    Folders that mix flat files, plain sub-folders and ``key=value`` folders of
    any depth are read file by file; the keys come from each file's path.
    """
    layout = table_layout(spark, path) if layout is None else layout
    df = scan_files(spark, path, layout)
    if not layout.mixed:
        return df
    return df.select(*[F.expr(e).alias(name) for name, e in layout.columns_sql(df.schema)])


class SourcePart:
    """Look-up of a row's source folder by its file path, as column expressions.

    The path is cut at the depth of the sources and looked up in a constant:
    an array of small maps, addressed by the checksum of the part. So a row
    costs one checksum and a few comparisons for each distinct depth of the
    sources, whatever their number, and a filter on the result prunes files.
    """

    def __init__(self, spark: SparkSession, paths: Sequence[str]):
        self.parts = [fs.encoded(spark, p).rstrip("/") for p in paths]
        size = max(1, len(self.parts) // 2)
        cells: list[list[Column]] = [[F.lit(""), F.lit(-1)] for _ in range(size)]  # no part is empty
        for i, part in enumerate(self.parts):
            cells[zlib.crc32(part.encode()) % size] += [F.lit(part), F.lit(i)]
        table = F.array(*[F.create_map(*cell) for cell in cells])
        found = []
        for depth in sorted(source_depths(self.parts), reverse=True):
            part = F.substring_index(F.col("_metadata.file_path"), "/", depth)
            cell = F.element_at(table, (F.crc32(F.encode(part, "UTF-8")) % size + 1).cast("int"))
            found.append(F.try_element_at(cell, part))
        self.index = F.coalesce(*found)

    def pick(self, values: Sequence) -> Column:
        """The value of the row's source; ``values`` in the order of the paths."""
        return F.try_element_at(F.array(*[F.lit(v) for v in values]), self.index + 1)

    def below(self) -> Column:
        """The encoded path of the row's file below its source, with the slash."""
        return F.substring(F.col("_metadata.file_path"), self.pick([len(p) + 1 for p in self.parts]), F.lit(1 << 30))


def provenance_column(spark: SparkSession, sources: dict[str, str]) -> Column:
    """Source label of each row from ``_metadata.file_path`` (qualified path -> label)."""
    return SourcePart(spark, list(sources)).pick(list(sources.values()))


def scan_tables(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    provenance: dict[str, str] | None = None,
    provenance_col: str = "source_application",
) -> DataFrame:
    """One scan over several table folders with one merged schema.

    Schemas that cannot be merged raise ``CANNOT_MERGE_SCHEMAS`` exactly like the
    archive tool's merge mode; use ``merge_tables`` to reconcile types instead.
    ``provenance`` maps each folder to a label added as ``provenance_col``.
    Keys of ``key=value`` folders become columns of one type over all sources,
    NULL in files that lie below no such folder.
    """
    qualified = [fs.qualify(spark, p) for p in paths]
    files = assign_sources(file_manifest(spark, qualified), qualified)
    together = files.select(F.lit(qualified[0]).alias("table_path"), F.expr("substring(file_path, length(source_path) + 2)").alias("below"))
    keys = table_layouts(spark, together).get(qualified[0], Layout()).keys
    df = (
        spark.read.option("mergeSchema", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", DATA_FILE_GLOB)
        .parquet(*[fs.glob_escape(p) for p in qualified])
    )
    layout, below = Layout(keys, uniform=False), "__tablekeep_below"
    columns = {name: F.expr(e) for name, e in layout.columns_sql(df.schema, quote(below))}
    if keys:
        df = df.select("*", SourcePart(spark, qualified).below().alias(below), "_metadata")
    if provenance:
        labels = {fs.qualify(spark, k): v for k, v in provenance.items()}
        columns[provenance_col] = provenance_column(spark, labels)
    return df.select(*[c.alias(name) for name, c in columns.items()])
