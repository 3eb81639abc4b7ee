"""Column expressions over file paths (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (the archive layout): schema folders hold a "parquet" folder whose
# "<TABLE>.parquet" folders are the tables.
PARQUET_DIR = "parquet"
SUFFIX = ".parquet"


def relative_to(col: Column, root: str) -> Column:
    """Path below ``root`` (both decoded, qualified); NULL for paths outside it."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(col, F.lit(prefix)), col.substr(len(prefix) + 1, 1 << 30))


def segments(rel: Column) -> Column:
    return F.split(rel, "/")


def layout_keys(rel: Column) -> dict[str, Column]:
    """Schema folder / table folder of a data file, from its path below the root.

    Root schema:  ``parquet/<T>.parquet/**/<file>``          -> ("", <T>.parquet)
    Child schema: ``<S>/parquet/<T>.parquet/**/<file>``      -> (<S>, <T>.parquet)
    Files directly under ``parquet/`` belong to no table.
    """
    segs = segments(rel)
    at_root = F.get(segs, 0) == F.lit(PARQUET_DIR)
    valid = F.when(
        at_root,
        (F.size(segs) >= 3) & F.endswith(F.get(segs, 1), F.lit(SUFFIX)),
    ).otherwise(
        (F.size(segs) >= 4)
        & (F.get(segs, 1) == F.lit(PARQUET_DIR))
        & F.endswith(F.get(segs, 2), F.lit(SUFFIX))
    )
    return {
        "schema_dir": F.when(at_root, F.lit("")).otherwise(F.get(segs, 0)),
        "table_dir": F.when(at_root, F.get(segs, 1)).otherwise(F.get(segs, 2)),
        "in_table": valid,
    }
