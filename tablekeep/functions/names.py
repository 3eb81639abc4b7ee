"""Catalog naming rules (trap T1).

The session catalog lower-cases database and table names and accepts only
``[A-Za-z0-9_]``. Folder names allow more, so names are normalised and the
original spelling is kept in the view's properties.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_BAD = re.compile(r"[^A-Za-z0-9_]")
_BAD_SQL = "[^A-Za-z0-9_]"


def catalog_name(name: str) -> str:
    return _BAD.sub("_", name).lower() or "_"


def catalog_name_col(col: Column) -> Column:
    """The same rule as :func:`catalog_name`, as a column expression."""
    norm = F.lower(F.regexp_replace(col, _BAD_SQL, "_"))
    return F.when(norm == F.lit(""), F.lit("_")).otherwise(norm)


def database_name(schema_name: str, prefix: str = "") -> str:
    """Catalog database of a schema folder, optionally namespaced by ``prefix``."""
    return (catalog_name(prefix) if prefix else "") + catalog_name(schema_name)
