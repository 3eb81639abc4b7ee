"""Column type policy.

Two policies:

* ``native`` (default): Spark types are exposed unchanged.
* ``mapped``: every Spark type *class* is looked up in a declared-type table;
  classes in the table keep their Spark type, every other class becomes text
  (``CAST(col AS STRING)``; ``to_json`` for arrays, maps and structs).

The table is user-editable: pass ``mapping={class_name: declared_name}``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values (must match the archive tool's shipped configuration):
# Spark type class name -> declared SQL type; any other class is declared TEXT.
DECLARED_TYPES: dict[str, str] = {
    "BinaryType": "BYTEA",
    "StringType": "TEXT",
    "DoubleType": "DOUBLE PRECISION",
    "DateType": "DATE",
    "TimestampType": "TIMESTAMP",
    "IntegerType": "INTEGER",
    "FloatType": "REAL",
    "ShortType": "SMALLINT",
}
DEFAULT_DECLARED = "TEXT"

# Spark type a declared name is exposed as under the ``mapped`` policy.
DECLARED_TO_SPARK: dict[str, T.DataType] = {
    "BYTEA": T.BinaryType(),
    "TEXT": T.StringType(),
    "DOUBLE PRECISION": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "INTEGER": T.IntegerType(),
    "REAL": T.FloatType(),
    "SMALLINT": T.ShortType(),
    "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(),
}

POLICIES = ("native", "mapped")
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def declared_type(dtype: T.DataType, mapping: dict[str, str] | None = None) -> str:
    table = DECLARED_TYPES if mapping is None else mapping
    return table.get(type(dtype).__name__, DEFAULT_DECLARED)


def check_policy(policy: str, mapping: dict[str, str] | None = None) -> None:
    """Refuses an unknown policy, and a mapping that declares a type no column can be exposed as."""
    if policy not in POLICIES:
        raise ValueError(f"unknown type policy {policy!r}; expected one of {POLICIES}")
    unknown = sorted({v for v in (mapping or {}).values() if v.upper() not in DECLARED_TO_SPARK})
    if unknown:
        raise ValueError(f"unknown declared type(s) {', '.join(unknown)}; known: {', '.join(DECLARED_TO_SPARK)}")


def conversion(dtype: T.DataType, policy: str, mapping: dict[str, str] | None = None):
    """How a column of ``dtype`` is exposed: ("keep"|"cast"|"json", target type)."""
    check_policy(policy)
    if policy == "native":
        return "keep", dtype
    target = DECLARED_TO_SPARK.get(declared_type(dtype, mapping).upper(), T.StringType())
    if target == dtype:
        return "keep", dtype
    if isinstance(target, T.StringType) and isinstance(dtype, _NESTED):
        return "json", target
    return "cast", target


def sql_type(dtype: T.DataType) -> str:
    """DDL text of a type, with nested field names quoted."""
    ddl = T.StructType([T.StructField("x", dtype)]).toDDL()
    return ddl.split(" ", 1)[1]


def quote(name: str) -> str:
    """Back-tick quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """Single-quoted Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def same_type(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def reshape_sql(expr: str, own: T.DataType, wanted: T.DataType, depth: int = 0) -> str:
    """``expr`` of type ``own`` as ``wanted``: struct fields by name (NULL where ``own`` has none), at any depth."""
    if same_type(own, wanted):
        return expr
    if isinstance(own, T.StructType) and isinstance(wanted, T.StructType):
        has = {f.name.lower(): f for f in own.fields}
        parts = []
        for f in wanted.fields:
            mine = has.get(f.name.lower())
            value = f"CAST(NULL AS {sql_type(f.dataType)})"
            if mine is not None:
                value = reshape_sql(f"{expr}.{quote(mine.name)}", mine.dataType, f.dataType, depth)
            parts.append(f"{sql_string(f.name)}, {value}")
        return f"IF({expr} IS NULL, NULL, named_struct({', '.join(parts)}))"
    if isinstance(own, T.ArrayType) and isinstance(wanted, T.ArrayType):
        inner = reshape_sql(f"e{depth}", own.elementType, wanted.elementType, depth + 1)
        return f"transform({expr}, e{depth} -> {inner})"
    if isinstance(own, T.MapType) and isinstance(wanted, T.MapType):
        inner = reshape_sql(f"v{depth}", own.valueType, wanted.valueType, depth + 1)
        return f"transform_values({expr}, (k{depth}, v{depth}) -> {inner})"
    return f"CAST({expr} AS {sql_type(wanted)})"


def exposed_column(name: str, dtype: T.DataType, policy: str, mapping=None) -> Column:
    kind, target = conversion(dtype, policy, mapping)
    col = F.col(quote(name))
    if kind == "json":
        col = F.to_json(col)
    elif kind == "cast":
        col = col.cast(target)
    return col.alias(name)


def exposed_sql(name: str, dtype: T.DataType, policy: str, mapping=None) -> str:
    kind, target = conversion(dtype, policy, mapping)
    q = quote(name)
    if kind == "json":
        return f"to_json({q}) AS {q}"
    if kind == "cast":
        return f"CAST({q} AS {sql_type(target)}) AS {q}"
    return q
