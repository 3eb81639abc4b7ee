"""Column expressions and naming/type rules (JVM-side, no UDFs)."""

from .names import catalog_name, catalog_name_col
from .types import DECLARED_TYPES, conversion, declared_type

__all__ = ["catalog_name", "catalog_name_col", "DECLARED_TYPES", "conversion", "declared_type"]
