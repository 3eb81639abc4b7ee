"""Registration plans (create / replace / skip) and the publish jobs."""

from .publish import publish_application, publish_merge
from .registration import (
    existing_tables,
    plan_registration,
    register_merged,
    registered_tables,
    schema_exists,
    table_exists,
    register_table,
    replace_table,
    table_properties,
    unregister,
)
from .registry import published_versions, recover

__all__ = [
    "publish_application",
    "publish_merge",
    "existing_tables",
    "plan_registration",
    "published_versions",
    "recover",
    "register_merged",
    "registered_tables",
    "schema_exists",
    "table_exists",
    "register_table",
    "replace_table",
    "table_properties",
    "unregister",
]
