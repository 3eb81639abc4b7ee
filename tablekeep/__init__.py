"""tablekeep: publish folders of archived Parquet data as Spark catalog tables.

Discovery, schema merging, counting and reporting are DataFrame operations;
published tables are ordinary catalog views queried with Spark SQL.
"""

__version__ = "0.1.0"

from .operators import (
    ARCHIVE_COLUMNS,
    conform_types,
    describe_tables,
    drop_columns,
    footer_row_counts,
    changed_tables,
    load_report,
    published_files,
    read_file_list,
    merge_group,
    merge_tables,
    read_report,
    report_totals,
    row_counts,
    row_counts_by_path,
    run_history,
    write_report,
)
from .plans import (
    existing_tables,
    plan_registration,
    publish_application,
    publish_merge,
    published_versions,
    recover,
    register_merged,
    register_table,
    registered_tables,
    replace_table,
    schema_exists,
    table_exists,
    unregister,
)
from .sources import discover_tables, empty_tables, file_manifest, scan_table, scan_tables

__all__ = [
    "ARCHIVE_COLUMNS",
    "conform_types",
    "describe_tables",
    "drop_columns",
    "footer_row_counts",
    "changed_tables",
    "load_report",
    "published_files",
    "read_file_list",
    "merge_group",
    "merge_tables",
    "read_report",
    "report_totals",
    "row_counts",
    "row_counts_by_path",
    "run_history",
    "write_report",
    "existing_tables",
    "plan_registration",
    "publish_application",
    "publish_merge",
    "register_merged",
    "register_table",
    "replace_table",
    "published_versions",
    "recover",
    "registered_tables",
    "schema_exists",
    "table_exists",
    "unregister",
    "discover_tables",
    "empty_tables",
    "file_manifest",
    "scan_table",
    "scan_tables",
]
