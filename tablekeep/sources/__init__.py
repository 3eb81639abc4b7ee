"""Sources: Hadoop filesystem access, file manifests, layout discovery, scans."""

from .layout import discover_schemas, discover_tables, empty_tables, table_dirs, table_dirs_df
from .manifest import file_manifest, manifest_by_source, require_files
from .scan import partition_columns, scan_table, scan_tables

__all__ = [
    "discover_schemas",
    "discover_tables",
    "empty_tables",
    "table_dirs",
    "table_dirs_df",
    "file_manifest",
    "manifest_by_source",
    "require_files",
    "partition_columns",
    "scan_table",
    "scan_tables",
]
