"""Operators over tables: projections, merge, counts and the run report."""

from .counts import footer_row_counts, row_counts, row_counts_by_path, rows_per_file
from .merge import align_schemas, merge_group, merge_sources, merge_tables
from .project import ARCHIVE_COLUMNS, conform_types, describe_tables, drop_columns
from .report import changed_tables, load_report, published_files, read_file_list, read_report, report_totals, run_history, write_report

__all__ = [
    "footer_row_counts",
    "row_counts",
    "row_counts_by_path",
    "rows_per_file",
    "align_schemas",
    "merge_group",
    "merge_sources",
    "merge_tables",
    "ARCHIVE_COLUMNS",
    "conform_types",
    "describe_tables",
    "drop_columns",
    "changed_tables",
    "load_report",
    "published_files",
    "read_file_list",
    "read_report",
    "report_totals",
    "run_history",
    "write_report",
]
