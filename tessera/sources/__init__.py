"""Sources and sinks: readers, SQL entry points, declared schemas, refresh writer."""

from .io import csv_header, query, read_raw_csv, read_table, table_scan
from .schema import CONSTRAINTS, LOAD_ORDER, SCHEMAS, conform
from .sink import read_tables, refresh_tables, write_bucketed

__all__ = [
    "csv_header", "query", "read_raw_csv", "read_table", "table_scan",
    "CONSTRAINTS", "LOAD_ORDER", "SCHEMAS", "conform", "read_tables", "refresh_tables", "write_bucketed",
]
