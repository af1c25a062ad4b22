"""Scans: delimited files, report grids, logs, listings and lakehouse tables."""

from millrace.sources.delimited import scan_delimited, scan_header_shift, scan_skip_bad_rows, scan_skip_rows
from millrace.sources.grid import fixed_grid, ragged_grid
from millrace.sources.listing import list_files, unseen_files
from millrace.sources.tables import read_table, register_view
from millrace.sources.textlog import scan_log

__all__ = [
    "fixed_grid",
    "list_files",
    "ragged_grid",
    "read_table",
    "register_view",
    "scan_delimited",
    "scan_header_shift",
    "scan_log",
    "scan_skip_bad_rows",
    "scan_skip_rows",
    "unseen_files",
]
