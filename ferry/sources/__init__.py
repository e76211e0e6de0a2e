from ferry.sources.binary import read_files
from ferry.sources.csv import QUOTED_DIALECT, header_of, read_csv, union_by_header
from ferry.sources.headers import header_catalog, header_drift
from ferry.sources.registry import register_views, run_registered
from ferry.sources.sqltext import check_view_name, read_sql_text, run_sql, sql_path, statement_text

__all__ = [
    "QUOTED_DIALECT", "check_view_name", "header_catalog", "header_drift",
    "header_of", "read_csv", "read_files", "read_sql_text", "register_views", "run_registered",
    "run_sql", "sql_path", "statement_text", "union_by_header",
]
