"""Reading tables and files."""

from claimweave.sources.readers import (
    from_csv_lines,
    read_csv,
    read_files,
    read_json,
    read_parquet,
    read_table,
    run_sql,
)

__all__ = ["from_csv_lines", "read_csv", "read_files", "read_json", "read_parquet", "read_table", "run_sql"]
