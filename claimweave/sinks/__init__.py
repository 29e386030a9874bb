"""Writing files, tables and snapshots."""

from claimweave.sinks.snapshots import publish_snapshot, read_snapshot
from claimweave.sinks.tables import register_external_table
from claimweave.sinks.writers import (
    append_parquet,
    overwrite_csv,
    overwrite_json,
    overwrite_parquet,
    overwrite_partitioned,
    publish_documents,
    save,
    to_csv_lines,
)

__all__ = [
    "append_parquet",
    "overwrite_csv",
    "overwrite_json",
    "overwrite_parquet",
    "overwrite_partitioned",
    "publish_documents",
    "publish_snapshot",
    "read_snapshot",
    "register_external_table",
    "save",
    "to_csv_lines",
]
