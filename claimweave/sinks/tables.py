"""Catalog tables over existing files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def register_external_table(
    spark: SparkSession, name: str, path: str, schema: StructType, partition_columns: Sequence[str] = ()
) -> None:
    """Declare ``name`` over the Parquet files below ``path`` and pick up their partitions."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    partitioned = f"PARTITIONED BY ({', '.join(_quoted(c) for c in partition_columns)})" if partition_columns else ""
    spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet {partitioned} LOCATION '{location}'")
    if partition_columns:
        spark.catalog.recoverPartitions(name)
