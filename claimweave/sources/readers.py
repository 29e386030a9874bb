"""Readers. All of them return lazy DataFrames; none infers types from CSV data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


def read_files(
    spark: SparkSession, path: str, file_format: str, schema: StructType | str | None = None, **options: str
) -> DataFrame:
    """Files of any format Spark or an installed connector knows."""
    if not path:
        raise ValueError("path is empty")
    reader = spark.read.format(file_format).options(**options)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return read_files(spark, path, "parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options: str) -> DataFrame:
    """CSV with a header: typed by ``schema`` (bad fields become null), else all strings."""
    return read_files(spark, path, "csv", schema, **{"header": "true", **options})


def from_csv_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What read_csv reads without a schema from a file of these lines (column ``value``): all strings, blanks kept."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv("value", schema).alias("row")).select("row.*")


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON lines. Without a schema Spark reads the data once more to infer it."""
    return read_files(spark, path, "json", schema)


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run a query text; ``{name}`` in it stands for the DataFrame passed under that name."""
    return spark.sql(query, **frames)
