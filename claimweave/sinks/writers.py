"""Writers. Each keeps the partitioning of its input; none squeezes it into one file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def overwrite_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks around values are part of them and stay."""
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(header="true", **kept).csv(path)


def to_csv_lines(df: DataFrame) -> DataFrame:
    """The lines that overwrite_csv writes, as the text column ``value``, without writing them."""
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return df.select(F.to_csv(F.struct(*df.columns), kept).alias("value"))


def overwrite_partitioned(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Parquet with one folder per value combination of ``columns`` (none: plain Parquet).

    Rows are rebalanced by the columns, so a value's rows meet in few tasks and
    files; adaptive execution splits a value that is too big for one task.
    """
    if columns:
        df = df.hint("rebalance", *columns)
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def save(df: DataFrame, path: str, file_format: str | None = None, mode: str = "errorifexists") -> None:
    """Write in ``file_format`` or the session's default format; by default fail if the path exists."""
    writer = df.write.mode(mode)
    if file_format:
        writer = writer.format(file_format)
    writer.save(path)


def publish_documents(df: DataFrame, file_format: str = "json", **options: str) -> None:
    """Replace a document collection through a Spark data source.

    With a document-store connector on the classpath pass its format and
    options; offline the ``json`` format with a ``path`` does the same to a folder.
    """
    df.write.format(file_format).mode("overwrite").options(**options).save()
