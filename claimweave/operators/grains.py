"""Aggregating at two grains in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_totals(df: DataFrame, keys: Sequence[str], within: str, sums: Sequence[Column]) -> DataFrame:
    """Aggregates per ``keys`` and ``within``, and per ``keys`` alone, as grouping sets.

    ``is_total`` is 1 on the rows per ``keys`` alone. It comes from the grouping
    itself: a null in ``within`` may just as well be a null of the data.
    """
    return df.groupingSets([[*keys, within], list(keys)], *keys, within).agg(
        F.grouping(within).alias("is_total"), *sums
    )
