"""Provider and user directories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def provider_tins(lookup: DataFrame) -> DataFrame:
    """Distinct tax IDs with their names per provider system, one row each."""
    return lookup.select(
        F.col("providersyskey").alias("ProviderKey"),
        F.col("healthcareorganizationname").alias("ProviderSystem"),
        F.col("formattedtin").alias("TIN"),
        F.col("tinname").alias("TINNAME"),
    ).distinct()


def provider_tin_list(lookup: DataFrame, parts: int = 1) -> DataFrame:
    """Documents per provider system; ``ALL`` lists tax IDs in order.

    A document is one row, held by one task and limited in size by document
    stores. Where providers may have more tax IDs than that, the caller asks for
    several ``parts``: every provider then has up to that many documents, told
    apart by ``Part`` (from 0), which together list each tax ID once.
    """
    if parts < 1:
        raise ValueError("parts must be at least 1")
    part = F.pmod(F.xxhash64("TIN", "TINNAME"), F.lit(parts)).cast("int").alias("Part")
    return (
        provider_tins(lookup)
        .groupBy("ProviderKey", "ProviderSystem", part)
        .agg(F.sort_array(F.collect_list(F.struct("TIN", "TINNAME"))).alias("ALL"))
    )


def user_provider_association(users: DataFrame) -> DataFrame:
    """Users with their role wrapped in a one-element list, as the documents have it."""
    return users.withColumn("roles", F.array("roles"))
