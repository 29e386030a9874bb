"""Provider lookup from a full file, and the list of provider keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.periods import as_date
from claimweave.functions.tins import format_tin

LOOKUP_COLUMNS = [
    "tin",
    "mpin",
    "tinname",
    "healthcareorganizationname",
    "providersyskey",
    "health_system_id",
    "formattedtin",
    "pcorname",
    "claimsthrudate",
    "refresh_date",
]


def timestamp_text(now: dt.datetime | str) -> str:
    """``yyyy-MM-dd HH:mm:ss``, the form in which the lookup keeps refresh times."""
    return now if isinstance(now, str) else now.strftime("%Y-%m-%d %H:%M:%S")


def load_provider_history(rows: DataFrame, now: dt.datetime | str, tin_mode: str = "reference") -> DataFrame:
    """Lookup table from the full provider file: names trimmed, tax ID formatted, time set."""
    return rows.withColumns(
        {
            "tinname": F.trim("tinname"),
            "healthcareorganizationname": F.trim("healthcareorganizationname"),
            "formattedtin": format_tin("tin", tin_mode),
            "refresh_date": F.lit(timestamp_text(now)),
        }
    ).select(*LOOKUP_COLUMNS)


def provider_key_list(lookup: DataFrame, create_date: dt.date | str, as_of: dt.date | str) -> DataFrame:
    """Distinct provider keys and names, all active."""
    return (
        lookup.select("providersyskey", "healthcareorganizationname")
        .distinct()
        .select(
            "*",
            F.lit("ACTIVE").alias("status"),
            F.lit(str(as_date(create_date))).alias("create_date"),
            F.lit(str(as_date(as_of))).alias("refresh_date"),
        )
    )


def refresh_key_list(existing_keys: DataFrame, new_rows: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Key list after a load: known keys active, keys of new providers new, ordered by key.

    ``existing_keys`` comes from a file of texts; keys are compared and ordered
    as numbers.
    """
    today = F.lit(str(as_date(as_of)))
    key = F.col("providersyskey").cast("int").alias("providersyskey")
    known = existing_keys.select(
        key,
        "healthcareorganizationname",
        F.lit("ACTIVE").alias("status"),
        F.col("create_date").cast("string").alias("create_date"),
        today.alias("refresh_date"),
    )
    new = (
        new_rows.select(key, "healthcareorganizationname")
        .distinct()
        .select("*", F.lit("NEW").alias("status"), today.alias("create_date"), today.alias("refresh_date"))
    )
    return known.unionByName(new).distinct().orderBy("providersyskey", "healthcareorganizationname", "status")
