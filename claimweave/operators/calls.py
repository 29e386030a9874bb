"""Call volumes and handle times per provider system over a trailing window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.functions.periods import as_date
from claimweave.operators.lookup import attach_providers

# Line of business -> column; question type -> column prefix.
LOB_COLUMNS = {"E&I": "EIVolume", "M&R": "MRVolume", "C&S": "CSVolume"}
QUESTION_PREFIXES = {
    "Benefits": "Benefits",
    "Claims": "Claims",
    "Others": "Others",
    "Prior Auth": "PriorAuth",
}


def in_window(calls: DataFrame, as_of: dt.date | str, days: int) -> DataFrame:
    """Calls dated from ``days`` before ``as_of`` up to ``as_of``, both included.

    ``calldate`` is ``yyyyMMdd`` text and only its first eight characters
    count. Comparing the column itself with text bounds keeps the same rows as
    rebuilding a dashed date does, and lets the scan skip row groups. The upper
    bound is the first text after every text that starts with the end date.
    """
    end = as_date(as_of)
    first = (end - dt.timedelta(days=days)).strftime("%Y%m%d")
    last = end.strftime("%Y%m%d")
    beyond = last[:-1] + chr(ord(last[-1]) + 1)
    return calls.filter((F.col("calldate") >= first) & (F.col("calldate") < beyond))


def _reporting_period(as_of: dt.date | str, days: int) -> str:
    end = as_date(as_of)
    return f"{end - dt.timedelta(days=days)}_{end}"


def _per_provider(calls, lookup, as_of, days, sums) -> DataFrame:
    # One row per tax ID before the lookup: a busy tax ID collapses map-side.
    per_tin = in_window(calls, as_of, days).groupBy("tin").agg(*[value.alias(name) for name, value in sums.items()])
    per_tin = per_tin.withColumnRenamed("tin", "_tin")
    names = {"providersyskey": "providersyskey", "healthcareorganizationname": "providerName"}
    return (
        attach_providers(per_tin, "_tin", lookup, names, sums)
        .groupBy("providersyskey", "providerName")
        .agg(*[F.sum(name).alias(name) for name in sums])
        .select(F.lit(_reporting_period(as_of, days)).alias("ReportingPeriod"), "*")
    )


def call_volume_by_lob(calls: DataFrame, lookup: DataFrame, as_of: dt.date | str, days: int = 365) -> DataFrame:
    """Call volume per provider system and line of business; null where there were no such calls."""
    sums = {
        column: F.sum(F.when(F.col("lob_id") == lob, F.col("callVolume"))) for lob, column in LOB_COLUMNS.items()
    }
    return _per_provider(calls, lookup, as_of, days, sums)


def call_metrics_by_question(
    calls: DataFrame, lookup: DataFrame, as_of: dt.date | str, days: int = 365
) -> DataFrame:
    """Call volume and handle time per provider system and question type."""
    sums = {}
    for suffix, source in (("CALLVOLUME", "callVolume"), ("CALLTIME", "handleTime")):
        for question, prefix in QUESTION_PREFIXES.items():
            sums[prefix + suffix] = F.sum(F.when(F.col("questionType") == question, F.col(source)))
    return _per_provider(calls, lookup, as_of, days, sums)
