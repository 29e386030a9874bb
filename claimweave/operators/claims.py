"""Claims summaries and documents per provider system or tax ID, by month or year.

The fact table is reduced to one row per tax ID, period, segment and (where
asked for) denial category before anything else happens to it. Everything after that -- provider
lookup, totals over segments, documents -- works on the reduced rows, so the
claims are scanned and shuffled once, and a tax ID or a provider system with a
large share of all claims is already collapsed on the map side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.periods import month_start
from claimweave.operators.grains import with_totals
from claimweave.operators.lookup import attach_providers

# Business segment -> document block.
BLOCKS = {"E&I": "EI", "C&S": "CS", "M&R": "MR"}
ALL = "ALL"

# Sums kept per reduced row; every published measure follows from them.
_SUMS = ["ClaimsPaid", "ClaimsDenied", "AmountDenied", "AmountPaid", "AmountBilled", "AmountActualAllowed"]

MEASURES = [
    "ClaimsPaid",
    "ClaimsDenied",
    "AmountDenied",
    "AmountPaid",
    "ClaimsSubmitted",
    "AmountSubmitted",
    "ClaimsCompleted",
    "AmountCompleted",
    "AmountUHCPaid",
    "AmountBilled",
    "AmountActualAllowed",
    "AmountExpectedAllowed",
]

_LEVELS = {
    "system": ["ProviderSystem", "ProviderKey"],
    "tin": ["ProviderSystem", "ProviderKey", "TIN"],
}


def _keys(level: str) -> list[str]:
    if level not in _LEVELS:
        raise ValueError(f"level must be one of {sorted(_LEVELS)}, not {level!r}")
    return [*_LEVELS[level], "ReportingPeriod"]


def _period(period: str) -> Column:
    if period == "year":
        return F.year("IncurredServiceDate")
    if period == "month":
        return month_start("IncurredServiceDate")
    raise ValueError(f"period must be 'month' or 'year', not {period!r}")


def _period_text(period: str) -> Column:
    column = F.col("ReportingPeriod")
    return column if period == "year" else F.date_format(column, "yyyy-MM-dd")


def _is_denied() -> Column:
    return F.coalesce(F.col("PaidOrDeniedCode") == "D", F.lit(False))


def reduce_claims(claims: DataFrame, period: str, detail: bool = True) -> DataFrame:
    """One row per tax ID, period and segment; with ``detail`` also per denied or not, and denial category."""
    denied = _is_denied()
    final = F.col("FinalPassIndicator") == "Y"
    paid = (F.col("PaidOrDeniedCode") == "P") & final

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(F.lit(0)))

    grain = [
        F.col("providertin"),
        _period(period).alias("ReportingPeriod"),
        F.col("BusinessSegmentIdentifier").alias("Segment"),
    ]
    if detail:
        grain += [denied.alias("Denied"), F.when(denied, F.col("ClaimDenialCategoryLevel1ShortName")).alias("Category")]
    return claims.groupBy(*grain).agg(
        total(paid, "masteridclaimcount").alias("ClaimsPaid"),
        total(denied, "masteridclaimcount").alias("ClaimsDenied"),
        total(denied, "EstimatedAllowedSelectDeniedAmount").alias("AmountDenied"),
        total(paid, "UHCPaidAmount").alias("AmountPaid"),
        total(final, "BilledAmount").alias("AmountBilled"),
        F.sum("ActualAllowedAmount").alias("AmountActualAllowed"),
    )


def _with_providers(claims: DataFrame, lookup: DataFrame, level: str, period: str, detail: bool = True) -> DataFrame:
    names = {"healthcareorganizationname": "ProviderSystem", "providersyskey": "ProviderKey"}
    if level == "tin":
        names["formattedtin"] = "TIN"
    return attach_providers(reduce_claims(claims, period, detail), "providertin", lookup, names, _SUMS)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


def _measures() -> list[Column]:
    claims = F.col("ClaimsPaid") + F.col("ClaimsDenied")
    amount = F.col("AmountDenied") + F.col("AmountPaid")
    derived = {
        "ClaimsSubmitted": claims,
        "ClaimsCompleted": claims,
        "AmountSubmitted": amount,
        "AmountCompleted": amount,
        "AmountUHCPaid": F.col("AmountPaid"),
        "AmountExpectedAllowed": F.col("AmountActualAllowed") + F.col("AmountDenied"),
    }
    return [derived.get(name, F.col(name)).alias(name) for name in MEASURES]


def _segment_or_all() -> Column:
    return F.when(F.col("is_total") == 1, F.lit(ALL)).otherwise(F.col("Segment")).alias("Segment")


def claims_summary(claims: DataFrame, lookup: DataFrame, level: str, period: str) -> DataFrame:
    """The twelve measures per provider, period and segment, plus segment ``ALL``."""
    keys = _keys(level)
    rows = _with_providers(claims, lookup, level, period, detail=False)
    totals = with_totals(rows, keys, "Segment", _sums())
    return totals.withColumn("ReportingPeriod", _period_text(period)).select(*keys, _segment_or_all(), *_measures())


def claims_denials(claims: DataFrame, lookup: DataFrame, level: str, period: str) -> DataFrame:
    """Denied claims per provider, period, segment (or ``ALL``) and denial category."""
    keys = _keys(level)
    rows = _with_providers(claims.filter(F.col("PaidOrDeniedCode") == "D"), lookup, level, period)
    totals = with_totals(
        rows,
        [*keys, "Category"],
        "Segment",
        [F.sum("ClaimsDenied").alias("DenialCount"), F.sum("AmountDenied").alias("DenialAmount")],
    )
    return totals.withColumn("ReportingPeriod", _period_text(period)).select(
        *keys,
        _segment_or_all(),
        F.col("Category").alias("claimdenialcategorylevel1shortname"),
        "DenialCount",
        "DenialAmount",
    )


def _document_parts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The sums a document is made of: per block one summary, and one row per denial category.

    Every reduced row is copied only to the parts it counts in: the summary of
    ``ALL``, that of its own block if its segment has one, and the same two
    denial categories if it is denied. Grouping sets would copy each one four times.
    """
    own = F.lit(None).cast("string")
    for segment, name in BLOCKS.items():
        own = F.when(F.col("Segment") == segment, F.lit(name)).otherwise(own)

    def part(block: Column, is_summary: int) -> Column:
        category = F.lit(None).cast(rows.schema["Category"].dataType) if is_summary else F.col("Category")
        return F.struct(block.alias("Block"), F.lit(is_summary).alias("is_summary"), category.alias("Category"))

    parts = [part(block, is_summary) for is_summary in (1, 0) for block in (F.lit(ALL), own)]
    opened = rows.withColumn("_part", F.explode(F.array(*parts))).filter(
        F.col("_part.Block").isNotNull() & ((F.col("_part.is_summary") == 1) | F.col("Denied"))
    )
    return opened.groupBy(*keys, "_part.Block", "_part.is_summary", "_part.Category").agg(*_sums())


def claims_documents(claims: DataFrame, lookup: DataFrame, level: str = "tin", period: str = "month") -> DataFrame:
    """One nested document per provider and period with blocks EI, CS, MR and ALL.

    A block is null when the provider has no claims in that segment; inside it
    ``DenialCategory`` is null when nothing was denied. Segments other than the
    three count in ALL only. A claim without a date has no year, which is a null
    key; by month it falls into one nameless period, which is not.
    """
    keys = _keys(level)
    rows = _with_providers(claims, lookup, level, period)
    if level == "tin":
        # A document has about as many parts as reduced rows, so nothing is gained by summing them before the shuffle.
        # Dealt by document, its rows are summed, and its parts put together, where they lie.
        rows = rows.repartition(*keys)
    parts = _document_parts(rows, keys)
    # Documents are full outer joins of the summary and denial halves of the
    # blocks, and null keys find no partner there: each half stays a document of
    # its own. For complete keys the tag is empty and the halves come together.
    unmatched = reduce(Column.__or__, [F.col(k).isNull() for k in (keys if period == "year" else keys[:-1])])
    half = F.concat_ws(" ", "Block", F.col("is_summary").cast("string"))
    is_summary = F.col("is_summary") == 1
    summary = F.struct(*_measures())
    denial = F.struct(
        F.col("Category").alias("claimdenialcategorylevel1shortname"),
        F.col("ClaimsDenied").alias("DenialCount"),
        F.col("AmountDenied").alias("DenialAmount"),
    )
    names = [*BLOCKS.values(), ALL]
    collected = []
    for name in names:
        here = F.col("Block") == name
        collected.append(F.first(F.when(here & is_summary, summary), ignorenulls=True).alias(f"_s{name}"))
        # One entry per denial category, already summed.
        collected.append(F.collect_list(F.when(here & ~is_summary, denial)).alias(f"_d{name}"))
    documents = parts.groupBy(*keys, F.when(unmatched, half).otherwise(F.lit("")).alias("_apart")).agg(*collected)
    return documents.withColumn("ReportingPeriod", _period_text(period)).select(*keys, *[_block(n) for n in names])


def _block(name: str) -> Column:
    summary, denials = F.col(f"_s{name}"), F.col(f"_d{name}")
    body = F.struct(
        F.when(summary.isNotNull(), F.array(summary)).alias("ClaimsLobSummary"),
        F.when(F.size(denials) > 0, F.sort_array(denials)).alias("DenialCategory"),
    )
    return F.when(summary.isNotNull() | (F.size(denials) > 0), body).alias(name)
