"""Self-service adoption and cost metrics per provider system."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.functions.periods import as_date, month_index
from claimweave.operators.lookup import attach_providers

# Fixed values of the metric definitions.
CALL_TYPES = ["APL", "ATH", "BEN", "CLM", "ELI", "MIS", "Others"]
CALL_COLUMNS = {"authcallcnt": "ATH", "eligcallcnt": "ELI", "bencallcnt": "BEN", "clmcallcnt": "CLM"}
CONTACT_CALL_TYPES = ["BEN", "CLM", "ELI"]
SELF_SERVICE_CHANNELS = [
    "link_cm_searches",
    "link_ebc_searches",
    "EDI276",
    "EDI270",
    "elink_searches",
    "clink_searches",
]
CALL_MONTHS_BACK = [2, 3, 4]
# prefix of (average time, claim count), transaction, channel
PROCESSING = [
    ("avgpclm", "ORIGINAL", "Paper"),
    ("avgeclm", "ORIGINAL", "Electronic"),
    ("avgprec", "ADJUSTMENT", "Paper"),
    ("avgerec", "ADJUSTMENT", "Electronic"),
]
# phone minus portal: minutes per call, dollars per call
MINUTES_SAVED = Decimal("6.50") - Decimal("0.94")
DOLLARS_SAVED = {
    "authcallcnt": Decimal("7.5") - Decimal("1.89"),
    "eligcallcnt": Decimal("4.02") - Decimal("0.42"),
    "bencallcnt": Decimal("4.02") - Decimal("0.42"),
    "clmcallcnt": Decimal("5.4") - Decimal("1.81"),
}
CALL_TIME_DIVISOR = 60 * 90
# weighted column -> the count it weighs
WEIGHTED = {
    "PnPelecwt": "PnPelec",
    "PnPpaperwt": "PnPpaper",
    "SizeOfOppcncwt": "cnccall",
    "SizeOfOpppnpwt": "cncpaper",
    "SelfServeCnCwt": "SelfServeCnC",
}
CONTACT_WEIGHT = 3.59
PAPER_WEIGHT = 0.5

_COUNTS = ["callcnt", *CALL_COLUMNS]
_AVERAGES = [prefix + "prctm" for prefix, _, _ in PROCESSING]
_CLAIM_COUNTS = [prefix + "cnt" for prefix, _, _ in PROCESSING]


def _fact_sums(current: int) -> dict[str, Column]:
    """Every sum the metrics need; all of them can be re-summed after the lookup."""
    txn, channel, count, zero = F.col("txn"), F.col("channel"), F.col("txn_cnt"), F.lit(0)
    calls = channel == "calls"
    recent_calls = calls & F.col("monthyear").isin([current - back for back in CALL_MONTHS_BACK])
    processed = (F.col("table") == "clm_proc") & (F.col("data_coverage") == "3-month")

    def total(rows: Column, value: Column) -> Column:
        return F.sum(F.when(rows, value).otherwise(zero))

    sums = {}
    for prefix, kind, via in PROCESSING:
        rows = processed & (txn == kind) & (channel == via)
        sums[f"_{prefix}_time"] = total(rows, F.col("avg_proc_time"))
        sums[f"_{prefix}_rows"] = F.count_if(rows)
        sums[prefix + "cnt"] = total(rows, F.col("clm_count"))
    counted = {column: recent_calls & (txn == kind) for column, kind in CALL_COLUMNS.items()}
    counted["callcnt"] = recent_calls & txn.isin(CALL_TYPES)
    counted["PnPelec"] = channel == "PnP_elec"
    counted["PnPpaper"] = channel == "PnP_paper"
    counted["cnccall"] = calls & txn.isin(CONTACT_CALL_TYPES)
    counted["cncpaper"] = (channel == "Payer") & txn.endswith("Paper")
    counted["SelfServeCnC"] = channel.isin(SELF_SERVICE_CHANNELS) | txn.endswith("EDI")
    return sums | {column: total(rows, count) for column, rows in counted.items()}


def _call_time() -> Column:
    return (F.lit(MINUTES_SAVED) * F.col("callcnt")).cast("double") / F.lit(float(CALL_TIME_DIVISOR))


def _call_cost() -> Column:
    cost = [F.lit(rate) * F.col(column) for column, rate in DOLLARS_SAVED.items()]
    return (cost[0] + cost[1] + cost[2] + cost[3]).cast("double")


def _monthly(facts: DataFrame, lookup: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Metrics per provider system and month, weighted columns still times six."""
    day = as_date(as_of)
    current = day.year * 12 + day.month
    sums = _fact_sums(current)
    # One row per tax ID and month before the lookup.
    per_tin = (
        facts.withColumn("monthyear", month_index("year", "month"))
        .groupBy("tax_id", "monthyear")
        .agg(*[value.alias(name) for name, value in sums.items()])
    )
    provider = ["providersyskey", "healthcareorganizationname"]
    grouped = (
        attach_providers(per_tin, "tax_id", lookup, {c: c for c in provider}, sums)
        .groupBy(*provider, "monthyear")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
    averaged = grouped.withColumns(
        {
            prefix + "prctm": F.try_divide(
                F.col(f"_{prefix}_time").cast("double"), F.col(f"_{prefix}_rows").cast("double")
            )
            for prefix, _, _ in PROCESSING
        }
    )
    # 3/6, 2/6, 1/6 for two to four months back; older months weigh 0 and less.
    weight = F.lit(5 - current) + F.col("monthyear")
    weighted = averaged.withColumns({name: weight * F.col(count) for name, count in WEIGHTED.items()})
    return weighted.withColumns(
        {
            "clmprctmdiff": F.abs(F.col("avgpclmprctm") - F.col("avgeclmprctm")),
            "reconprctmdiff": F.abs(F.col("avgprecprctm") - F.col("avgerecprctm")),
            "pnpadptrt": _share("PnPelecwt", "PnPelecwt", "PnPpaperwt"),
            "lnkadptrt": _share("SelfServeCnCwt", "SelfServeCnCwt", "SizeOfOppcncwt", "SizeOfOpppnpwt"),
        }
    )


def _share(part: str, *whole: str) -> Column:
    total = F.col(whole[0])
    for column in whole[1:]:
        total = total + F.col(column)
    return F.try_divide(F.col(part).cast("double"), total.cast("double"))


def _sixths(column: str) -> Column:
    # Whole-number weights are summed first and divided once, so no error builds up.
    return (F.col(column).cast("double") / F.lit(6.0)).alias(column)


def self_service_monthly(facts: DataFrame, lookup: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Metrics per provider system and month index."""
    return _monthly(facts, lookup, as_of).select(
        "providersyskey",
        "healthcareorganizationname",
        "monthyear",
        *_AVERAGES,
        *_CLAIM_COUNTS,
        "clmprctmdiff",
        "reconprctmdiff",
        *_COUNTS,
        "PnPelec",
        "PnPpaper",
        "cnccall",
        "cncpaper",
        "SelfServeCnC",
        _call_time().alias("calltm"),
        _call_cost().alias("callcost"),
        *[_sixths(c) for c in WEIGHTED],
        "pnpadptrt",
        "lnkadptrt",
    )


def _reporting_period(as_of: dt.date | str) -> str:
    day = as_date(as_of)
    current = day.year * 12 + day.month - 1

    def start(back: int) -> str:
        return "{:04d}{:02d}01".format((current - back) // 12, (current - back) % 12 + 1)

    return f"{start(4)}-{start(2)}"


def self_service_metrics(facts: DataFrame, lookup: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Metrics per provider system over all months, with the overall adoption rate.

    The monthly portal rates (``pnpadptrt``) are summed and the monthly link
    rates (``lnkadptrt``) averaged; that is how the metrics are defined.
    """
    summed = [
        *_AVERAGES,
        *_CLAIM_COUNTS,
        "clmprctmdiff",
        "reconprctmdiff",
        *_COUNTS,
        *WEIGHTED,
        "pnpadptrt",
    ]
    totals = (
        _monthly(facts, lookup, as_of)
        .groupBy("providersyskey", "healthcareorganizationname")
        .agg(*[F.sum(c).alias(c) for c in summed], F.avg("lnkadptrt").alias("lnkadptrt"))
    )
    result = totals.withColumns({"calltm": _call_time(), "callcost": _call_cost()}).withColumns(
        {c: _sixths(c) for c in WEIGHTED}
    )
    contact = F.col("SizeOfOppcncwt") * CONTACT_WEIGHT
    paper = F.col("PnPpaperwt") * PAPER_WEIGHT
    overall = F.try_divide(F.col("lnkadptrt") * contact, contact + paper) + F.try_divide(
        F.col("pnpadptrt") * paper, contact + paper
    )
    return result.select(
        F.col("providersyskey").alias("ProviderSysKey"),
        F.col("healthcareorganizationname").alias("ProviderSystem"),
        F.lit(_reporting_period(as_of)).alias("ReportingPeriod"),
        "avgpclmprctm",
        "avgpclmcnt",
        "avgeclmprctm",
        "avgeclmcnt",
        "clmprctmdiff",
        "avgprecprctm",
        "avgpreccnt",
        "avgerecprctm",
        "avgereccnt",
        "reconprctmdiff",
        "callcnt",
        "calltm",
        "authcallcnt",
        "eligcallcnt",
        "bencallcnt",
        "clmcallcnt",
        "callcost",
        "PnPelecwt",
        "PnPpaperwt",
        "pnpadptrt",
        "SizeOfOppcncwt",
        "SizeOfOpppnpwt",
        "SelfServeCnCwt",
        "lnkadptrt",
        overall.alias("overalladprt"),
    )
