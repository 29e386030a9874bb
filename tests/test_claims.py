"""Claims documents against a plain-Python reading of their definition."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from conftest import plain
from pyspark.sql import functions as F

from claimweave.operators.claims import MEASURES, claims_denials, claims_documents, claims_summary

CLAIMS = (
    "providertin bigint, IncurredServiceDate date, BusinessSegmentIdentifier string, PaidOrDeniedCode string, "
    "FinalPassIndicator string, ClaimDenialCategoryLevel1ShortName string, masteridclaimcount int, "
    "EstimatedAllowedSelectDeniedAmount decimal(12,2), UHCPaidAmount decimal(12,2), BilledAmount decimal(12,2), "
    "ActualAllowedAmount decimal(12,2)"
)
LOOKUP = "tin bigint, healthcareorganizationname string, providersyskey int, formattedtin string"
LOOKUP_ROWS = [
    (1, "North", 10, "0-01"),
    (2, "North", 10, "0-02"),
    (3, None, 11, "0-03"),
    (4, "South", None, "0-04"),
    (5, "South", 12, None),
    (2, "East", 13, "0-02"),  # a tax ID of two systems counts for both
    (1, "North", 10, "0-01"),  # and one listed twice counts twice
    (4, "South", None, "0-04"),
    (6, "West", 14, "0-06"),
]
BLOCKS = {"E&I": "EI", "C&S": "CS", "M&R": "MR"}


def claim_rows(seed, count=160):
    random.seed(seed)
    money = lambda: random.choice([None, Decimal(random.randrange(1, 100000)) / 100])
    rows = []
    for _ in range(count):
        day = random.choice([None, dt.date(2017, 12, 31), dt.date(2018, 1, 1), dt.date(2018, 1, 31), dt.date(2018, 3, 5)])
        rows.append(
            (
                random.choice([1, 2, 3, 4, 5, 9, None]),
                day,
                random.choice(["E&I", "C&S", "M&R", "Other", None]),
                random.choice(["P", "D", "X", None]),
                random.choice(["Y", "N", None]),
                random.choice(["cat a", "cat b", None]),
                random.choice([None, 1, 2, 3]),
                money(),
                money(),
                money(),
                money(),
            )
        )
    rows.append((6, dt.date(2018, 1, 1), "E&I", "P", "Y", "cat a", 1, None, Decimal("5.00"), None, None))
    return rows


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def plus(a, b):
    return None if a is None or b is None else a + b


def measures(rows):
    pick = lambda condition, i: total([(r[i] if condition(r) else 0) for r in rows])
    denied = lambda r: r[3] == "D"
    paid = lambda r: r[3] == "P" and r[4] == "Y"
    m = {
        "ClaimsDenied": pick(denied, 6),
        "AmountDenied": pick(denied, 7),
        "ClaimsPaid": pick(paid, 6),
        "AmountPaid": pick(paid, 8),
        "AmountBilled": pick(lambda r: r[4] == "Y", 9),
        "AmountActualAllowed": total([r[10] for r in rows]),
    }
    m["ClaimsSubmitted"] = m["ClaimsCompleted"] = plus(m["ClaimsPaid"], m["ClaimsDenied"])
    m["AmountSubmitted"] = m["AmountCompleted"] = plus(m["AmountDenied"], m["AmountPaid"])
    m["AmountUHCPaid"] = m["AmountPaid"]
    m["AmountExpectedAllowed"] = plus(m["AmountActualAllowed"], m["AmountDenied"])
    return tuple(m[name] for name in MEASURES)


def denials(rows):
    groups = defaultdict(list)
    for r in rows:
        if r[3] == "D":
            groups[r[5]].append(r)
    entries = [(c, total([r[6] for r in g]), total([r[7] for r in g])) for c, g in groups.items()]
    return tuple(sorted(entries, key=lambda e: (e[0] is not None, e[0] or ""))) or None


def grouped(rows, level, period):
    groups = defaultdict(list)
    for r in rows:
        for tin, system, key, formatted in LOOKUP_ROWS:
            if tin == r[0]:
                day = r[1]
                when = None if day is None else day.year if period == "year" else str(day.replace(day=1))
                groups[(system, key, *([formatted] if level == "tin" else []), when)].append(r)
    return groups


def expected_documents(rows, level, period):
    documents = []
    for key, group in grouped(rows, level, period).items():
        parts = {}
        for segment, name in [*BLOCKS.items(), (None, "ALL")]:
            members = [r for r in group if name == "ALL" or r[2] == segment]
            if members:
                parts[name] = ((measures(members),), denials(members))
        # A claim without a date has no year, but it has a (nameless) month.
        keys = key if period == "year" else key[:-1]
        if None not in keys:
            documents.append((*key, *[parts.get(n) for n in ("EI", "CS", "MR", "ALL")]))
            continue
        for name, (summary, denied) in parts.items():
            for half in [(summary, None)] + ([(None, denied)] if denied else []):
                documents.append((*key, *[half if n == name else None for n in ("EI", "CS", "MR", "ALL")]))
    return sorted(documents, key=repr)


def numbers(value):
    """Amounts compared by value: scales differ between sums of different columns."""
    if isinstance(value, tuple):
        return tuple(numbers(v) for v in value)
    return float(value) if isinstance(value, Decimal) else value


@pytest.mark.parametrize("level", ["system", "tin"])
@pytest.mark.parametrize("period", ["year", "month"])
def test_documents(spark, level, period):
    rows = claim_rows(seed=len(level) + len(period))
    claims, lookup = spark.createDataFrame(rows, CLAIMS), spark.createDataFrame(LOOKUP_ROWS, LOOKUP)
    df = claims_documents(claims, lookup, level, period)
    keys = ["ProviderSystem", "ProviderKey", *(["TIN"] if level == "tin" else []), "ReportingPeriod"]
    assert df.columns == [*keys, "EI", "CS", "MR", "ALL"]
    actual = sorted((numbers(r) for r in plain(df)), key=repr)
    assert actual == sorted((numbers(r) for r in expected_documents(rows, level, period)), key=repr)


@pytest.mark.parametrize("level, period", [("system", "year"), ("tin", "month")])
def test_summary_and_denials(spark, level, period):
    rows = claim_rows(seed=7)
    claims, lookup = spark.createDataFrame(rows, CLAIMS), spark.createDataFrame(LOOKUP_ROWS, LOOKUP)
    summary, denied = [], []
    for key, group in grouped(rows, level, period).items():
        segments = [(s, [r for r in group if r[2] == s]) for s in {r[2] for r in group}] + [("ALL", group)]
        for segment, members in segments:
            summary.append((*key, segment, *measures(members)))
            denied += [(*key, segment, *entry) for entry in denials(members) or ()]

    def ordered(rows):
        return sorted((numbers(r) for r in rows), key=repr)

    assert ordered(plain(claims_summary(claims, lookup, level, period))) == ordered(summary)
    assert ordered(plain(claims_denials(claims, lookup, level, period))) == ordered(denied)


def test_document_schema(spark):
    claims, lookup = spark.createDataFrame([], CLAIMS), spark.createDataFrame(LOOKUP_ROWS, LOOKUP)
    df = claims_documents(claims, lookup, "system", "year")
    block = df.schema["EI"].dataType
    assert [f.name for f in block["ClaimsLobSummary"].dataType.elementType] == MEASURES
    assert [f.name for f in block["DenialCategory"].dataType.elementType] == [
        "claimdenialcategorylevel1shortname",
        "DenialCount",
        "DenialAmount",
    ]
    assert df.isEmpty()


def test_unknown_level_or_period(spark):
    claims, lookup = spark.createDataFrame([], CLAIMS), spark.createDataFrame([], LOOKUP)
    with pytest.raises(ValueError):
        claims_summary(claims, lookup, "state", "year")
    with pytest.raises(ValueError):
        claims_summary(claims, lookup, "tin", "week")


def test_text_tax_ids(spark):
    claims = spark.createDataFrame(claim_rows(3), CLAIMS)
    lookup = spark.createDataFrame(LOOKUP_ROWS, LOOKUP)
    as_text = claims.withColumn("providertin", F.col("providertin").cast("string"))
    assert plain(claims_summary(as_text, lookup, "tin", "year")) == plain(claims_summary(claims, lookup, "tin", "year"))


@pytest.mark.parametrize("formatted", ["0-01", None])
@pytest.mark.parametrize("period", ["year", "month"])
def test_tax_ids_written_alike_share_a_document(spark, period, formatted):
    """Tax IDs 1, 2 and 3 of one provider: the same documents as if all their claims had one tax ID."""
    rows = claim_rows(seed=11)
    as_one = [(1 if r[0] in (1, 2, 3) else r[0], *r[1:]) for r in rows]
    entries = [(tin, "North", 10, formatted) for tin in (1, 2, 3)]
    apart, together = (
        plain(claims_documents(spark.createDataFrame(c, CLAIMS), spark.createDataFrame(e, LOOKUP), "tin", period))
        for c, e in ((rows, entries), (as_one, entries[:1]))
    )
    assert apart == together and together
