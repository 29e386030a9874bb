import datetime as dt
from decimal import Decimal

import pytest
from conftest import plain

from claimweave.operators.calls import call_metrics_by_question, call_volume_by_lob, in_window
from claimweave.operators.directory import provider_tin_list, provider_tins, user_provider_association
from claimweave.operators.providers import load_provider_history, provider_key_list, refresh_key_list
from claimweave.operators.quality import RENAMED, pcor_extract
from claimweave.operators.selfservice import self_service_metrics, self_service_monthly
from claimweave.sources import schemas

LOOKUP = "tin bigint, healthcareorganizationname string, providersyskey int, health_system_id string"
LOOKUP_ROWS = [(1, "North", 10, "H1"), (2, "North", 10, "H1"), (3, "South", 11, "H2"), (3, "Third", 12, None)]


def lookup(spark):
    return spark.createDataFrame(LOOKUP_ROWS, LOOKUP)


def test_call_window_equals_dashed_dates(spark):
    dates = ["20230119", "20230120", "20231231", "20240120", "20240121", "20240120x", "202401", "2024", "", None]
    dates += ["20230120 10:00", "2024-01-20", "20240129", "2024012", "99999999", "abc", "202301200"]
    df = spark.createDataFrame([(d,) for d in dates], "calldate string")

    def kept(d):
        return d is not None and "2023-01-20" <= f"{d[:4]}-{d[4:6]}-{d[6:8]}" <= "2024-01-20"

    assert plain(in_window(df, "2024-01-20", 365)) == sorted(((d,) for d in dates if kept(d)), key=repr)


def test_call_window_with_nine_at_the_end(spark):
    df = spark.createDataFrame([("20240119",), ("201",), ("20240119z",), ("2024011:",), ("20240120",)], "calldate string")
    assert plain(in_window(df, dt.date(2024, 1, 19), 1)) == [("20240119",), ("20240119z",)]


CALLS = "tin bigint, lob_id string, questionType string, callVolume int, handleTime decimal(10,2), calldate string"


def test_calls(spark):
    day = "20240110"
    rows = [
        (1, "E&I", "Claims", 2, Decimal("1.50"), day),
        (2, "E&I", "Prior Auth", 3, Decimal("2.50"), day),
        (2, "M&R", "Claims", None, None, day),
        (3, "else", "else", 4, Decimal("9.00"), day),
        (9, "E&I", "Claims", 100, Decimal("9.00"), day),
        (1, "E&I", "Claims", 100, Decimal("9.00"), "20200101"),
    ]
    calls = spark.createDataFrame(rows, CALLS)
    period = "2023-01-20_2024-01-20"
    assert plain(call_volume_by_lob(calls, lookup(spark), "2024-01-20")) == [
        (period, 10, "North", 5, None, None),
        (period, 11, "South", None, None, None),
        (period, 12, "Third", None, None, None),
    ]
    twice = lookup(spark).unionAll(lookup(spark))
    assert call_volume_by_lob(calls, twice, "2024-01-20").filter("providersyskey = 10").first().EIVolume == 10
    north = call_metrics_by_question(calls, lookup(spark), "2024-01-20").filter("providersyskey = 10").first()
    assert (north.ClaimsCALLVOLUME, north.ClaimsCALLTIME) == (2, Decimal("1.50"))
    assert (north.PriorAuthCALLVOLUME, north.PriorAuthCALLTIME) == (3, Decimal("2.50"))
    assert north.BenefitsCALLVOLUME is None and north.OthersCALLTIME is None


SELF_SERVICE = (
    "tax_id bigint, year int, month int, table string, data_coverage string, txn string, channel string, "
    "avg_proc_time double, clm_count int, txn_cnt int"
)


def test_self_service(spark):
    rows = [
        (1, 2024, 1, "clm_proc", "3-month", "ORIGINAL", "Paper", 10.0, 4, 0),
        (2, 2024, 1, "clm_proc", "3-month", "ORIGINAL", "Paper", 20.0, 6, 0),
        (2, 2024, 1, "clm_proc", "3-month", "ORIGINAL", "Electronic", 4.0, 1, 0),
        (1, 2024, 1, "txn", None, "ATH", "calls", None, None, 10),
        (1, 2023, 12, "txn", None, "BEN", "calls", None, None, 6),
        (1, 2023, 8, "txn", None, "BEN", "calls", None, None, 6),  # too old to count as a call, weighs -2/6
        (1, 2024, 1, "txn", None, "x", "PnP_elec", None, None, 3),
        (1, 2024, 1, "txn", None, "x", "PnP_paper", None, None, 9),
        (1, 2024, 1, "txn", None, "SomeEDI", "x", None, None, 5),
        (1, 2024, 1, "txn", None, "ClmPaper", "Payer", None, None, 7),
        (3, 2023, 10, "txn", None, "x", "PnP_elec", None, None, 3),  # weight 0: nothing to divide by
    ]
    facts = spark.createDataFrame(rows, SELF_SERVICE)
    monthly = {
        (r.providersyskey, r.monthyear): r for r in self_service_monthly(facts, lookup(spark), "2024-03-15").collect()
    }
    january = monthly[(10, 2024 * 12 + 1)]
    assert (january.avgpclmprctm, january.avgpclmcnt, january.avgeclmprctm) == (15.0, 10, 4.0)
    assert january.clmprctmdiff == 11.0 and january.avgprecprctm is None and january.reconprctmdiff is None
    assert (january.authcallcnt, january.callcnt, january.SelfServeCnC, january.cncpaper) == (10, 10, 5, 7)
    assert january.PnPelecwt == 1.5 and january.PnPpaperwt == 4.5 and january.pnpadptrt == 0.25
    assert january.callcost == pytest.approx(56.1) and january.calltm == pytest.approx(5.56 * 10 / 5400)
    august = monthly[(10, 2023 * 12 + 8)]
    assert august.bencallcnt == 0 and august.cnccall == 6 and august.SizeOfOppcncwt == -2.0
    final = {r.ProviderSysKey: r for r in self_service_metrics(facts, lookup(spark), dt.date(2024, 3, 15)).collect()}
    twice = self_service_monthly(facts, lookup(spark).unionAll(lookup(spark)), "2024-03-15")
    doubled = twice.filter("providersyskey = 10 and monthyear = 2024 * 12 + 1").first()
    assert (doubled.avgpclmprctm, doubled.avgpclmcnt, doubled.callcnt) == (15.0, 20, 20)
    assert final[10].ReportingPeriod == "20231101-20240101"
    assert final[10].bencallcnt == 6 and final[10].SizeOfOppcncwt == pytest.approx(2.0 - 2.0)
    assert final[11].pnpadptrt is None and final[11].lnkadptrt is None and final[11].overalladprt is None


def test_pcor(spark):
    row = ("2018-06", "H1", "Health one", 1, 2, 3, 4, 5, 4.5, 1, 2, 3, 4, 5)
    other = ("2018-06", "H9", "Nobody", 1, 2, 3, 4, 5, 4.5, 1, 2, 3, 4, 5)
    no_system = ("2018-06", None, "None", 1, 2, 3, 4, 5, 4.5, 1, 2, 3, 4, 5)
    df = spark.createDataFrame([row, row, other, no_system], schemas.PCOR)
    result = pcor_extract(df, lookup(spark))
    assert result.columns == list(RENAMED.values())
    assert plain(result) == [("2018-06", 10, *row[3:])]


def test_directory(spark):
    rows = [(10, "North", "0-02", "b"), (10, "North", "0-01", "a"), (10, "North", "0-01", "a"), (11, "South", None, None)]
    df = spark.createDataFrame(
        rows, "providersyskey int, healthcareorganizationname string, formattedtin string, tinname string"
    )
    assert provider_tins(df).count() == 3
    assert plain(provider_tin_list(df)) == [
        (10, "North", 0, (("0-01", "a"), ("0-02", "b"))),
        (11, "South", 0, ((None, None),)),
    ]
    split = provider_tin_list(df, parts=4).collect()
    assert all(0 <= r.Part < 4 for r in split)
    assert {r.ProviderKey for r in split} == {10, 11}
    assert sorted((e.TIN, e.TINNAME) for r in split for e in r.ALL if r.ProviderKey == 10) == [("0-01", "a"), ("0-02", "b")]
    users = spark.createDataFrame([(1, "North", "u", "ADMIN"), (2, "South", "v", None)], schemas.USER_ASSOCIATION)
    assert plain(user_provider_association(users)) == [(1, "North", "u", ("ADMIN",)), (2, "South", "v", (None,))]


def test_history_and_keys(spark):
    rows = [(12345678, 1, " a ", " North ", 10, "H1", "P", "2018-01"), (None, None, None, "North", 10, None, None, None)]
    loaded = load_provider_history(
        spark.createDataFrame(rows, schemas.PROVIDER_HISTORY), dt.datetime(2018, 7, 31, 13, 5)
    )
    assert plain(loaded) == [
        (12345678, 1, "a", "North", 10, "H1", "01-2345678", "P", "2018-01", "2018-07-31 13:05:00"),
        (None, None, None, "North", 10, None, None, None, None, "2018-07-31 13:05:00"),
    ]
    keys = provider_key_list(loaded, "2018-07-31", "2018-08-01")
    assert plain(keys) == [(10, "North", "ACTIVE", "2018-07-31", "2018-08-01")]
    stored = spark.createDataFrame(
        [("10", "North", "NEW", "2018-07-31", "2018-07-31"), ("9", "East", "ACTIVE", "2018-01-01", "2018-07-31")],
        "providersyskey string, healthcareorganizationname string, status string, create_date string, refresh_date string",
    )
    new = spark.createDataFrame([(11, "South"), (11, "South")], "providersyskey int, healthcareorganizationname string")
    assert [tuple(r) for r in refresh_key_list(stored, new, "2018-08-31").collect()] == [
        (9, "East", "ACTIVE", "2018-01-01", "2018-08-31"),
        (10, "North", "ACTIVE", "2018-07-31", "2018-08-31"),
        (11, "South", "NEW", "2018-08-31", "2018-08-31"),
    ]
