"""The incremental load against a plain-Python reading of its definition."""

import random
from collections import Counter

import pytest
from conftest import plain

from claimweave.operators.providers import LOOKUP_COLUMNS
from claimweave.operators.reconcile import OTHER_PROVIDER, SAME_PROVIDER, Reconciliation, reconcile_providers
from claimweave.sources.schemas import PROVIDER_DELTA

NOW = "2018-08-31 13:00:00"
EXISTING = (
    "tin bigint, mpin bigint, tinname string, healthcareorganizationname string, providersyskey int, "
    "health_system_id string, formattedtin string, pcorname string, claimsthrudate string, refresh_date string"
)


def norm(name):
    return None if name is None else name.strip(" ").upper()


def not_in(value, values):
    """SQL NOT IN over a list that may hold nulls."""
    if not values:
        return True
    return value is not None and None not in values and value not in values


def formatted(tin):
    text = None if tin is None else str(tin)
    if text is None or not 1 <= len(text) <= 9:
        return text
    return {9: text[:2] + "-" + text[2:], 8: f"0{text[:1]}-{text[1:]}", 7: "0-" + text}.get(len(text), "0-0" + text)


def first(*values):
    return next((v for v in values if v is not None), None)


def distinct(rows):
    return list(dict.fromkeys(rows))


def repeated(rows):
    counts = Counter(r[0] for r in rows if r[0] is not None)
    return {tin for tin, n in counts.items() if n > 1}


def expected(existing, incoming):
    """Row sets of the load. Rows: tin, mpin, tinname, name, key, system, formatted, pcor, thru, refreshed."""
    dated = lambda r: (*r[:6], formatted(r[0]), *r[-2:], NOW)
    out = {}
    known = [norm(e[3]) for e in existing]
    out["new_names"] = [i for i in incoming if not_in(norm(i[3]), known)]
    ep = distinct(
        (i[0], i[1], i[2], i[3], e[4], first(i[4], e[5]), i[5], i[6])
        for e in existing
        for i in incoming
        if norm(i[3]) is not None and norm(e[3]) == norm(i[3])
    )
    out["existing_provider"] = ep
    out["ep_duplicates"] = [r for r in ep if r[0] in repeated(ep)]
    out["ep_unique"] = unique = [dated(r) for r in ep if not_in(r[0], [d[0] for d in out["ep_duplicates"]])]
    pairs = [
        (n, e)
        for n in unique
        for e in existing
        if n[0] is not None and n[0] == e[0] and n[3] is not None and e[3] is not None and n[3] != e[3]
    ]
    out["tin_conflict"] = [n for n, _ in pairs] + [e for _, e in pairs]
    out["ep_accepted"] = [r for r in unique if not_in(r[0], [n[0] for n, _ in pairs])]
    et = distinct(
        (
            *(e[0], first(i[1], e[1]), first(i[2], e[2]), e[3], e[4], first(i[4], e[5])),
            *(e[6], first(i[5], e[7]), first(i[6], e[8])),
        )
        for e in existing
        for i in incoming
        if e[0] is not None and e[0] == i[0]
    )
    out["existing_tin"] = et
    out["tin_duplicates"] = [(*r, NOW) for r in et if r[0] in repeated(et)]
    highest = max([e[4] for e in existing if e[4] is not None], default=0)
    names = sorted({i[3] for i in out["new_names"]}, key=lambda n: (n is not None, n or ""))
    out["new_keys"] = keys = [(n, highest + k) for k, n in enumerate(names, 1)]
    out["new_provider"] = np = [
        (i[0], i[1], i[2], i[3], key, i[4], formatted(i[0]), i[5], i[6])
        for name, key in keys
        for i in incoming
        if norm(name) is not None and norm(name) == norm(i[3])
    ]
    out["np_duplicates"] = [r for r in np if r[0] in repeated(np)]
    unique = [(*r, NOW) for r in np if not_in(r[0], [d[0] for d in out["np_duplicates"]])]
    clash = [r for r in unique if r[0] is not None and r[0] in {e[0] for e in existing}]
    out["np_conflict"] = [e for e in existing if e[0] in {c[0] for c in clash}] + clash
    out["np_accepted"] = [r for r in unique if not_in(r[0], [c[0] for c in clash])]
    out["rejected"] = [
        (r[0], r[2], r[3], reason)
        for branch, reason in [
            ("tin_conflict", OTHER_PROVIDER),
            ("tin_duplicates", OTHER_PROVIDER),
            ("ep_duplicates", SAME_PROVIDER),
            ("np_duplicates", SAME_PROVIDER),
            ("np_conflict", OTHER_PROVIDER),
        ]
        for r in out[branch]
    ]
    best = {}
    for r in out["ep_accepted"] + out["np_accepted"] + out["tin_duplicates"] + existing:
        rank = tuple((v is not None, v) for v in (r[2], r[1], r[5], r[4], r[6], r[7], r[8]))
        group = best.setdefault((r[0], r[3]), {})
        group.setdefault(r[9], []).append((rank, r))
    out["merged"] = [min(group[max(group)])[1] for group in best.values()]
    return out


def random_load(seed, null_tins, null_names):
    random.seed(seed)
    names = ["Alpha", " alpha", "ALPHA ", "Beta", "Gamma", "Delta", "delta ", "Epsilon", "Zeta"]
    tins = [None] * null_tins + [random.choice([7, 12345678, 99, 1234567890]) * 10 + k for k in range(24)]
    existing, incoming = [], []
    for k in range(14):
        tin, name = random.choice(tins), random.choice(names[:4] + names[5:6] + [None] * null_names)
        system = random.choice([None, "HS1", "HS2"])
        key = 1 + names.index(name) if name else 50
        when = random.choice(["2018-07-31 09:00:00", "2018-07-31 12:30:00", "2018-07-31 13:30:00"])
        pcor = random.choice([None, "P"])
        mpin, tinname = random.choice([None, k]), f"old {k % 3}"
        existing.append((tin, mpin, tinname, name, key, system, formatted(tin), pcor, "2018-01", when))
    for k in range(26):
        incoming.append(
            (
                random.choice(tins),
                random.choice([None, k]),
                f"new {k % 4}",
                random.choice(names + [None] * null_names),
                random.choice([None, "HS1", "HS3"]),
                random.choice([None, "Q"]),
                "2018-06",
            )
        )
    return existing, incoming


def same(actual, wanted):
    assert plain(actual) == sorted(wanted, key=repr)


BRANCHES = [
    "new_names",
    "existing_provider",
    "ep_duplicates",
    "ep_unique",
    "tin_conflict",
    "ep_accepted",
    "existing_tin",
    "tin_duplicates",
    "new_keys",
    "new_provider",
    "np_duplicates",
    "np_conflict",
    "np_accepted",
    "rejected",
    "merged",
]


@pytest.mark.parametrize("seed, null_tins, null_names", [(1, 0, 0), (2, 4, 0), (3, 2, 1)])
def test_all_branches(spark, seed, null_tins, null_names):
    existing, incoming = random_load(seed, null_tins, null_names)
    wanted = expected(existing, incoming)
    load = Reconciliation(
        spark.createDataFrame(existing, EXISTING), spark.createDataFrame(incoming, PROVIDER_DELTA), NOW
    )
    for branch in BRANCHES:
        same(getattr(load, branch), wanted[branch])
    if not null_names:
        assert wanted["new_keys"]


def test_rows_without_tax_id_pass_while_nothing_is_refused(spark):
    existing = [(1, 1, "t", "Alpha", 1, None, "0-01", None, "2018-01", "2018-07-31 09:00:00")]
    incoming = [
        (None, 5, "n", "Alpha", None, None, "2018-06"),
        (20, 5, "n", "Alpha", None, None, "2018-06"),
        (None, 5, "n", "Omega", None, None, "2018-06"),
        (21, 5, "n", "Omega", None, None, "2018-06"),
    ]
    refused = [(20, 6, "n", "Alpha", None, None, "2018-06"), (1, 6, "n", "Omega", None, None, "2018-06")]
    for rows in (incoming, [*incoming, *refused]):
        wanted = expected(existing, rows)
        load = Reconciliation(
            spark.createDataFrame(existing, EXISTING), spark.createDataFrame(rows, PROVIDER_DELTA), NOW
        )
        same(load.merged, wanted["merged"])
        same(load.rejected, wanted["rejected"])


def test_empty_lookup(spark):
    existing, incoming = [], [(20, 5, "n", "Omega", None, None, "2018-06"), (21, 5, "n", None, None, None, "2018-06")]
    wanted = expected(existing, incoming)
    merged, rejected, new = reconcile_providers(
        spark.createDataFrame(existing, EXISTING), spark.createDataFrame(incoming, PROVIDER_DELTA), NOW
    )
    same(merged, wanted["merged"])
    same(rejected, wanted["rejected"])
    same(new, wanted["new_provider"])
    assert merged.columns == LOOKUP_COLUMNS


def test_every_incoming_tax_id_is_accounted_for(spark):
    existing, incoming = random_load(9, 0, 0)
    load = Reconciliation(
        spark.createDataFrame(existing, EXISTING), spark.createDataFrame(incoming, PROVIDER_DELTA), NOW
    )
    merged, rejected = load.merged.collect(), load.rejected.collect()
    assert {i[0] for i in incoming} <= {r[0] for r in merged} | {r[0] for r in rejected}
    keys = [(r["tin"], r["healthcareorganizationname"]) for r in merged]
    assert len(keys) == len(set(keys))
    assert [r["tin"] for r in rejected] == sorted(r["tin"] for r in rejected)


def test_a_tax_id_with_many_variants_on_both_sides(spark):
    """Existing variants that incoming rows override do not multiply them; open attributes still show every variant."""
    old = spark.range(300).selectExpr(
        "1 as tin", "cast(id as int) as mpin", "'name' as tinname", "'org' as healthcareorganizationname", "7 as providersyskey",
        "1 as health_system_id", "'0-1' as formattedtin", "cast(id % 3 as string) as pcorname", "'x' as claimsthrudate", "'now' as refresh_date",
    )
    new = spark.range(300).selectExpr(
        "1 as tin", "cast(1000 + id as int) as mpin", "'new' as tinname", "'org' as healthcareorganizationname",
        "2 as health_system_id", "if(id < 10, null, 'p') as pcorname", "'y' as claimsthrudate",
    )
    found = Reconciliation(old, new, "2018-08-31 00:00:00").existing_tin
    rows = Counter((r.mpin, r.pcorname) for r in found.collect())
    wanted = [(1000 + i, p) for i in range(300) for p in (("0", "1", "2") if i < 10 else ("p",))]
    assert rows == Counter(wanted)
