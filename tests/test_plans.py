"""Plans: what reaches the scan, and what must not appear."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from claimweave.operators.calls import call_volume_by_lob
from claimweave.operators.claims import claims_denials, claims_documents, claims_summary
from claimweave.operators.reconcile import Reconciliation
from claimweave.plans import registry
from claimweave.plans.fixtures import build
from claimweave.storage import cut_lineage, shared_folder


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan, column):
    return [line for line in plan.splitlines() if "FileScan" in line and column in line.split("ReadSchema")[-1]]


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    names = ("claims", "lookup", "calls", "existing", "incoming")
    return SimpleNamespace(**{n: cut_lineage(build(spark, sf_dir, n)) for n in names})


@pytest.mark.parametrize("operator", [claims_summary, claims_denials, claims_documents])
def test_claims_are_scanned_once(stored, operator):
    plan = physical(operator(stored.claims, stored.lookup, "tin", "month"))
    assert len(scans(plan, "providertin")) == 1


def test_only_needed_columns_and_rows_are_read(stored):
    scan = scans(physical(claims_denials(stored.claims, stored.lookup, "system", "year")), "providertin")[0]
    assert "EqualTo(PaidOrDeniedCode,D)" in scan
    assert "UHCPaidAmount" not in scan.split("ReadSchema")[-1] and "BilledAmount" not in scan.split("ReadSchema")[-1]
    scan = scans(physical(call_volume_by_lob(stored.calls, stored.lookup, "2024-01-20")), "callVolume")[0]
    assert "GreaterThanOrEqual(calldate,20230120)" in scan and "LessThan(calldate,20240121)" in scan
    assert "handleTime" not in scan


def test_claims_are_reduced_before_the_lookup(spark, stored):
    """The rows that meet the lookup are partial sums, whatever share one tax ID has."""
    hot = stored.claims.withColumn("providertin", F.lit(1).cast("bigint"))
    plan = claims_summary(hot, stored.lookup, "system", "year")._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    kinds = [line.split(" ")[0] for line in lines]
    assert kinds.index("Join") < len(kinds) - 1 - kinds[::-1].index("Aggregate")


@pytest.mark.parametrize("branch", ["merged", "rejected", "new_names"])
def test_no_nested_loops(stored, branch):
    plan = physical(getattr(Reconciliation(stored.existing, stored.incoming, "2018-08-31 00:00:00"), branch))
    assert "Join" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("branch", ["merged", "rejected"])
def test_inputs_are_read_a_few_times(stored, branch):
    """At most six reads of either input, subqueries included, and no plan inside a plan."""
    load = Reconciliation(stored.existing, stored.incoming, "2018-08-31 00:00:00")
    plan = getattr(load, branch)._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "Relation [" in line]
    existing = sum("formattedtin" in line for line in reads)
    assert 1 <= existing <= 6 and 1 <= len(reads) - existing <= 6
    assert "scalar-subquery" not in plan


def test_names_meet_rows_before_they_are_spelled_out(stored):
    """What is joined to the incoming rows has one row per normalised name; the keys of its spellings are opened above."""
    plan = Reconciliation(stored.existing, stored.incoming, "2018-08-31 00:00:00").new_provider._jdf.queryExecution().optimizedPlan()
    lines = [line.strip(" :+-") for line in plan.toString().splitlines()]
    opened = next(k for k, line in enumerate(lines) if line.startswith("Generate inline(_opened"))
    join = next(k for k, line in enumerate(lines) if line.startswith("Join") and "_given" in line)
    gathered = next(k for k, line in enumerate(lines) if line.startswith("Aggregate") and "collect_set" in line and k > join)
    assert opened < join < gathered


def test_nothing_is_written_while_a_plan_is_built(spark, stored, sf_dir, monkeypatch):
    written = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda *a, **k: written.append(a))
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.csv", lambda *a, **k: written.append(a))
    for name in ("reconcile_surrogate_keys", "reconcile_merged", "key_list_refresh", "segment_full_outer"):
        registry.queries()[name](spark, sf_dir)
    assert not written


def test_co_aggregate_scans_once(spark, sf_dir):
    plan = physical(registry.queries()["segment_full_outer"](spark, sf_dir))
    assert len([line for line in plan.splitlines() if "FileScan" in line and "l_suppkey" in line]) == 1
    assert "FullOuter" not in plan


def test_shared_folder_is_required_on_a_cluster():
    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master)
        )

    assert shared_folder(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        shared_folder(session("yarn", None))
    assert shared_folder(session("local[2]", None)) == shared_folder(session("local[2]", None))


def test_claims_are_reduced_to_the_grain_that_is_asked_for(stored):
    """Summaries are not split by denial category, and documents copy no row to parts that it does not count in."""
    scan = scans(physical(claims_summary(stored.claims, stored.lookup, "tin", "month")), "providertin")[0]
    assert "ClaimDenialCategoryLevel1ShortName" not in scan.split("ReadSchema")[-1]
    assert "Expand" not in physical(claims_documents(stored.claims, stored.lookup, "tin", "month"))


def steps_above(plan, column):
    """The steps between the only scan of ``column`` and the end of the plan."""
    lines = plan.splitlines()
    depth = [next((k for k, c in enumerate(line) if c not in " :+-*"), 0) for line in lines]
    at = next(k for k, line in enumerate(lines) if line in scans(plan, column))
    found = []
    for k in range(at - 1, -1, -1):
        if depth[k] < depth[at]:
            found.append(lines[k].strip(" :+-*"))
            at = k
    return found


def test_rows_of_tax_id_documents_are_shuffled_once_after_the_lookup(stored):
    steps = steps_above(physical(claims_documents(stored.claims, stored.lookup, "tin", "month")), "providertin")
    join = next(k for k, step in enumerate(steps) if "Join" in step)
    assert sum(step.startswith("Exchange hashpartitioning") for step in steps[join:]) == 1


def test_items_are_shuffled_once_to_become_claims(spark, sf_dir):
    """Also if neither orders nor customers fit a broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = steps_above(physical(build(spark, sf_dir, "claims")), "l_suppkey")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(step.startswith("Exchange") for step in steps) == 1
