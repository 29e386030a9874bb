import datetime as dt
import threading

import pytest
from conftest import plain
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from claimweave import storage
from claimweave.plans import jobs
from claimweave.sinks import (
    append_parquet,
    overwrite_csv,
    overwrite_json,
    overwrite_parquet,
    overwrite_partitioned,
    publish_documents,
    publish_snapshot,
    read_snapshot,
    register_external_table,
    save,
    snapshots,
    to_csv_lines,
)
from claimweave.sources import from_csv_lines, read_csv, read_files, read_json, read_parquet, read_table, run_sql, schemas
from claimweave.storage import cut_lineage, scratch_path


def frame(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "a", "y")], "k int, p string, v string")


def test_empty_path(spark):
    with pytest.raises(ValueError):
        read_files(spark, "", "parquet")


def test_csv_bad_fields_become_null(spark):
    path = scratch_path(spark, "csv")
    rows = [("7", "North", "u", "r"), ("x", "South", "v", None)]
    rows = spark.createDataFrame(rows, "k string, n string, u string, r string")
    overwrite_csv(rows, path)
    assert plain(read_csv(spark, path, schemas.USER_ASSOCIATION)) == [(7, "North", "u", "r"), (None, "South", "v", None)]
    assert read_csv(spark, path).dtypes == [(c, "string") for c in ("k", "n", "u", "r")]


def test_overwrite_append_and_save(spark):
    path, df = scratch_path(spark, "files"), frame(spark)
    overwrite_parquet(df, path)
    overwrite_parquet(df, path)
    append_parquet(df, path)
    assert read_parquet(spark, path).count() == 6
    with pytest.raises(AnalysisException):
        save(df, path)
    save(df, path, mode="overwrite")
    assert plain(read_parquet(spark, path)) == plain(df)
    other = scratch_path(spark, "json")
    save(df, other, "json")
    assert read_json(spark, other).columns == ["k", "p", "v"]
    overwrite_json(df.limit(1), other)
    publish_documents(df, "json", path=other)
    assert plain(read_json(spark, other)) == plain(df)


def test_partitioned_write_with_two_columns(spark):
    path, df = scratch_path(spark, "parts"), frame(spark)
    overwrite_partitioned(df, ["p", "k"], path)
    stored = read_parquet(spark, path)
    assert plain(stored.select("k", "p", "v")) == plain(df)
    plan = stored.filter("p = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    plain_path = scratch_path(spark, "plain")
    overwrite_partitioned(df, [], plain_path)
    assert plain(read_parquet(spark, plain_path)) == plain(df)


def test_external_table(spark):
    path, df = scratch_path(spark, "table"), frame(spark)
    overwrite_partitioned(df, ["p"], path)
    register_external_table(spark, "weave_test_table", path, df.schema, ["p"])
    assert plain(read_table(spark, "weave_test_table").select("k", "p", "v")) == plain(df)
    spark.sql("drop table weave_test_table")
    assert read_parquet(spark, path).count() == 3
    unpartitioned = scratch_path(spark, "table")
    overwrite_parquet(df, unpartitioned)
    register_external_table(spark, "weave_test_table", unpartitioned, df.schema)
    assert plain(read_table(spark, "weave_test_table")) == plain(df)
    spark.sql("drop table weave_test_table")


def test_run_sql_ignores_case(spark):
    assert run_sql(spark, "select sum(K) as s from {t} where P = 'a'", t=frame(spark)).first()[0] == 4


def test_snapshots(spark):
    root, df = scratch_path(spark, "snapshots"), frame(spark)
    with pytest.raises(ValueError):
        read_snapshot(spark, root)
    publish_snapshot(df.filter("k = 1"), root, dt.datetime(2018, 7, 31, 12))
    # The next load reads the current snapshot and writes another one.
    publish_snapshot(read_snapshot(spark, root).withColumn("k", F.col("k") + 10), root, "2018-08-31 12:00:00")
    # Data without a commit row: a load that died.
    df.write.parquet(f"{root}/data/20190101000000-dead")
    assert [r.k for r in read_snapshot(spark, root).collect()] == [11]
    assert [r.k for r in read_snapshot(spark, root, "2018-08-01 00:00:00").collect()] == [1]
    with pytest.raises(ValueError):
        read_snapshot(spark, root, "2018-01-01 00:00:00")
    with pytest.raises(ValueError):
        publish_snapshot(df, root, "2018-08-31 12:00:00")
    publish_snapshot(df, root, "2019-01-01 00:00:00")
    assert read_snapshot(spark, root).count() == 3


def test_cut_lineage(spark):
    one = spark.range(0, 100, 1, 1)
    stored = cut_lineage(one.withColumn("r", F.rand()))
    assert plain(stored) == plain(stored)


def test_stages_are_removed_by_their_owner(spark, monkeypatch):
    monkeypatch.setattr(storage, "_stages", [])
    stored, other = cut_lineage(spark.range(3)), scratch_path(spark, "result")
    overwrite_parquet(stored, other)
    assert storage.drop_stages(spark) == 1 and storage.drop_stages(spark) == 0
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        stored.collect()
    assert read_parquet(spark, other).count() == 3


def test_provider_jobs(spark):
    root, keys, new_keys, rejects = (scratch_path(spark, n) for n in ("lookup", "keys", "newkeys", "rejects"))
    history, delta = scratch_path(spark, "history"), scratch_path(spark, "delta")
    overwrite_csv(
        spark.createDataFrame(
            [(1, 1, "a ", "Alpha", 1, "H", "P", "2018-01"), (2, 2, "b", "Beta", 2, None, None, "2018-01")],
            schemas.PROVIDER_HISTORY,
        ),
        history,
    )
    jobs.provider_history_job(spark, history, root, keys, "2018-07-31", dt.datetime(2018, 7, 31, 12))
    overwrite_csv(
        spark.createDataFrame(
            [
                (10, 1, "c", "alpha", None, None, "2018-06"),
                (2, 3, "d", "Omega", None, None, "2018-06"),
                (11, 4, "e", "Omega", None, None, "2018-06"),
            ],
            schemas.PROVIDER_DELTA,
        ),
        delta,
    )
    now = dt.datetime(2018, 8, 31, 12)
    with pytest.raises(ValueError):
        jobs.provider_incremental_job(spark, delta, root, keys, keys, rejects, now)
    jobs.provider_incremental_job(spark, delta, root, keys, new_keys, rejects, now)
    current = read_snapshot(spark, root)
    assert plain(current.select("tin", "healthcareorganizationname", "providersyskey", "health_system_id")) == [
        (1, "Alpha", 1, "H"),
        (10, "alpha", 1, "H"),
        (11, "Omega", 3, None),
        (2, "Beta", 2, None),
    ]
    assert plain(read_csv(spark, rejects).select("tin", "healthcareorganizationname")) == [("2", "Beta"), ("2", "Omega")]
    assert plain(read_csv(spark, new_keys).select("providersyskey", "status")) == [
        ("1", "ACTIVE"),
        ("2", "ACTIVE"),
        ("3", "NEW"),
    ]


def test_document_and_summary_jobs(spark, sf_dir):
    from claimweave.plans.fixtures import build

    claims, lookup = build(spark, sf_dir, "claims"), build(spark, sf_dir, "lookup")
    documents, collection = scratch_path(spark, "documents"), scratch_path(spark, "collection")
    store = jobs.DocumentStore("json", {"path": collection})
    jobs.claims_documents_job(claims, lookup, "system", "year", documents, store)
    assert read_json(spark, collection).count() == read_json(spark, documents).count() > 0
    jobs.provider_tin_list_job(lookup, documents, store)
    assert read_json(spark, collection).count() == lookup.select("providersyskey").distinct().count()
    users = scratch_path(spark, "users")
    overwrite_csv(build(spark, sf_dir, "users"), users)
    jobs.user_association_job(spark, users, documents)
    assert dict(read_json(spark, documents).dtypes)["roles"] == "array<string>"
    lobs, questions = scratch_path(spark, "lobs"), scratch_path(spark, "questions")
    jobs.call_inquiries_job(build(spark, sf_dir, "calls"), lookup, "2024-01-20", lobs, questions)
    assert read_parquet(spark, lobs).count() == read_parquet(spark, questions).count() > 0
    metrics, scores = scratch_path(spark, "metrics"), scratch_path(spark, "scores")
    jobs.self_service_job(build(spark, sf_dir, "selfservice"), lookup, "2024-03-15", metrics)
    assert len(read_parquet(spark, metrics).columns) == 28
    pcor = scratch_path(spark, "pcor")
    overwrite_csv(build(spark, sf_dir, "pcor"), pcor)
    jobs.pcor_job(spark, pcor, lookup, scores)
    assert len(read_parquet(spark, scores).columns) == 13


def test_run_job(spark, sf_dir, tmp_path):
    import json

    import run_job
    from claimweave.plans.fixtures import build

    claims, path, collection = (scratch_path(spark, n) for n in ("claims", "documents", "collection"))
    overwrite_parquet(build(spark, sf_dir, "claims"), claims)
    build(spark, sf_dir, "lookup").createOrReplaceTempView("job_lookup")
    arguments = f"--claims parquet:{claims} --lookup job_lookup --level tin --period year --path {path}"
    (tmp_path / "options.json").write_text(json.dumps({"path": collection}))
    store = f"--store-format json --store-options {tmp_path}/options.json"
    run_job.main(["claims_documents_job", *arguments.split(), *store.split()])
    assert read_json(spark, path).count() == read_json(spark, collection).count() > 0
    history = scratch_path(spark, "history")
    overwrite_csv(build(spark, sf_dir, "history").drop("formattedtin"), history)
    root, keys = scratch_path(spark, "lookup"), scratch_path(spark, "keys")
    arguments = f"--history-path {history} --lookup-root {root} --key-path {keys} --create-date 2018-07-31"
    run_job.main(["provider_history_job", *arguments.split(), "--now", "2018-07-31 13:00:00"])
    assert {r.refresh_date for r in read_snapshot(spark, root).collect()} == {"2018-07-31 13:00:00"}
    with pytest.raises(SystemExit):
        run_job.main(["claims_documents_job"])


def test_snapshots_of_the_same_second(spark, monkeypatch):
    """Two loads of one second: both find the time free, one is published and the other one fails."""
    root, df = scratch_path(spark, "snapshots"), frame(spark)
    meet, won, lost = threading.Barrier(2), [], []
    check = snapshots._is_published

    def both_pass(*arguments):
        found = check(*arguments)
        meet.wait(60)
        return found

    monkeypatch.setattr(snapshots, "_is_published", both_pass)

    def load(k):
        try:
            won.append((k, publish_snapshot(df.filter(F.col("k") == k), root, "2019-01-01 00:00:00")))
        except ValueError:
            lost.append(k)

    threads = [threading.Thread(target=load, args=(k,)) for k in (1, 2)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(won) == len(lost) == 1
    k, folder = won[0]
    assert [r.k for r in read_snapshot(spark, root).collect()] == [k] == [r.k for r in spark.read.parquet(folder).collect()]
    monkeypatch.setattr(snapshots, "_is_published", check)
    with pytest.raises(ValueError):
        publish_snapshot(df, root, "2019-01-01 00:00:00")
    assert [r.k for r in read_snapshot(spark, root).collect()] == [k]


def test_commits_by_rename(spark):
    """What a shared file system does instead of linking: the second rename to a name fails."""
    root = scratch_path(spark, "commits")
    assert snapshots._commit(spark, f"{root}/a", {"folder": "one"}, link=False)
    assert not snapshots._commit(spark, f"{root}/a", {"folder": "two"}, link=False)
    assert [r.folder for r in spark.read.json(root).collect()] == ["one"]


def test_csv_keeps_blanks(spark):
    path = scratch_path(spark, "blanks")
    df = spark.createDataFrame([(" a ", 1), ("a", 2), ('q"u,o', 3), (None, None), ("", 5), ("  ", 6)], "v string, n int")
    overwrite_csv(df, path)
    stored = read_csv(spark, path)
    assert (" a ", "1") in plain(stored)
    # The lines of the file are the same without the file.
    assert plain(from_csv_lines(to_csv_lines(df), df.columns)) == plain(stored)
