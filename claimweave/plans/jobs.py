"""The batch jobs from input to published output.

Every input is a DataFrame (see ``claimweave.sources``), every reporting date an
argument. A failure fails the job.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimweave.operators.calls import call_metrics_by_question, call_volume_by_lob
from claimweave.operators.claims import claims_documents
from claimweave.operators.directory import provider_tin_list, user_provider_association
from claimweave.operators.providers import (
    load_provider_history,
    provider_key_list,
    refresh_key_list,
)
from claimweave.operators.quality import pcor_extract
from claimweave.operators.reconcile import Reconciliation
from claimweave.operators.selfservice import self_service_metrics
from claimweave.sinks import (
    overwrite_csv,
    overwrite_json,
    overwrite_parquet,
    publish_documents,
    publish_snapshot,
    read_snapshot,
)
from claimweave.sources import read_csv, read_files, read_json
from claimweave.sources import schemas


@dataclass
class DocumentStore:
    """Where finished documents are published: a connector's format and its options."""

    file_format: str
    options: dict[str, str]


def _documents(df: DataFrame, path: str, store: DocumentStore | None) -> None:
    overwrite_json(df, path)
    if store:
        # The written files, not the plan, are published: no recomputation.
        stored = read_json(df.sparkSession, path, df.schema)
        publish_documents(stored, store.file_format, **store.options)


def claims_documents_job(
    claims: DataFrame, lookup: DataFrame, level: str, period: str, path: str, store: DocumentStore | None = None
) -> None:
    """Claims documents by tax ID or system, by month or year."""
    _documents(claims_documents(claims, lookup, level, period), path, store)


def provider_tin_list_job(lookup: DataFrame, path: str, store: DocumentStore | None = None) -> None:
    """One document per provider system with its tax IDs."""
    _documents(provider_tin_list(lookup), path, store)


def user_association_job(
    spark: SparkSession,
    users_path: str,
    path: str,
    store: DocumentStore | None = None,
    file_format: str = "csv",
) -> None:
    """User list to documents. A spreadsheet needs a connector: pass its format name."""
    users = read_files(spark, users_path, file_format, schemas.USER_ASSOCIATION, header="true")
    _documents(user_provider_association(users), path, store)


def call_inquiries_job(
    calls: DataFrame, lookup: DataFrame, as_of: dt.date | str, lob_path: str, question_path: str, days: int = 365
) -> None:
    """Call summaries by line of business and by question type."""
    overwrite_parquet(call_volume_by_lob(calls, lookup, as_of, days), lob_path)
    overwrite_parquet(call_metrics_by_question(calls, lookup, as_of, days), question_path)


def self_service_job(facts: DataFrame, lookup: DataFrame, as_of: dt.date | str, path: str) -> None:
    """Self-service adoption and cost metrics."""
    overwrite_parquet(self_service_metrics(facts, lookup, as_of), path)


def pcor_job(spark: SparkSession, pcor_path: str, lookup: DataFrame, path: str) -> None:
    """Quality file joined to provider systems."""
    overwrite_parquet(pcor_extract(read_csv(spark, pcor_path, schemas.PCOR), lookup), path)


def provider_history_job(
    spark: SparkSession,
    history_path: str,
    lookup_root: str,
    key_path: str,
    create_date: dt.date | str,
    now: dt.datetime,
) -> None:
    """Full provider file to the first lookup snapshot and the key list.

    The snapshot is published last, so a load that fails earlier can simply be
    run again.
    """
    lookup = load_provider_history(read_csv(spark, history_path, schemas.PROVIDER_HISTORY), now)
    overwrite_csv(provider_key_list(lookup, create_date, now), key_path)
    publish_snapshot(lookup, lookup_root, now)


def provider_incremental_job(
    spark: SparkSession,
    delta_path: str,
    lookup_root: str,
    key_path: str,
    new_key_path: str,
    reject_path: str,
    now: dt.datetime,
) -> None:
    """Delta file reconciled with the current snapshot: next snapshot, reject file, key list.

    The snapshot is published last, so a load that fails earlier can simply be
    run again.
    """
    if key_path == new_key_path:
        raise ValueError("the refreshed key list needs a path of its own")
    existing = read_snapshot(spark, lookup_root)
    incoming = read_csv(spark, delta_path, schemas.PROVIDER_DELTA)
    load = Reconciliation(existing, incoming, now)
    overwrite_csv(load.rejected, reject_path)
    overwrite_csv(refresh_key_list(read_csv(spark, key_path), load.new_provider, now), new_key_path)
    publish_snapshot(load.merged, lookup_root, now)
