"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from claimweave.functions import (
    clean_date,
    clean_double,
    clean_int,
    clean_long,
    clean_string,
    format_tin,
    in_pass_year,
    md5_hex,
    month_index,
    rolling_12_months,
)
from claimweave.operators import claims as claims_ops
from claimweave.operators.calls import call_metrics_by_question, call_volume_by_lob
from claimweave.operators.directory import provider_tin_list, user_provider_association
from claimweave.operators.grains import with_totals
from claimweave.operators.keys import co_aggregate, duplicate_keys, latest_per_key
from claimweave.operators.providers import load_provider_history, provider_key_list, refresh_key_list
from claimweave.operators.quality import pcor_extract
from claimweave.operators.reconcile import Reconciliation
from claimweave.operators.selfservice import self_service_metrics, self_service_monthly
from claimweave.plans.fixtures import build, table
from claimweave.sinks import (
    append_parquet,
    overwrite_csv,
    overwrite_parquet,
    overwrite_partitioned,
    publish_documents,
    publish_snapshot,
    read_snapshot,
    register_external_table,
    save,
    to_csv_lines,
)
from claimweave.sources import from_csv_lines, read_csv, read_json, read_parquet, run_sql
from claimweave.sources.schemas import USER_ASSOCIATION
from claimweave.storage import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

CALLS_AS_OF = dt.date(2024, 1, 20)
SELF_SERVICE_AS_OF = dt.date(2024, 3, 15)
PASS_AS_OF = dt.date(1998, 7, 31)
CREATED = dt.date(2018, 7, 31)
LOADED = dt.datetime(2018, 7, 31, 12, 30)
NOW = dt.datetime(2018, 8, 31)


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# Claims


def _claims(operator, level: str, period: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return operator(build(spark, sf_dir, "claims"), build(spark, sf_dir, "lookup"), level, period)


def _flat(operator, level: str, period: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_claims(operator, level, period, spark, sf_dir))


def _document_text(level: str, period: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _claims(claims_ops.claims_documents, level, period, spark, sf_dir)
    return documents.withColumns({block: F.to_json(block) for block in ("EI", "CS", "MR", "ALL")})


def claims_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, segment = "IncurredServiceDate", "BusinessSegmentIdentifier"
    # Reduced first: grouping sets copy each row once per grain.
    reduced = (
        build(spark, sf_dir, "claims")
        .groupBy(day, segment)
        .agg(F.sum("masteridclaimcount").alias("claims"), F.sum("BilledAmount").alias("billed"))
    )
    totals = with_totals(reduced, [day], segment, [F.sum(c).alias(c) for c in ("claims", "billed")])
    return _plain(totals).withColumn("is_total", F.col("is_total").cast("int"))


def segment_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["ProviderSystem", "ProviderKey", "TIN", "ReportingPeriod"]
    # The sides show two segments; each segment is summed by itself, so the others need not be.
    claims = build(spark, sf_dir, "claims").where(F.col("BusinessSegmentIdentifier").isin("E&I", "C&S"))
    summary = claims_ops.claims_summary(claims, build(spark, sf_dir, "lookup"), "tin", "month")
    segment, denied = F.col("Segment"), F.col("ClaimsDenied")
    sides = {
        "paid": (segment == "E&I", {"ClaimsPaid": lambda c: F.sum(c("ClaimsPaid"))}),
        "denied": ((segment == "C&S") & (denied > 0), {"ClaimsDenied": lambda c: F.sum(c("ClaimsDenied"))}),
    }
    return co_aggregate(summary.select(*keys, "Segment", "ClaimsPaid", "ClaimsDenied"), keys, sides)


# Calls, self-service, quality


def _calls(operator, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(operator(build(spark, sf_dir, "calls"), build(spark, sf_dir, "lookup"), CALLS_AS_OF))


_SUMMED_RATIOS = [
    "avgpclmprctm",
    "avgeclmprctm",
    "avgprecprctm",
    "avgerecprctm",
    "clmprctmdiff",
    "reconprctmdiff",
    "pnpadptrt",
    "lnkadptrt",
    "overalladprt",
]


def selfservice_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = self_service_monthly(
        build(spark, sf_dir, "selfservice"), build(spark, sf_dir, "lookup"), SELF_SERVICE_AS_OF
    )
    return _plain(monthly)


def selfservice_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = self_service_metrics(
        build(spark, sf_dir, "selfservice"), build(spark, sf_dir, "lookup"), SELF_SERVICE_AS_OF
    )
    # Sums of monthly averages depend on the order of addition in the last digits.
    return _plain(final).withColumns({c: F.round(c, 9) for c in _SUMMED_RATIOS})


def pcor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pcor_extract(build(spark, sf_dir, "pcor"), build(spark, sf_dir, "lookup"))


# Providers


def tin_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = provider_tin_list(build(spark, sf_dir, "lookup"))
    return documents.withColumn("ALL", F.to_json("ALL"))


def user_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "users")
    overwrite_csv(build(spark, sf_dir, "users"), path)
    users = user_provider_association(read_csv(spark, path, USER_ASSOCIATION))
    return users.withColumn("roles", F.to_json("roles"))


def provider_history_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_provider_history(build(spark, sf_dir, "history"), LOADED)


def key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provider_key_list(build(spark, sf_dir, "existing"), CREATED, NOW)


def _load(spark: SparkSession, sf_dir: str) -> Reconciliation:
    return Reconciliation(build(spark, sf_dir, "existing"), build(spark, sf_dir, "incoming"), NOW)


def key_list_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = _load(spark, sf_dir)
    name = F.col("healthcareorganizationname")
    # Names as people write them, with blanks around some, go through the text of the key file and back.
    padded = F.when(F.col("providersyskey") % 3 == 0, F.concat(F.lit("  "), name, F.lit(" "))).otherwise(name)
    listed = provider_key_list(load.existing.withColumn("healthcareorganizationname", padded), CREATED, CREATED)
    return refresh_key_list(from_csv_lines(to_csv_lines(listed), listed.columns), load.new_provider, NOW)


def _branch(branch: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return getattr(_load(spark, sf_dir), branch)


_BRANCHES = {
    "reconcile_new_names": "new_names",
    "reconcile_existing_provider": "existing_provider",
    "reconcile_ep_duplicates": "ep_duplicates",
    "reconcile_ep_unique": "ep_unique",
    "reconcile_tin_conflict": "tin_conflict",
    "reconcile_ep_accepted": "ep_accepted",
    "reconcile_existing_tin": "existing_tin",
    "reconcile_tin_duplicates": "tin_duplicates",
    "reconcile_surrogate_keys": "new_keys",
    "reconcile_new_provider": "new_provider",
    "reconcile_np_duplicates": "np_duplicates",
    "reconcile_np_conflict": "np_conflict",
    "reconcile_np_accepted": "np_accepted",
    "reconcile_rejected": "rejected",
    "reconcile_merged": "merged",
}


# Primitives


def _tins(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "tins").select("tin", format_tin("tin", mode).alias("formattedtin"))


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    newest = latest_per_key(orders, ["o_custkey", "o_orderstatus"], F.col("o_orderdate"), ["o_orderkey"])
    return newest.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus").distinct()


def rolling_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("shipped"))
    return (
        shipped.filter(rolling_12_months("shipped", "2000-07-31"))
        .groupBy("shipped")
        .agg(F.count(F.lit(1)).alias("items"))
    )


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = month_index(F.year("l_shipdate"), F.month("l_shipdate")).alias("month_index")
    return table(spark, sf_dir, "lineitem").groupBy(index).agg(F.count(F.lit(1)).alias("items"))


def pass_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate")
    years = [F.when(in_pass_year(shipped, PASS_AS_OF, back), back) for back in range(3)]
    wanted = items.where(in_pass_year(shipped, PASS_AS_OF, 2) | in_pass_year(shipped, PASS_AS_OF, 1) | in_pass_year(shipped, PASS_AS_OF))
    return wanted.groupBy(F.coalesce(*years).cast("long").alias("back")).agg(F.count(F.lit(1)).alias("items"))


def clean_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = clean_double("amount_text")
    return build(spark, sf_dir, "raw_text").select(
        "event_id",
        clean_int("number_text").alias("as_int"),
        clean_long("number_text").alias("as_long"),
        # Not a number equals nothing, itself included, so it is compared as a flag.
        F.when(~F.isnan(amount), amount).alias("as_double"),
        F.isnan(amount).cast("int").alias("not_a_number"),
    )


def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "raw_text").select("event_id", clean_string("number_text").alias("as_text"))


def clean_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir, "raw_text").select("event_id", clean_date("date_text", "dd/MM/yyyy").alias("as_date"))


def md5_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", md5_hex("text").alias("hash"))


def sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark,
        """select O_ORDERSTATUS as o_orderstatus, O_OrderPriority as o_orderpriority, count(*) as orders,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as double) as amount
           from {orders} group by o_orderstatus, o_orderpriority""",
        orders=table(spark, sf_dir, "orders"),
    )


# Input and output


def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    key = F.when(F.col("c_acctbal") < 0, F.lit("unknown")).otherwise(F.col("c_nationkey").cast("string"))
    rows = table(spark, sf_dir, "customer").select(
        key.alias("Providersyskey"),
        F.col("c_mktsegment").alias("Healthcareorganizationname"),
        F.col("c_name").alias("userID"),
        F.lit("VIEWER").alias("roles"),
    )
    overwrite_csv(rows, path)
    return read_csv(spark, path, USER_ASSOCIATION)


_CATEGORY = "claimdenialcategorylevel1shortname"


def _values_of(block: str, part: str, fields: list[str]) -> Callable[[Column], Column]:
    """An entry of a list as (block, list, entry, values), for any fields."""
    measures = [name for name in fields if name != _CATEGORY]

    def opened(entry: Column) -> Column:
        label = entry[_CATEGORY] if _CATEGORY in fields else F.lit(None).cast("string")
        values = [F.struct(F.lit(m).alias("Measure"), entry[m].cast("double").alias("Value")) for m in measures]
        return F.struct(F.lit(block).alias("Block"), F.lit(part).alias("List"), label.alias("Entry"), F.array(*values).alias("Values"))

    return opened


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the documents as inferred from their files: one row per block, list, entry and measure."""
    path = scratch_path(spark, "documents")
    publish_documents(_claims(claims_ops.claims_documents, "system", "year", spark, sf_dir), "json", path=path)
    stored = read_json(spark, path)
    lists = []
    for block in ("EI", "CS", "MR", "ALL"):
        for part in stored.schema[block].dataType:
            fields = part.dataType.elementType.names
            lists.append(F.transform(F.col(f"{block}.{part.name}"), _values_of(block, part.name, fields)))
    rows = stored.select("ProviderSystem", "ProviderKey", "ReportingPeriod", F.inline(F.flatten(F.array_compact(F.array(*lists)))))
    return rows.select("ProviderSystem", "ProviderKey", "ReportingPeriod", "Block", "List", "Entry", F.inline("Values"))


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    overwrite_parquet(table(spark, sf_dir, "lineitem"), path)
    amount = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double")
    return read_parquet(spark, path).groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("items"), amount.alias("amount"))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
_ORDER_PARTITIONS = ["o_orderstatus", "o_orderpriority"]


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    overwrite_partitioned(table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS), _ORDER_PARTITIONS, path)
    return read_parquet(spark, path).select(*_ORDER_COLUMNS)


def append_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "append")
    for name, prefix, key in (("supplier", "s", "s_suppkey"), ("part", "p", "p_partkey")):
        rows = table(spark, sf_dir, name).select(F.col(key).alias("tin"), F.col(f"{prefix}_name").alias("tinname"))
        append_parquet(rows, path)
    return read_parquet(spark, path)


def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, name = scratch_path(spark, "table"), f"orders_{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS)
    overwrite_partitioned(orders, _ORDER_PARTITIONS, path)
    register_external_table(spark, name, path, orders.schema, _ORDER_PARTITIONS)
    return spark.table(name).select(*_ORDER_COLUMNS)


def save_error_if_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "saved")
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS)
    save(orders, path, "parquet")
    try:
        save(orders.limit(0), path, "parquet")
        refused = 0
    except AnalysisException:
        refused = 1
    return read_parquet(spark, path).withColumn("refused", F.lit(refused))


def save_default_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "saved")
    orders = table(spark, sf_dir, "orders").select(*_ORDER_COLUMNS)
    save(orders, path)
    save(orders.where("o_orderstatus <> 'F'"), path, mode="overwrite")
    return spark.read.load(path)


def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "snapshots")
    columns = ["tin", "tinname", "healthcareorganizationname"]
    publish_snapshot(build(spark, sf_dir, "lookup").select(*columns), root, LOADED)
    publish_snapshot(build(spark, sf_dir, "existing").select(*columns), root, NOW)
    first = read_snapshot(spark, root, LOADED).select(F.lit("first").alias("version"), *columns)
    return first.unionByName(read_snapshot(spark, root).select(F.lit("current").alias("version"), *columns))


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {}
    for level in ("system", "tin"):
        for period in ("year", "month"):
            registered[f"claims_{level}_{period}"] = partial(_flat, claims_ops.claims_summary, level, period)
            registered[f"claims_denials_{level}_{period}"] = partial(_flat, claims_ops.claims_denials, level, period)
            registered[f"claims_documents_{level}_{period}"] = partial(_document_text, level, period)
    registered.update(
        claims_grouping_sets=claims_grouping_sets,
        segment_full_outer=segment_full_outer,
        calls_by_lob=partial(_calls, call_volume_by_lob),
        calls_by_question=partial(_calls, call_metrics_by_question),
        selfservice_monthly=selfservice_monthly,
        selfservice_final=selfservice_final,
        pcor_extract=pcor,
        provider_tin_list=tin_list,
        user_provider_association=user_association,
        provider_history_load=provider_history_load,
        provider_key_list=key_list,
        key_list_refresh=key_list_refresh,
        format_tin=partial(_tins, "reference"),
        format_tin_padded=partial(_tins, "padded"),
        duplicate_keys=duplicates,
        latest_per_key=latest,
        distinct_rows=distinct_rows,
        rolling_12_months=rolling_year,
        month_index=months,
        clean_numbers=clean_numbers,
        clean_strings=clean_strings,
        clean_dates=clean_dates,
        md5_hash=md5_hash,
        run_sql=sql_text,
        csv_typed_scan=csv_typed_scan,
        json_roundtrip=json_roundtrip,
        parquet_roundtrip=parquet_roundtrip,
        partitioned_write=partitioned_write,
        append_write=append_write,
        register_external_table=external_table,
        snapshot_publish=snapshot_publish,
        pass_years=pass_years,
        save_error_if_exists=save_error_if_exists,
        save_default_format=save_default_format,
    )
    for key, branch in _BRANCHES.items():
        registered[key] = partial(_branch, branch)
    return registered
