"""The generic test tables, read as the tables the operators work on.

Each template is one SELECT over whole tables. ``$text`` is the string type,
``$q`` the quote of a name, ``$call_day`` a date as ``yyyyMMdd`` text,
``$value_text`` a number as text, ``$digit_limits`` one row per limit and
``$ordered_items`` the items with their orders and customers, so that
the same mapping can be run by Spark and by the engine that checks it.
"""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DIGIT_LIMITS = ", ".join(str(10**digits) for digits in (1, 3, 4, 5, 6, 7, 8, 9, 10))

SPARK = {
    "text": "string",
    "q": "`",
    "digit_limits": f"explode(array({DIGIT_LIMITS}))",
    # Spelled as the checking engine spells them; the other numbers read back alike from either spelling.
    "value_text": """case cast(value as string) when 'NaN' then 'nan' when 'Infinity' then 'inf' when '-Infinity' then '-inf'
                   else cast(value as string) end""",
    # Orders are few against their items: they meet the customers first, so that the items are shuffled once.
    "ordered_items": "{lineitem} join ({orders} join {customer} on o_custkey = c_custkey) on l_orderkey = o_orderkey",
    "call_day": "date_format(date_sub(cast(ts as date), cast(event_id % 3 * 200 as int)), 'yyyyMMdd')",
}

TEMPLATES = {
    "lookup": """
        select tin, mpin, tinname, healthcareorganizationname, providersyskey, health_system_id,
               case length(cast(tin as $text))
                 when 9 then concat(substr(cast(tin as $text), 1, 2), '-', substr(cast(tin as $text), 3))
                 when 8 then concat('0', substr(cast(tin as $text), 1, 1), '-', substr(cast(tin as $text), 2))
                 when 7 then concat('0-', cast(tin as $text))
                 else concat('0-0', cast(tin as $text)) end as formattedtin
        from (select s_suppkey as tin, s_suppkey as mpin, s_name as tinname,
                     n_name as healthcareorganizationname, s_nationkey as providersyskey,
                     cast(n_regionkey as $text) as health_system_id
              from {supplier} join {nation} on s_nationkey = n_nationkey) s
    """,
    "claims": """
        select l_suppkey as providertin,
               cast(l_shipdate as date) as IncurredServiceDate,
               case c_mktsegment when 'AUTOMOBILE' then 'E&I' when 'BUILDING' then 'M&R'
                 when 'FURNITURE' then 'C&S' when 'HOUSEHOLD' then null else c_mktsegment end
                 as BusinessSegmentIdentifier,
               case l_returnflag when 'R' then 'D' else 'P' end as PaidOrDeniedCode,
               case l_linestatus when 'F' then 'Y' else 'N' end as FinalPassIndicator,
               o_orderpriority as ClaimDenialCategoryLevel1ShortName,
               l_linenumber as masteridclaimcount,
               cast(l_extendedprice as decimal(12,2)) as UHCPaidAmount,
               cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
                 as EstimatedAllowedSelectDeniedAmount,
               cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
                 as ActualAllowedAmount,
               cast(l_extendedprice as decimal(12,2)) * (1 + cast(l_tax as decimal(4,2))) as BilledAmount
        from $ordered_items
    """,
    "calls": """
        select user_id as tin,
               $call_day as calldate,
               case event_type when 'click' then 'E&I' when 'view' then 'M&R' when 'error' then 'C&S'
                 else 'OTH' end as lob_id,
               case event_id % 5 when 0 then 'Benefits' when 1 then 'Claims' when 2 then 'Others'
                 when 3 then 'Prior Auth' else 'Misc' end as questionType,
               event_id % 5 + 1 as callVolume,
               cast(value as decimal(18,2)) as handleTime
        from {events}
    """,
    "selfservice": """
        select user_id as tax_id,
               cast(floor((24288 - event_id % 6) / 12) as int) as year,
               cast((24288 - event_id % 6) % 12 + 1 as int) as month,
               case when event_type in ('click', 'error') then 'clm_proc' else 'txn' end as ${q}table${q},
               case event_id % 6 when 0 then '1-month' else '3-month' end as data_coverage,
               case event_type when 'click' then 'Paper' when 'error' then 'Electronic' when 'view' then 'calls'
                 when 'signup' then case event_id % 3 when 0 then 'Payer' else 'PnP_elec' end
                 else case event_id % 3 when 0 then 'EDI276' else 'PnP_paper' end end as channel,
               case when event_type in ('click', 'error')
                      then case cast(floor(event_id / 6) as bigint) % 2 when 0 then 'ORIGINAL' else 'ADJUSTMENT' end
                    when event_type = 'view'
                      then case cast(floor(event_id / 6) as bigint) % 7 when 0 then 'APL' when 1 then 'ATH'
                             when 2 then 'BEN' when 3 then 'CLM' when 4 then 'ELI' when 5 then 'MIS'
                             else 'Others' end
                    when event_type = 'signup'
                      then case event_id % 2 when 0 then 'ClaimPaper' else 'EligEDI' end
                    else 'X' end as txn,
               cast(value as decimal(18,2)) as avg_proc_time,
               event_id % 7 as clm_count,
               event_id % 11 as txn_cnt
        from {events}
    """,
    "pcor": """
        select c_mktsegment as claims_thru_dt,
               cast(n_regionkey as $text) as Health_System_ID,
               n_name as Health_System_Name,
               cast(count(*) as int) as Total_Provider_Group_Count,
               cast(sum(case when c_acctbal > 0 then 1 else 0 end) as int) as Total_Patient_Count,
               cast(sum(case when c_acctbal > 2000 then 1 else 0 end) as int) as Total_Diabetic_Patients,
               cast(sum(case when c_acctbal > 4000 then 1 else 0 end) as int) as Total_ACVs,
               cast(sum(case when c_acctbal > 6000 then 1 else 0 end) as int) as Total_Diabetic_ACVs,
               max(c_acctbal) / 2000 as Average_Star_Rating,
               cast(sum(case when c_acctbal <= 1000 then 1 else 0 end) as int) as ${q}1_Star_Measure_Count${q},
               cast(sum(case when c_acctbal <= 3000 then 1 else 0 end) as int) as ${q}2_Star_Measure_Count${q},
               cast(sum(case when c_acctbal <= 5000 then 1 else 0 end) as int) as ${q}3_Star_Measure_Count${q},
               cast(sum(case when c_acctbal <= 7000 then 1 else 0 end) as int) as ${q}4_Star_Measure_Count${q},
               cast(sum(case when c_acctbal <= 9000 then 1 else 0 end) as int) as ${q}5_Star_Measure_Count${q}
        from {customer} join {nation} on c_nationkey = n_nationkey
        group by c_mktsegment, n_regionkey, n_name
    """,
    "users": """
        select c_nationkey as Providersyskey, n_name as Healthcareorganizationname, c_name as userID,
               case when c_acctbal < 0 then 'ADMIN' else 'VIEWER' end as roles
        from {customer} join {nation} on c_nationkey = n_nationkey
    """,
    "history": """
        select 1000000 * (c_nationkey % 7) + c_custkey as tin, c_custkey as mpin,
               concat('  ', c_name, ' ') as tinname, concat(n_name, '  ') as healthcareorganizationname,
               c_nationkey as providersyskey, concat('HS', cast(n_regionkey as $text)) as health_system_id,
               c_mktsegment as pcorname, '2018-06' as claimsthrudate
        from {customer} join {nation} on c_nationkey = n_nationkey
    """,
    "existing": """
        select 100000000 + s_suppkey as tin, case s_suppkey % 4 when 0 then null else s_suppkey end as mpin,
               s_name as tinname, n_name as healthcareorganizationname,
               cast(1000000 + s_nationkey as int) as providersyskey,
               case s_nationkey % 3 when 0 then null else concat('HS', cast(s_nationkey as $text)) end
                 as health_system_id,
               concat(substr(cast(100000000 + s_suppkey as $text), 1, 2), '-',
                      substr(cast(100000000 + s_suppkey as $text), 3)) as formattedtin,
               'PCOR' as pcorname, '2018-01' as claimsthrudate, '2018-07-31 12:30:00' as refresh_date
        from {supplier} join {nation} on s_nationkey = n_nationkey
        union all
        select 100000000 + p_partkey, p_partkey, p_name,
               concat('Group ', cast(cast(floor(p_partkey / 50) as bigint) as $text)),
               cast(floor(p_partkey / 50) as int) + 1,
               case p_size % 2 when 0 then null else p_type end,
               concat(substr(cast(100000000 + p_partkey as $text), 1, 2), '-',
                      substr(cast(100000000 + p_partkey as $text), 3)),
               null, '2018-01', '2018-07-31 09:00:00'
        from {part}
    """,
    "incoming": """
        select case c_custkey % 8
                 when 0 then 200000000 + c_custkey
                 when 1 then 210000000 + cast(floor(c_custkey / 16) as bigint)
                 when 2 then 100000000 + c_custkey
                 when 3 then 100000000 + c_custkey
                 when 4 then 300000000 + c_custkey
                 when 5 then 310000000 + cast(floor(c_custkey / 16) as bigint)
                 when 6 then 100000000 + c_custkey - case c_custkey % 16 when 6 then 3 else 0 end
                 else 400000000 + c_custkey end as tin,
               case c_custkey % 3 when 0 then null else c_custkey end as mpin,
               c_name as tinname,
               case c_custkey % 8
                 when 3 then concat('Group ', cast(cast(floor(c_custkey / 50) as bigint) as $text))
                 when 4 then concat('NewOrg 4-', cast(cast(floor(c_custkey / 100) as bigint) as $text))
                 when 5 then concat('NewOrg 5-', cast(cast(floor(c_custkey / 100) as bigint) as $text))
                 when 6 then concat('NewOrg 6-', cast(cast(floor(c_custkey / 100) as bigint) as $text))
                 when 7 then case c_custkey % 16 when 7 then concat('NewOrg ', cast(c_nationkey as $text))
                               else concat(' neworg ', cast(c_nationkey as $text), ' ') end
                 else concat(' ', 'group ', cast(cast(floor(c_custkey / 50) as bigint) as $text), ' ') end
                 as healthcareorganizationname,
               case c_custkey % 5 when 0 then null else concat('IN', cast(c_custkey % 5 as $text)) end
                 as health_system_id,
               case c_custkey % 2 when 0 then null else c_mktsegment end as pcorname,
               '2018-06' as claimsthrudate
        from {customer}
    """,
    "tins": """
        select distinct cast((o_orderkey * 7919 + 1) * 1000003 % below as bigint) as tin
        from (select o_orderkey, $digit_limits as below from {orders}) t
    """,
    "raw_text": """
        select event_id,
               case event_id % 7 when 0 then '' when 1 then null when 2 then concat('x', cast(event_id as $text))
                 when 3 then concat(' ', cast(event_id as $text), ' ') when 4 then concat('-', cast(event_id as $text))
                 when 5 then concat(cast(event_id as $text), '000000000') else cast(event_id as $text) end as number_text,
               case event_id % 23 when 0 then 'NaN' when 1 then 'nan' when 2 then 'Infinity' when 3 then '-Infinity'
                 when 4 then 'inf' when 5 then '1e3' when 6 then '2d' when 7 then ' 2.5 ' when 8 then '.5E-2f'
                 when 9 then '' when 10 then null when 11 then 'x' when 12 then '1e' when 13 then '+7.'
                 else $value_text end as amount_text,
               case event_id % 17 when 0 then '' when 1 then null when 2 then 'soon' when 3 then '32/01/2018'
                 when 4 then '5/3/2018' when 5 then '05/03/2018 10:00' when 6 then '01/13/2018' when 7 then '0/0/2018'
                 when 8 then ' 7/ 8/2019' when 9 then '2018-03-05' when 10 then '29/02/2019' when 11 then '31/12/99999'
                 else concat(substr(cast(cast(ts as date) as $text), 9, 2), '/',
                             substr(cast(cast(ts as date) as $text), 6, 2), '/',
                             substr(cast(cast(ts as date) as $text), 1, 4)) end as date_text
        from {events}
    """,
}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its footer is opened for the schema once, not per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The logical table ``name`` over the Parquet tables of ``sf_dir``."""
    text = Template(TEMPLATES[name]).substitute(SPARK)
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})
