"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import (
    byte_bpe,
    conversation_repair,
    decontaminate,
    embedding_dedup,
    html_extract,
    jaccard_join,
    language_id,
    oracle,
    pii,
    quality,
    ranked_search,
    substring_dedup,
    token_records,
    url_filter,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Documents with this remainder are held out of all learning.
_FOLDS, _HELD_OUT = 4, 2
MIN_QUALITY = 0.7


#: Rows of an Arrow batch unless the session was started with another number. Spark's default of 10,000
#: whole texts takes tens of megabytes, several times over, in each task and its worker.
_BATCH_ROWS, _BATCH_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def reachable(spark: SparkSession) -> None:
    """Set the session up: workers can import this library wherever it was started, and batches of texts are small."""
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(_BATCH_ROWS))
    here = str(Path(__file__).resolve().parents[2])
    workers = spark.sparkContext.environment
    path = workers.get("PYTHONPATH", "")
    if here not in path.split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(p for p in (here, path) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % _FOLDS == _HELD_OUT


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.ngram_jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_records(table(spark, sf_dir, "documents"), WORD_BPE)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), BYTE_RANKS, PATTERN, with_ids=False)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify_language(docs, docs.where(~held_out()))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    scored = quality.score_quality(table(spark, sf_dir, "documents"), labels)
    predicted = F.when(F.col("score") >= MIN_QUALITY, 1).otherwise(0)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(damaged, present=F.col("present"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_ngram_jaccard,
            op2_embedding_dedup,
            op3_decontamination,
            op4_substring_dedup,
            op5_html_extraction,
            op6_token_records,
            op7_byte_bpe,
            op8_pii,
            op9_language_id,
            op10_quality,
            op11_ranked_search,
            op12_url_filter,
            op13_conversation_repair,
        )
    }


#: Decontamination in the checking engine's SQL, by windows of words instead of hashes.
_OP3 = r"""
with words as materialized (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
    from documents
), items as materialized (
    select item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
    from benchmark where text is not null and item_id is not null
), known as materialized (
    select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as piece
    from (select item_id, w, least(len(w), 10) as size, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
          from items where len(w) > 0)
), probes as (
    select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as piece
    from (select doc_id, w, size, unnest(range(1, greatest(len(w) - size + 2, 1))) as i
          from words cross join (select distinct size from known))
), hits as materialized (
    select p.doc_id, p.i, p.size, k.item_id from probes p join known k on p.piece = k.piece and p.size = k.size
), covered as (
    select doc_id, count(distinct j) as n_hit
    from (select distinct doc_id, unnest(range(i, i + size)) as j from hits) group by doc_id
), found as (
    select doc_id, count(distinct item_id) as n_items,
        string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
    from hits group by doc_id
)
select w.doc_id, len(w.w) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(f.n_items, 0) as n_items,
    sha256(coalesce(f.names, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from words w left join covered c using (doc_id) left join found f using (doc_id)
"""


#: Ranked search by joining terms instead of multiplying tiles.
_OP11 = r"""
with doc_words as materialized (
    select doc_id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) as term
    from documents
), lengths as materialized (
    select doc_id, count(*) as n from doc_words group by doc_id
), corpus as materialized (
    select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as words from lengths
), wanted as materialized (
    select distinct item_id, unnest(list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) as term
    from benchmark
), frequencies as materialized (
    select doc_id, term, count(*) as tf from doc_words
    where term in (select term from wanted) group by doc_id, term
), weights as materialized (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
    from frequencies, corpus group by term, docs
), scored as (
    select q.item_id, f.doc_id,
        cast(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * l.n * c.docs) // c.words)))) as bigint) as score
    from wanted q join frequencies f using (term) join weights w using (term) join lengths l using (doc_id), corpus c
    group by q.item_id, f.doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scored where score > 0
qualify rank <= 50
"""

#: URL filters with window counts instead of joins.
_OP12 = r"""
with rests as (
    select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), urls as materialized (
    select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from rests
), rules(verdict, rule, site, begins) as (
    values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
        ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
        ('block', 'net/fr/', 'net', '/fr/')
), different as materialized (
    select host, path, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
    from (select distinct host, path from urls)
    left join rules on (host = site or ends_with(host, '.' || site)) and starts_with(path, begins)
    group by host, path
), cells as (
    select *, count(*) over (partition by host, pos) as total, count(*) over (partition by host, pos, segment) as n
    from (select host, path, unnest(parts) as segment, generate_subscripts(parts, 1) as pos
          from (select host, path, list_filter(string_split(path, '/'), lambda s: s <> '') as parts from different))
), shapes as (
    select host, path, string_agg(case when n >= 2 and n * 20 >= total then segment else '*' end, '/' order by pos) as template,
        string_agg(case when pos = last then '{}' when n >= 2 and n * 20 >= total then segment else '*' end, '/' order by pos) as family
    from (select *, max(case when n >= 2 and n * 20 >= total then pos end) over (partition by host, path) as last from cells)
    group by host, path
), templates as materialized (
    select d.host, d.path, d.verdict, coalesce(s.template, '') as template, coalesce(s.family, '') as family
    from different d left join shapes s using (host, path)
), counted as (
    select host, family, template, cast(count(verdict) as double) as n,
        cast(count(*) filter (verdict = 'block') as double) as b
    from templates group by host, family, template having count(verdict) > 0
), lagged as (
    select *, lag(n) over w as n0, lag(b) over w as b0 from counted window w as (partition by host, family order by b / n, template)
), numbered as (
    select *, sum(case when (b * n0 - b0 * n) * (b * n0 - b0 * n) * (n + n0) > 4.0 * (b + b0) * (n + n0 - (b + b0)) * n * n0
        then 1 else 0 end) over (partition by host, family order by b / n, template rows unbounded preceding) as branch
    from lagged
), rejected as (
    select host, template from numbered
    qualify (sum(b) over (partition by host, family, branch) + 1.0) / (sum(n) over (partition by host, family, branch) + 2.0) >= 0.8
)
select u.page_id, u.host, u.path, t.rule,
    coalesce(t.verdict, case when exists (select 1 from rejected r where r.host = t.host and r.template = t.template)
        then 'block' else 'allow' end) as verdict
from urls u join (select t.*, d.rule from templates t join different d using (host, path)) t using (host, path)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that SQL expresses in reasonable time; the tests hold the others against plain Python."""
    return {
        "op1_ngram_jaccard": oracle.NGRAM_JACCARD,
        "op2_embedding_dedup": oracle.EMBEDDING_DEDUP,
        "op3_decontamination": _OP3,
        "op4_substring_dedup": oracle.SUBSTRING_DEDUP,
        "op11_ranked_search": _OP11,
        "op12_url_filter": _OP12,
        "op13_conversation_repair": oracle.CONVERSATION_REPAIR,
    }
