"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes and returns the columns of ``documents``, except the last one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm import byte_bpe, decontaminate, jaccard_join, pii, quality
from claimweave.llm.queries import BYTE_RANKS, MIN_QUALITY, PATTERN, held_out, reachable, table
from claimweave.storage import cut_lineage

#: Names of rows (id and hash) that are broadcast at most (50 MB as a hashed relation); more are shuffled.
_BROADCAST_ROWS = 500_000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose quality score is high enough; nothing learned keeps everything."""
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return quality.keep_quality(docs, labels, MIN_QUALITY)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of near copies, of its smallest id; texts that share an id are judged each by itself.

    Rows that repeat id and text count once; rows without an id stay.
    """
    reachable(spark)
    found = jaccard_join.ngram_jaccard_join(docs)

    def same(rows: DataFrame):
        return (docs["doc_id"] == rows["doc_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == rows["row_hash"])

    gone = cut_lineage(found.where("not kept").select("doc_id", "row_hash").distinct())
    kept = docs.join(F.broadcast(gone) if gone.count() <= _BROADCAST_ROWS else gone, same(gone), "left_anti")
    again = found.where("kept and doc_id is not null").groupBy("doc_id", "row_hash").count().where("count > 1")
    again = cut_lineage(again.select("doc_id", "row_hash"))
    if again.isEmpty():
        return kept
    once = kept.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(again, same(again), "left_anti").unionByName(once)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind; n_chars follows the text."""
    reachable(spark)
    hidden = pii.find_pii(docs, redact=True)
    return hidden.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text, their hash and the hash of what they decode to."""
    reachable(spark)
    return byte_bpe.encode_documents(docs, BYTE_RANKS, PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", without_benchmarks),
    ("pii", without_pii),
    ("byte_bpe", token_ids),
]

#: SQL cannot fit the classifier nor merge byte pairs; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
