"""Ranked lexical search of a query set against all documents, by dense matrix products.

The distinct terms of the items are the columns. A tile of documents becomes a dense
matrix of integer impacts, a block of items a dense matrix of integer weights, and
their product in float64 gives the scores of all its pairs. A product runs over
``_TILE_TERMS`` terms at a time, so that a partial sum stays below 2**53 and is exact;
partial sums are added as 64-bit integers. Every tile keeps the best documents per
item, ties by the smaller id, and these are merged by task, by bucket and at last by item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Documents and terms of a tile.
_TILE_DOCS, _TILE_TERMS = 256, 4096
#: Cells of the weight matrix of one block of items (64 MB); more items make more blocks. One item is never cut.
_BLOCK_CELLS = 8_000_000
#: Bytes of a text that are cut into words at once.
_CHUNK = 1_000_000
#: Buckets that merge their tasks' best documents before one item's are merged.
_BUCKETS = 64
_NO_TERM, _NO_WORDS = -1, -2

#: Separators (all of ASCII but digits and letters) become blanks, A-Z lower case; other bytes stay.
_CLEAN = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def words(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about a megabyte."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_CLEAN)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _CHUNK)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class _Block:
    """Items of one pass over the documents: their numbers, terms and, once the corpus is counted, weights."""

    def __init__(self):
        self.items: list[int] = []
        self.terms: dict[bytes, int] = {}
        self.columns: list[np.ndarray] = []  # term numbers of each item

    def fits(self, new: set[bytes]) -> bool:
        return not self.items or (len(self.items) + 1) * (len(self.terms) + len(new - self.terms.keys())) <= _BLOCK_CELLS

    def add(self, item: int, found: set[bytes]) -> None:
        self.items.append(item)
        self.columns.append(np.array(sorted(self.terms.setdefault(t, len(self.terms)) for t in found), np.int64))

    def weights(self, documents: int, holding: np.ndarray) -> np.ndarray:
        term = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.float64)
        matrix = np.zeros((len(self.items), len(self.terms)))
        for row, columns in enumerate(self.columns):
            matrix[row, columns] = term[columns]
        return matrix


def _blocks(items: DataFrame) -> Iterator[tuple[_Block, list[object]]]:
    """Items in blocks, read one by one; the second part holds the ids of the block's items."""
    block, ids = _Block(), []
    for row in items.toLocalIterator(prefetchPartitions=True):
        found = {w for part in words(row["text"]) for w in part}
        if not found:
            continue
        if not block.fits(found):
            yield block, ids
            block, ids = _Block(), []
        block.add(len(ids), found)
        ids.append(row["item"])
    if ids:
        yield block, ids


def _tiles(column: pa.Array, terms: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Tiles of documents: first row, words of each, and (document, term, occurrences) of every known term in them."""
    texts = column.to_pylist()
    known = terms.get
    for first in range(0, len(texts), _TILE_DOCS):
        tile = texts[first : first + _TILE_DOCS]
        lengths, cells = np.zeros(len(tile), np.int64), []
        for doc, text in enumerate(tile):
            for part in words(text):
                lengths[doc] += len(part)
                hits = np.array([t for t in map(known, part) if t is not None], np.int64)
                cells.append(hits + doc * len(terms))
        hits = np.concatenate(cells) if cells else np.empty(0, np.int64)
        if len(tile) * len(terms) <= _BLOCK_CELLS:
            counts = np.bincount(hits)
            keys = np.flatnonzero(counts)
            tf = counts[keys]
        else:  # a block of one long item: sorting takes less memory than a counter per cell
            keys, tf = np.unique(hits, return_counts=True)
        yield first, lengths, keys // len(terms), keys % len(terms), tf


def _corpus_counts(docs: DataFrame, block: _Block) -> tuple[int, int, np.ndarray]:
    """Documents with words, their words in all, and how many hold each term: summed per task, then by Spark."""
    terms = block.terms

    def count(batches):
        documents = total = 0
        holding = np.zeros(len(terms), np.int64)
        for batch in batches:
            for _, lengths, _, term, _ in _tiles(batch.column(0), terms):
                documents += int(np.count_nonzero(lengths))
                total += int(lengths.sum())
                holding += np.bincount(term, minlength=len(terms))
        seen = np.flatnonzero(holding)
        key = np.concatenate([seen, [_NO_TERM, _NO_WORDS]])
        n = np.concatenate([holding[seen], [documents, total]])
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(n, pa.int64())], ["term", "n"])

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    holding, found = np.zeros(len(terms), np.int64), {_NO_TERM: 0, _NO_WORDS: 0}
    for row in sums.collect():  # a row per term of the block
        if row["term"] < 0:
            found[row["term"]] = row["n"]
        else:
            holding[row["term"]] = row["n"]
    return found[_NO_TERM], found[_NO_WORDS], holding


def _scores(weights: np.ndarray, norm: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Scores of all pairs of a tile, items by documents, exactly."""
    impact = 1_000_000_000 * tf // (1000 * tf + 20 * norm[doc])
    total = np.zeros((len(weights), len(norm)), np.int64)
    order = np.argsort(term, kind="stable")
    doc, term, impact = doc[order], term[order], impact[order]
    at = np.searchsorted(term, np.arange(0, weights.shape[1] + _TILE_TERMS, _TILE_TERMS))
    for k, (low, high) in enumerate(zip(at[:-1], at[1:], strict=True)):
        if low == high:
            continue
        # A column per term that the tile's documents hold.
        columns, inverse = np.unique(term[low:high], return_inverse=True)
        dense = np.zeros((len(columns), len(norm)))
        dense[inverse, doc[low:high]] = impact[low:high]
        rows = weights[:, columns]
        # Impacts are below 10**6, so this holds for any weight below 2,000,000, far beyond 1000 * ln(2**64).
        assert rows.max(initial=0) * 1e6 * len(columns) < 2**53
        total += (rows @ dense).astype(np.int64)
    return total


def _best(score: np.ndarray, unnamed: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by id, documents without an id last."""
    if len(score) > k:
        limit = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= limit)
    else:
        keep = np.arange(len(score))
    order = np.lexsort((ids[keep], unnamed[keep], -score[keep]))
    return keep[order[:k]]


def _search(docs: DataFrame, block: _Block, k: int) -> DataFrame:
    """``(item, doc, score)``: the best documents of each task for every item of the block."""
    documents, total, holding = _corpus_counts(docs, block)
    if not documents:
        return docs.sparkSession.createDataFrame([], "item int, doc long, score long")
    shared = docs.sparkSession.sparkContext.broadcast((block.terms, block.weights(documents, holding)))

    def search(batches):
        terms, weights = shared.value
        held = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)) for _ in weights]  # scores, unnamed, ids
        floor = np.zeros(len(weights), np.int64)  # what a document must exceed or equal
        for batch in batches:
            column = batch.column(0)
            unnamed = column.is_null().to_numpy(zero_copy_only=False)
            ids = column.fill_null(0).to_numpy(zero_copy_only=False)
            for first, lengths, doc, term, tf in _tiles(batch.column(1), terms):
                # Products in Python's integers where 64 bits might not hold them.
                norm = np.array([50 + 50 * int(n) * documents // total for n in lengths], np.int64)
                found = _scores(weights, norm, doc, term, tf)
                for item in np.flatnonzero((found > 0).any(axis=1) & (found.max(axis=1) >= floor)):
                    at = np.flatnonzero((found[item] > 0) & (found[item] >= floor[item]))
                    score = np.concatenate([held[item][0], found[item, at]])
                    none = np.concatenate([held[item][1], unnamed[first + at]])
                    names = np.concatenate([held[item][2], ids[first + at]])
                    best = _best(score, none, names, k)
                    held[item] = (score[best], none[best], names[best])
                    floor[item] = held[item][0][-1] if len(best) == k else 0
        sizes = [len(h[0]) for h in held]
        score, none, names = (np.concatenate([h[j] for h in held]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(held)), sizes), pa.int32()), pa.array(names, pa.int64(), mask=none), pa.array(score, pa.int64())],
            ["item", "doc", "score"],
        )

    return docs.select("id", "text").mapInArrow(search, "item int, doc long, score long")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of every item, best first, ties by document id.

    Terms are runs of ASCII letters and digits (A-Z lower-cased) and all other characters
    outside ASCII. A document scores the sum over the item's distinct terms of
    weight times saturated frequency, in integers; only scores above 0 count.

    Null and empty texts have no terms; such items have no rows. Each row is an
    item or a document of its own, so repeated ids rank separately, and a
    document without an id comes after equals. Other columns are ignored; empty
    tables give an empty result. Document ids are whole numbers.

    All documents are read twice per block of items (_BLOCK_CELLS): once to count
    words, once to score.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(doc_text).alias("text"))
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"))
    kind = asked.schema["item"].dataType.simpleString()
    parts = []
    for block, ids in _blocks(asked):
        tasks = _search(base, block, k).withColumn("bucket", F.spark_partition_id() % _BUCKETS)
        best = _ranked(_ranked(tasks, ["item", "bucket"], k), ["item"], k)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, name {kind}")
        parts.append(best.join(F.broadcast(names), "item").select(F.col("name").alias(item_id), F.col("rank"), F.col("doc").alias(doc_id), "score"))
    if not parts:
        return spark.createDataFrame([], f"{item_id} {kind}, rank int, {doc_id} long, score long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
