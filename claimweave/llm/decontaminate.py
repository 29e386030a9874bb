"""Benchmark decontamination with DataFrame functions only.

The benchmark's word windows become a table of hashes that is broadcast once
its size has been checked; one that is too large meets narrow rows of hashes in a shuffle. Each document is split into words and hashed in one
scan, every window start is probed against the table, and hits are verified by
comparing the words themselves. A document's hits meet again in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweave.storage import cut_lineage

#: Separators of words: every ASCII character but digits and letters.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Benchmark windows that are broadcast at most; a larger table is shuffled.
_BROADCAST_ROWS = 1_000_000


def _words(text: Column) -> Column:
    """Words as written, without the empty strings at either end."""
    parts = F.split(text, _SEPARATORS)
    size = F.size(parts)
    first = F.when(F.element_at(parts, 1) == "", 2).otherwise(1)
    empty_end = F.when((size > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, first, F.greatest(size - first + 1 - empty_end, F.lit(0)))


def _hashes(words: Column) -> Column:
    """One hash per word. Lower-casing single words covers more than A-Z, so equal windows stay equal."""
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _normal(words: Column) -> Column:
    return F.translate(F.array_join(words, " "), _UPPER, _LOWER)


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``(size, hash, window, items)``: distinct windows with the items they occur in."""
    items = benchmark.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    items = items.select(F.col(id_col).cast("string").alias("item"), _words(F.col(text_col)).alias("words"))
    items = items.withColumn("size", F.least(F.size("words"), F.lit(length))).where("size > 0")
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1))
    windows = items.select("item", "words", "size", starts.alias("start"))
    piece = F.slice("words", F.col("start"), F.col("size"))
    windows = windows.select("item", "size", _normal(piece).alias("window"), F.xxhash64(_hashes(piece)).alias("hash"))
    return windows.groupBy("size", "hash", "window").agg(F.collect_set("item").alias("items"))


def _probes(base: DataFrame, sizes: list[int], first: int) -> DataFrame:
    """Every window start from ``first`` (0 or 1) on, for every size of a window, with the hash of its words."""
    base = base.withColumn("_hashes", _hashes(F.col("_words"))).withColumn("_n", F.size("_words"))
    last = F.greatest(F.col("_n") - min(sizes) + 1, F.lit(0))
    starts = F.sequence(F.lit(first), last) if first == 0 else F.when(last > 0, F.sequence(F.lit(first), last))
    probes = base.select("*", F.explode(starts).alias("_start"))
    if len(sizes) > 1:
        probes = probes.withColumn("_size", F.explode(F.array(*(F.lit(s) for s in sizes))))
        probes = probes.where(f"_start + _size - 1 <= _n and (_start > 0 or _size = {sizes[0]}) or _start = 0 and _size = {sizes[0]}")
    else:
        probes = probes.withColumn("_size", F.lit(sizes[0]))
    piece = F.slice("_hashes", F.greatest("_start", F.lit(1)), F.col("_size"))
    return probes.withColumn("_hash", F.when(F.col("_start") > 0, F.xxhash64(piece)))


def _met_in_the_scan(base: DataFrame, table: DataFrame, sizes: list[int], with_words: bool) -> DataFrame:
    """Per row its hits, where the broadcast windows meet the words in the scan itself."""
    # Start 0 stands for the document itself, so that it stays without any hit.
    probes = _probes(base, sizes, 0)
    table = table.withColumnRenamed("size", "_found")
    met = probes.join(table, "_hash", "left").where("_start = 0 or _window is not null")
    true_hit = (F.col("_found") == F.col("_size")) & (
        _normal(F.slice("_words", F.greatest("_start", F.lit(1)), F.col("_size"))) == F.col("_window")
    )
    met = met.withColumn("_hit", (F.col("_start") > 0) & true_hit).where("_start = 0 or _hit")

    whole = F.col("_start") == 0
    return met.groupBy("_row").agg(
        F.first(F.when(whole, F.col("_kept")), ignorenulls=True).alias("_kept"),
        F.max("_n").alias("_n"),
        F.array_sort(F.collect_set(F.when(~whole, F.struct("_start", (F.col("_start") + F.col("_size") - 1).alias("stop"))))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(~whole, F.col("items")))))).alias("_items"),
        *([F.first(F.when(whole, F.col("_words")), ignorenulls=True).alias("_words")] if with_words else []),
    )


def _met_by_hash(base: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """The same by a shuffle, for windows too many to broadcast; ``base`` is stored, so that its rows keep their numbers.

    Only row, start, size and hash of a window travel to the windows of the
    benchmark; a row's hits come back together and are verified by its words.
    """
    narrow = _probes(base, sizes, 1).select("_row", "_start", "_size", "_hash")
    table = known.withColumnRenamed("size", "_size")
    hits = narrow.join(table, ["_hash", "_size"]).groupBy("_row").agg(
        F.collect_list(F.struct("_start", "_size", "_window", "items")).alias("_hits")
    )
    found = base.join(hits, "_row", "left").withColumn("_n", F.size("_words"))
    true = F.filter("_hits", lambda h: _normal(F.slice(F.col("_words"), h["_start"], h["_size"])) == h["_window"])
    kind = hits.schema["_hits"].dataType.simpleString()
    found = found.withColumn("_hits", F.coalesce(true, F.array().cast(kind)))
    spans = F.transform("_hits", lambda h: F.struct(h["_start"].alias("_start"), (h["_start"] + h["_size"] - 1).alias("stop")))
    return found.select(
        "_row", "_kept", "_n", "_words",
        F.array_sort(F.array_distinct(spans)).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["items"])))).alias("_items"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length: int = 10,
    remove: str | None = None,
) -> DataFrame:
    """Find benchmark windows of ``length`` words in documents and say or remove what was hit.

    Words are runs of digits, letters and non-ASCII characters with A-Z
    lower-cased. An item shorter than ``length`` words, but not empty, is one
    window. Without ``remove`` the result is (id, n_words, n_hit, n_items,
    items_sha256, contaminated), one row per row of ``docs``. With
    ``remove="documents"`` it is ``docs`` without the hit rows; with
    ``remove="spans"`` every hit row's text is replaced by its kept words.

    Null and empty texts have no words. Rows are judged one by one, so repeated
    rows and rows without an id each get their own verdict. Benchmark rows
    without an id or text count for nothing; an empty benchmark hits nothing.
    Extra columns are ignored, or kept when rows are returned.
    """
    if remove not in (None, "documents", "spans"):
        raise ValueError("remove must be None, 'documents' or 'spans'")
    known = benchmark_windows(benchmark, item_col, item_text_col, length)
    known = known.select("size", F.col("hash").alias("_hash"), F.col("window").alias("_window"), "items")
    facts = known.agg(F.count("*"), F.sort_array(F.collect_set("size"))).first()
    small, sizes = facts[0] <= _BROADCAST_ROWS, facts[1] or [length]

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if remove else F.struct(F.col(id_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("_row"), row.alias("_kept"), _words(text).alias("_words"))
    if small:
        per_row = _met_in_the_scan(base, F.broadcast(known), sizes, remove == "spans")
    else:
        per_row = _met_by_hash(cut_lineage(base), known, sizes)
    if remove == "documents":
        return per_row.where(F.size("_spans") == 0).select("_kept.*")
    if remove == "spans":
        inside = lambda i: F.exists("_spans", lambda s: (s["_start"] <= i + 1) & (s["stop"] >= i + 1))
        kept = F.filter("_words", lambda w, i: ~inside(i))
        clean = F.when(F.size("_spans") > 0, F.array_join(kept, " ")).otherwise(F.col(f"_kept.`{text_col}`"))
        return per_row.select(*((clean if c == text_col else F.col(f"_kept.`{c}`")).alias(c) for c in docs.columns))
    # Spans are sorted by start, so only the furthest stop so far matters.
    start = F.struct(F.lit(0).alias("stop"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "_spans", start,
        lambda acc, s: F.struct(
            F.greatest(acc["stop"], s["stop"]).alias("stop"),
            (acc["n"] + F.greatest(s["stop"] - F.greatest(acc["stop"], s["_start"] - 1), F.lit(0))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    return per_row.select(
        F.col(f"_kept.`{id_col}`").alias(id_col),
        F.col("_n").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_spans") > 0).alias("contaminated"),
    )
