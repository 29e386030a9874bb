"""N-gram Jaccard self-join with size-banded tiles and bitmap signatures.

Documents become sets of hashed word n-grams. Sets that are equal form one
class, and only the class representative (its smallest id) is joined further.
Two representatives can only reach the threshold if they share one of their
first ``size - ceil(t * size) + 1`` n-grams in any order common to all
documents, so each n-gram of such a prefix names a tile of documents; the order
puts n-grams that are frequent anywhere last, so that tiles stay small. Inside
a tile, sizes are banded and a pair only counts as a candidate if the bit
counts of the hashed bitmaps leave enough room for the overlap. Candidates are
decided by intersecting the sorted n-gram arrays.

What is asked for is the connected components, so pairs that are already
connected need no decision. That keeps groups of thousands of near copies
linear: first every representative meets the smallest one in each tile of its
few smallest n-gram hashes, which connects nearly all of them. What is left of such
groups is connected in rounds, in which each document of a large prefix tile
meets one other, the nearest by bitmap. Only then all pairs of the prefix tiles
are looked at, which by now are of different components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimweave.llm.graph import connected_components
from claimweave.llm.hashing import BLANKS, mix, run_hashes, text_buffers, word_hashes
from claimweave.storage import cut_lineage

#: N-grams of one task counted at once when looking for frequent ones, and the
#: local count from which one is reported. Both shape the order only.
_COUNTED, _LOCAL = 2_000_000, 3
#: N-grams in the shared list of frequent ones: a bound on the broadcast (4 MB).
_FREQUENT = 524_288
#: Smallest n-grams that a representative meets others by in the first step.
_HEADS = 8
#: How often that is done; the second time between what the first has connected.
_ROUNDS = 2
#: How often at most the large tiles then join each document to its nearest one, while that finds links.
_NEAREST_ROUNDS = 2
#: Rows of a tile up to which its pairs are sent to the bitmaps instead of the other way round.
_SMALL_TILE = 16
#: Rows of four numbers that are broadcast at most (64 MB as a hashed relation); more are shuffled.
_BROADCAST_ROWS = 1_000_000


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each row."""
    for _, data, offsets in text_buffers(column):
        words, firsts = word_hashes(data, offsets, BLANKS, lower=True)
        runs = run_hashes(words, n)
        for start, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if end - start >= n:
                grams = np.sort(runs[start : end - n + 1])
                yield grams[np.append(True, grams[1:] != grams[:-1])]
            elif end > start:
                yield run_hashes(words[start:end], end - start)
            else:
                yield np.empty(0, np.uint64)


def _bits(size: int) -> int:
    """Width of the bitmap: four to eight bits per n-gram, fewer only for very large sets."""
    return int(min(32768, 1 << max(7, (4 * size - 1).bit_length())))


def _bitmap(grams: np.ndarray) -> bytes:
    flags = np.zeros(_bits(len(grams)), np.uint8)
    flags[(mix(grams) % np.uint64(len(flags))).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _fold(bitmap: np.ndarray, width: int) -> np.ndarray:
    """The bitmap the same set has at a smaller width."""
    return np.bitwise_or.reduce(bitmap.reshape(-1, width), axis=0) if len(bitmap) > width else bitmap


def _needed(total, percent: int):
    """Smallest intersection of two sets, with ``total`` elements together, that links them."""
    return -(-total * percent // (100 + percent))


def frequent_ngrams(docs: DataFrame, text_col: str, n: int) -> np.ndarray:
    """The most frequent n-grams, at most a fixed number of them, sorted.

    Every document is counted; each task reports the n-grams that recur within
    a few million of its own. The list only shapes the order in which n-grams
    are considered, no result depends on what is in it.
    """

    def count(batches):
        held: list[np.ndarray] = []

        def found():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= _LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(grams[often].view(np.int64)), pa.array(counts[often].astype(np.int64))], ["gram", "n"]
            )

        rows, seen = 0, set()
        for batch in batches:
            for grams in _sets(batch.column(0), n):
                if len(grams) and (key := (len(grams), int(grams[0]), int(grams[-1]))) not in seen:
                    seen.add(key)  # copies within the task count once
                    held.append(grams)
                    rows += len(grams)
                if rows >= _COUNTED:
                    yield found()
                    held, rows, seen = [], 0, set()
        if held:
            yield found()

    counted = docs.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "gram").limit(_FREQUENT).select("gram").toPandas()["gram"]
    return np.sort(top.to_numpy(np.int64).view(np.uint64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and a hash of both, by which a row is found again even if many rows share its id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.withColumn("row_hash", F.xxhash64("id", "text"))


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int, last: np.ndarray) -> DataFrame:
    """Per document: id, row_hash, n_shingles, key (of the set), bits, heads, prefix, in one pass over the texts.

    ``heads`` are the smallest hashes, ``prefix`` is in the common order: n-grams
    outside ``last`` by hash, then the rest.
    """
    shared = docs.sparkSession.sparkContext.broadcast(last)

    def sign(batches):
        late = shared.value
        for batch in batches:
            size, key, bits, heads, prefix = [], [], [], [], []
            for grams in _sets(batch.column(1), n):
                size.append(len(grams))
                if not len(grams):
                    key.append(None), bits.append(None), heads.append(None), prefix.append(None)
                    continue
                key.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                bits.append(_bitmap(grams))
                heads.append(grams[:_HEADS].view(np.int64))
                keep = len(grams) - ceil(len(grams) * percent / 100) + 1
                if len(late):
                    is_late = late[np.minimum(np.searchsorted(late, grams), len(late) - 1)] == grams
                    grams = np.concatenate([grams[~is_late], grams[is_late]])
                prefix.append(grams[:keep].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array(bits, pa.binary()),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(prefix, pa.list_(pa.int64()))],
                ["id", "row_hash", "n_shingles", "key", "bits", "heads", "prefix"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _rows(docs, id_col, text_col).mapInArrow(
        sign, f"id {kind}, row_hash long, n_shingles long, key binary, bits binary, heads array<long>, prefix array<long>"
    )


def _bounded(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs that the bit counts leave possible."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))

    def bound(batches):
        for batch in batches:
            keep = [
                _possible(*row, percent)
                for row in zip(*(batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")), strict=True)
            ]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    sized = joined.where((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    return sized.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(bound, pairs.select("a", "b").schema)


def _possible(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes, percent: int) -> bool:
    a, b = np.frombuffer(bits_a, np.uint64), np.frombuffer(bits_b, np.uint64)
    width = min(len(a), len(b))
    a, b = _fold(a, width), _fold(b, width)
    only_a, only_b = int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())
    return min(n_a - only_a, n_b - only_b) >= _needed(n_a + n_b, percent)


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """Pairs of nodes whose sorted n-gram arrays intersect enough; pairs are stored rows."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = cut_lineage(wanted.join(classes, "node").select("node", "id", "row_hash"))
    if wanted.count() <= _BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = _rows(docs, id_col, text_col).join(wanted.withColumnRenamed("id", "own"), "row_hash")
    texts = texts.where("id = own").select("node", "text")

    def arrays(batches):
        for batch in batches:
            grams = [g.tobytes() for g in _sets(batch.column(1), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.binary())], ["node", "grams"])

    def decide(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                merged = np.sort(np.concatenate([a, b]), kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    grams = texts.mapInArrow(arrays, "node long, grams binary").dropDuplicates(["node"])
    side = lambda x: grams.select(F.col("node").alias(x), F.col("grams").alias(f"grams_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "grams_a", "grams_b")
    return cut_lineage(joined.mapInArrow(decide, "a long, b long"))


def _sorted_tiles(tiles: DataFrame) -> DataFrame:
    """The rows of a tile together and by size, those at home before visitors."""
    parts = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = tiles.repartition(parts, "gram", "band")
    return placed.sortWithinPartitions("gram", "band", "n_shingles", F.desc("home"), "id")


def _pair_schema(tiles: DataFrame) -> str:
    kind = tiles.schema["id"].dataType.simpleString()
    return f"a {kind}, b {kind}"


class _Earlier:
    """The rows of a tile that came before, in order of size; one matrix of bitmaps for each width."""

    def __init__(self):
        self.widths: dict[int, list] = {}

    def add(self, size: int, doc: int, component: int, words: np.ndarray) -> None:
        group = self.widths.setdefault(len(words), [0, 0, np.empty((16, len(words)), np.uint64), np.empty((4, 16), np.int64)])
        first, rows, bits, numbers = group
        if rows == len(bits):
            bits = np.concatenate([bits[first:], np.empty_like(bits)])
            numbers = np.concatenate([numbers[:, first:], np.empty_like(numbers)], axis=1)
            first, rows = 0, rows - first
        bits[rows], numbers[:, rows] = words, (size, doc, component, int(np.bitwise_count(words).sum()))
        group[:] = first, rows + 1, bits, numbers

    def possible(self, size: int, component: int, words: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of other components that the bit counts leave possible, and the share of common n-grams they leave."""
        found = [(np.empty(0, np.int64), np.empty(0))]
        for width, group in self.widths.items():
            first, rows, bits, numbers = group
            group[0] = first = first + int(np.searchsorted(numbers[0, first:rows] * 100, size * percent))
            folded = _fold(words, width)
            sizes, docs, components, ones = numbers[:, first:rows]
            both = np.bitwise_count(bits[first:rows] & folded).sum(axis=1, dtype=np.int64)
            common = np.minimum(sizes - ones, size - int(np.bitwise_count(folded).sum())) + both
            fit = (components != component) & (common >= _needed(sizes + size, percent))
            found.append((docs[fit], common[fit] / (sizes[fit] + size)))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _nearest_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """In each (gram, band) tile, every document with the nearest earlier one of another component: at most a pair a row."""

    def nearest(batches):
        tile, earlier = None, _Earlier()
        for batch in batches:
            out_a, out_b = [], []
            columns = [batch.column(c).to_pylist() for c in ("gram", "band", "n_shingles", "id", "component", "home", "bits")]
            for gram, band, size, doc, component, home, bits in zip(*columns, strict=True):
                words = np.frombuffer(bits, np.uint64)
                if (gram, band) != tile:
                    tile, earlier = (gram, band), _Earlier()
                if home:
                    others, shares = earlier.possible(size, component, words, percent)
                    if len(others):
                        x = int(others[np.argmax(shares)])
                        out_a.append(min(x, doc)), out_b.append(max(x, doc))
                earlier.add(size, doc, component, words)
            if out_a:
                kind = batch.column("id").type
                yield pa.RecordBatch.from_arrays([pa.array(out_a, kind), pa.array(out_b, kind)], ["a", "b"])

    return _sorted_tiles(tiles).mapInArrow(nearest, _pair_schema(tiles)).distinct()


def _tile_pairs(tiles: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different components within each (gram, band) tile, by bit counts where there are bits.

    Rows arrive sorted by tile and size. Of a tile's earlier rows only those are
    looked at whose size can still reach the present one.
    """

    def compare(batches):
        tile, held, earlier = None, [], _Earlier()  # of the open tile, without and with bitmaps
        seen: set[tuple] = set()  # a pair meets in many tiles; a task reports it once while it remembers
        for batch in batches:
            out_a, out_b = [], []
            columns = [batch.column(c).to_pylist() for c in ("gram", "band", "n_shingles", "id", "component", "home", "bits")]
            for gram, band, size, doc, component, home, bits in zip(*columns, strict=True):
                if (gram, band) != tile:
                    tile, held, earlier = (gram, band), [], _Earlier()
                if bits:
                    words = np.frombuffer(bits, np.uint64)
                    others = earlier.possible(size, component, words, percent)[0].tolist() if home else ()
                    earlier.add(size, doc, component, words)
                else:
                    others = [x for n_x, x, other in held if other != component and n_x * 100 >= size * percent] if home else ()
                    held.append((size, doc, component))
                for x in others:
                    pair = (min(x, doc), max(x, doc))
                    if pair not in seen:
                        seen.add(pair)
                        out_a.append(pair[0]), out_b.append(pair[1])
            if len(seen) > 200_000:
                seen.clear()
            if out_a:
                kind = batch.column("id").type
                yield pa.RecordBatch.from_arrays([pa.array(out_a, kind), pa.array(out_b, kind)], ["a", "b"])

    return _sorted_tiles(tiles).mapInArrow(compare, _pair_schema(tiles)).distinct()


def _placed(reps: DataFrame, components: DataFrame) -> DataFrame:
    """``(id, component)`` of every representative; one without links is its own."""
    found = reps.select("id").join(components.withColumnRenamed("node", "id"), "id", "left")
    return found.select("id", F.coalesce("component", "id").alias("component"))


def _hub_pairs(reps: DataFrame, joined: DataFrame) -> DataFrame:
    """In each tile of a smallest n-gram, the first of every component with the first of the smallest component.

    That is linear in the tile, and enough to connect near copies of one text:
    they share a smallest n-gram with it almost surely.
    """
    heads = reps.select("id", F.explode("heads").alias("gram")).join(joined, "id")
    members = heads.groupBy("gram", "component").agg(F.min("id").alias("id"), F.max("id").alias("last"))
    hubs = members.groupBy("gram").agg(F.min(F.struct("component", "id", "last")).alias("hub"), F.max("component").alias("high"))
    met = members.join(hubs.where("hub.component < high"), "gram").where("component <> hub.component")
    ends = F.explode(F.array("id", "last"))
    pairs = met.select("hub", ends.alias("x")).select("x", F.explode(F.array("hub.id", "hub.last")).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open(rows: DataFrame, *tile: str) -> DataFrame:
    """Rows of the tiles that hold more than one component."""
    over = Window.partitionBy(*tile)
    ends = rows.withColumn("low", F.min("component").over(over)).withColumn("high", F.max("component").over(over))
    return ends.where("low < high").drop("low", "high")


def _banded(places: DataFrame, joined: DataFrame) -> DataFrame:
    """The places in open (gram, band) tiles, stored, with the component now known and the rows of the tile."""
    tile = ("gram", "band")
    rows = _open(places.join(joined, "id"), *tile).withColumn("rows", F.count("*").over(Window.partitionBy(*tile)))
    return cut_lineage(rows.select(*tile, "n_shingles", "id", "component", "home", "rows"))


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80
) -> DataFrame:
    """``(id, n_shingles, class_id, component_id, kept, row_hash)`` for every row of ``docs``.

    Words are runs of non-blank bytes with A-Z lower-cased; a document's set is
    its distinct ``n``-word shingles, or its whole word sequence if shorter.
    Documents link when 100 * intersection >= percent * union. ``class_id`` is
    the smallest id with the same set, ``component_id`` the smallest id
    reachable by links. ``kept`` marks one row of each component (and its exact
    repeats), every row without words and every row without an id; ``row_hash``
    is ``xxhash64`` of id and text. N-grams are compared by 64-bit hashes.

    Null texts and texts without words have size 0, link with nothing and are
    their own class. Rows that repeat an id are judged each by its own text; rows
    without an id join nothing but may be copies of a row with one, whose ids
    they then show, else null. Other columns are ignored.
    """
    last = frequent_ngrams(docs, text_col, n)
    signed = cut_lineage(signatures(docs, id_col, text_col, n, percent, last))
    named = F.when(F.col("id").isNotNull(), F.struct("id", "row_hash"))
    classes = signed.where("n_shingles > 0").groupBy("key").agg(F.min(named).alias("rep"))
    classes = classes.select("key", "rep.id", "rep.row_hash", F.monotonically_increasing_id().alias("node"))
    classes = cut_lineage(classes)  # stored, so that the numbers stay
    reps = signed.join(classes.where("id is not null").drop("key"), ["row_hash", "id"]).dropDuplicates(["node"])
    reps = cut_lineage(reps.select(F.col("node").alias("id"), "n_shingles", "bits", "heads", "prefix"))

    first = None
    joined = reps.select("id", F.col("id").alias("component"))
    for _ in range(_ROUNDS):
        near = _hub_pairs(reps, joined)
        found = _linked(cut_lineage(_bounded(near, reps, percent)), classes, docs, id_col, text_col, n, percent)
        first = found if first is None else cut_lineage(first.unionByName(found))
        joined = cut_lineage(_placed(reps, connected_components(first)))

    grams = reps.select("id", F.explode("prefix").alias("gram")).join(joined, "id")
    open_tiles = _open(grams, "gram").select("gram", "id")
    # A document is at home in the band of its own size and visits the next one.
    band = F.floor(F.log("n_shingles") / F.log(F.lit(100.0 / percent)))
    places = F.array(*(F.struct((band + k).alias("band"), F.lit(k == 0).alias("home")) for k in (0, 1)))
    banded = open_tiles.join(reps.select("id", "n_shingles"), "id").select("*", F.explode(places).alias("at"))
    banded = _banded(banded.select("gram", "at.band", "n_shingles", "id", "at.home"), joined)
    for _ in range(_NEAREST_ROUNDS):
        crowded = banded.where(F.col("rows") > _SMALL_TILE)
        near = cut_lineage(_nearest_pairs(crowded.join(reps.select("id", "bits"), "id"), percent))
        found = _linked(near, classes, docs, id_col, text_col, n, percent)
        if found.isEmpty():
            break
        first = cut_lineage(first.unionByName(found))
        joined = cut_lineage(_placed(reps, connected_components(first)))
        banded = _banded(banded.drop("component", "rows"), joined)
    # Bitmaps travel to the large tiles; from small ones it is the few pairs that travel to the bitmaps.
    small = _tile_pairs(banded.where(F.col("rows") <= _SMALL_TILE).withColumn("bits", F.lit(None).cast("binary")), percent)
    large = _tile_pairs(banded.where(F.col("rows") > _SMALL_TILE).join(reps.select("id", "bits"), "id"), percent)
    rest = cut_lineage(_bounded(cut_lineage(small), reps, percent).unionByName(large).distinct())
    second = _linked(rest, classes, docs, id_col, text_col, n, percent)
    whole = connected_components(first.unionByName(second))

    least = classes.join(whole, "node").groupBy("component").agg(F.min(F.struct("id", "row_hash")).alias("least"))
    least = whole.join(least, "component").select("node", "least")
    found = classes.join(least, "node", "left").withColumn("least", F.coalesce("least", F.struct("id", "row_hash")))
    found = found.select("key", F.col("id").alias("class_id"), "least")
    full = signed.select("id", "row_hash", "n_shingles", "key").join(found, "key", "left")
    alone = F.col("n_shingles") == 0
    first = (F.col("id") == F.col("least.id")) & (F.col("row_hash") == F.col("least.row_hash"))
    return full.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | F.col("id").isNull() | first).alias("kept"),
        "row_hash",
    )
