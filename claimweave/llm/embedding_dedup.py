"""Embedding near-duplicates with randomised-rotation binary codes.

Every unit vector is turned by several random rotations and keeps the signs of
its coordinates, the correction factor of each code (the sum of the absolute
coordinates) and an 8-bit form of itself. The signs of one vector with the
8-bit form of another, divided by the factor, estimate their inner product
without bias, and the spread of that estimate is known from the factors. Bands
of the code bits name tiles of vectors with equal labels; inside a tile, pairs
whose estimate plus its confidence bound stays below the threshold are dropped.
Of the rest, the 8-bit forms prove most to be links or not, as their rounding is
bounded; links proven in a tile are counted there and passed on as a spanning
forest, so a group of many different near copies stays linear. Only pairs that
are still open are computed exactly from the vectors.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.graph import connected_components
from claimweave.storage import cut_lineage

#: Bits of a band and number of bands. At a cosine of 0.93 two vectors agree in a
#: bit with probability 0.88, so they miss each other in all bands with 0.4 %.
_BAND_BITS, _BANDS = 16, 40
#: Standard errors of the estimate that a dropped pair must be below the threshold.
_SIGMAS = 4.0
#: Vectors of a tile that one task holds against each other; larger tiles are cut in blocks.
_BLOCK = 512
#: More than what 32-bit arithmetic adds to the error of an inner product of unit vectors.
_FLOAT_ERROR = 1e-4
#: What a vector takes along into a tile.
_CARRIED = ("id", "code", "factors", "small", "side", "copies")


@functools.lru_cache(maxsize=8)
def _rotations(dim: int, seed: int) -> np.ndarray:
    """Independent random rotations of ``dim`` coordinates, stacked, enough for all code bits."""
    rng = np.random.default_rng([seed, dim])
    count = -(-_BAND_BITS * _BANDS // dim)
    out = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        out.append(q * np.sign(np.diag(r)))
    return np.concatenate(out, axis=1).astype(np.float32)


def _codes(vectors: DataFrame, seed: int) -> DataFrame:
    """id, label, key (of label and vector), code, factors and quantised vector of usable vectors; else null key."""

    def encode(batches):
        for batch in batches:
            keys, codes, factors, small = [], [], [], []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                v = None if vector is None or None in vector else np.asarray(vector, np.float64)
                norm = 0.0 if v is None or not len(v) or not np.isfinite(v).all() else np.linalg.norm(v / np.abs(v).max()) if v.any() else 0.0
                if label is None or not norm:
                    keys.append(None), codes.append(None), factors.append(None), small.append(None)
                    continue
                v = v + 0.0  # one zero
                unit = v / np.abs(v).max() / norm
                turned = (unit.astype(np.float32) @ _rotations(len(v), seed)).reshape(-1, len(v))
                step = float(np.abs(unit).max()) / 127
                keys.append(hashlib.blake2b(repr(label).encode() + b":" + v.tobytes(), digest_size=16).digest())
                codes.append(np.packbits(turned.ravel() >= 0).tobytes())
                factors.append(np.abs(turned).sum(1).astype(np.float32).tobytes())
                small.append(np.float32(step).tobytes() + np.rint(unit / step).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.binary()) for x in (keys, codes, factors, small))],
                ["id", "label", "key", "code", "factors", "small"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(
        encode, f"id {kinds['id']}, label {kinds['label']}, key binary, code binary, factors binary, small binary"
    )


def _estimates(code_a, factor_a, small_b, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of every a with every b as estimated, and their standard errors (one per a)."""
    dim = small_b.shape[1]
    turned = small_b @ _rotations(dim, seed)
    signs = code_a * np.float32(2) - np.float32(1)
    rounds = factor_a.shape[1]
    weighted = signs.reshape(len(signs), rounds, dim) / factor_a[:, :, None] / rounds
    aligned = factor_a / np.sqrt(dim)  # inner product of a code with its own vector
    spread = np.sqrt((1 / aligned**2 - 1).clip(0) / max(dim - 1, 1)).mean(1) / np.sqrt(rounds)
    return weighted.reshape(len(signs), -1) @ turned.T, spread


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches over the links from ``x`` to ``y``."""
    root = np.arange(n)
    while True:
        low, new = np.minimum(root[x], root[y]), root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _tile_links(tiles: DataFrame, threshold: float, seed: int) -> DataFrame:
    """What the tiles know, each pair judged in the first band that both share.

    Rows are ``(a, b, n)``: an open pair without ``n``; an edge of the forest of
    proven links with ``n`` 0; or, without ``b``, the vectors that ``a`` is proven to link with.
    """
    kind = tiles.schema["id"].dataType.simpleString()

    def pairs(rows: list[tuple], band: int, cross: bool):
        ids = np.array([r[0] for r in rows], object)
        side = np.array([r[4] for r in rows])
        packed = np.stack([np.frombuffer(r[1], np.uint8) for r in rows])
        small = np.stack([np.frombuffer(r[3], np.int8, offset=4) * np.frombuffer(r[3], np.float32, 1)[0] for r in rows])
        copies = np.array([r[5] for r in rows], np.float64)
        dim = small.shape[1]
        factor = np.stack([np.frombuffer(r[2], np.float32) for r in rows])
        bits = np.unpackbits(packed, axis=1, count=factor.shape[1] * dim)
        words = packed[:, : _BAND_BITS * _BANDS // 8].reshape(len(rows), _BANDS, _BAND_BITS // 8)
        a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(rows)),) * 2
        if not len(a) or not len(b):
            return []
        guess, spread = _estimates(bits[a], factor[a], small[b], seed)
        rounding = np.abs(small).max(1) / 127 / 2 * np.sqrt(dim)  # most that the 8-bit form can be off
        x, y = np.nonzero(guess + _SIGMAS * spread[:, None] + rounding[b][None, :] >= threshold)
        near = (small[a] @ small[b].T)[x, y]
        x, y = a[x], b[y]
        off = rounding[x] + rounding[y] + rounding[x] * rounding[y] + _FLOAT_ERROR
        wanted = near + off >= threshold
        if not cross:
            wanted &= x < y
        x, y, proven = x[wanted], y[wanted], near[wanted] - off[wanted] >= threshold
        first = (words[x] == words[y]).all(2).argmax(1) == band
        x, y, proven = x[first], y[first], proven[first]
        out = [(*sorted(p), None) for p in zip(ids[x[~proven]].tolist(), ids[y[~proven]].tolist(), strict=True)]
        x, y = x[proven], y[proven]
        linked = np.bincount(x, copies[y], len(rows)) + np.bincount(y, copies[x], len(rows))
        root = _forest(x, y, len(rows))
        out += [(ids[k], None, int(linked[k])) for k in np.flatnonzero(linked).tolist()]
        return out + [(ids[k], ids[root[k]], 0) for k in np.flatnonzero(root != np.arange(len(rows))).tolist()]

    def compare(batches):
        at, held, arrow_kind = None, [], None
        for batch in batches:
            out, arrow_kind = [], batch.column("id").type
            columns = (batch.column(c).to_pylist() for c in ("band", "tile", "low", "high", *_CARRIED))
            for band, tile, low, high, *row in zip(*columns, strict=True):
                if (band, tile, low, high) != at:
                    if len(held) > 1:
                        out += pairs(held, at[0], at[2] != at[3])
                    at, held = (band, tile, low, high), []
                held.append(tuple(row))
            yield _table(out, arrow_kind)
        if len(held) > 1:
            yield _table(pairs(held, at[0], at[2] != at[3]), arrow_kind)

    def _table(out, arrow_kind):
        a, b, n = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, arrow_kind), pa.array(b, arrow_kind), pa.array(n, pa.int64())], ["a", "b", "n"])

    return tiles.mapInArrow(compare, f"a {kind}, b {kind}, n long")


def _exact(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    def cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
        sizes = pc.list_value_length(a)
        if pc.min(sizes).as_py() == pc.max(sizes).as_py():  # as nearly always; else row by row
            x, y = (c.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(a), -1) for c in (a, b))
            x, y = x / np.abs(x).max(1, keepdims=True), y / np.abs(y).max(1, keepdims=True)
            return (x * y).sum(1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
        return np.concatenate([cosines(a.slice(k, 1), b.slice(k, 1)) for k in range(len(a))])

    def decide(batches):
        for batch in batches:
            if len(batch):
                keep = cosines(batch.column("vector_a"), batch.column("vector_b")) >= threshold
                yield batch.filter(pa.array(keep)).select(["a", "b"])

    def side(x):
        return vectors.select(F.col("id").alias(x), F.col("vector").alias(f"vector_{x}"), F.col("label").alias(f"label_{x}"))

    joined = pairs.join(side("a"), "a").join(side("b"), "b").where("label_a = label_b")
    joined = joined.select("a", "b", "vector_a", "vector_b")
    return joined.mapInArrow(decide, pairs.schema)


def embedding_dedup(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    seed: int = 7,
) -> DataFrame:
    """``(id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Two vectors link when their labels and dimensions are equal and their cosine
    in double precision is at least ``threshold``. ``component_id`` is the
    smallest id reachable by links, ``kept`` marks the vector that has it. Equal
    vectors form a class that is compared once and counted with its size.

    Null labels, null or empty vectors, vectors of zeros and vectors with null
    or non-finite components link with nothing. Rows without an id count as
    copies but have no component unless a copy has an id; rows that repeat an id
    count as one vector each. Other columns are ignored.
    """
    base = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    coded = cut_lineage(_codes(base, seed))
    classes = coded.where("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = cut_lineage(classes)
    named = classes.where("rep is not null").select(F.col("rep").alias("id"), "key", "copies")
    reps = cut_lineage(coded.join(named, ["id", "key"]).dropDuplicates(["id"]))

    step = _BAND_BITS // 8
    band = F.explode(F.sequence(F.lit(0), F.lit(_BANDS - 1)))
    keys = reps.select("id", "label", F.length("small").alias("dim"), "code", band.alias("band"))
    piece = F.expr(f"substring(code, band * {step} + 1, {step})")
    keys = keys.select("id", "band", F.xxhash64("label", "dim", "band", piece).alias("tile"))
    sizes = keys.groupBy("band", "tile").agg(F.count("*").alias("n")).where("n > 1")
    shared = keys.join(sizes, ["band", "tile"]).withColumn("blocks", F.ceil(F.col("n") / _BLOCK).cast("int"))
    # A tile of k blocks becomes k (k + 1) / 2 tasks; a vector goes to the k of its own block.
    shared = shared.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int"))
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = shared.select(
        "id", "band", "tile", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = placed.join(reps.select("id", "code", "factors", "small", "copies"), "id")
    tiles = tiles.repartition(parts, "band", "tile", "low", "high").sortWithinPartitions("band", "tile", "low", "high", "id")
    judged = cut_lineage(_tile_links(tiles, threshold, seed))
    originals = base.join(named.select("id"), "id", "left_semi").dropDuplicates(["id"])
    links = cut_lineage(_exact(judged.where("n is null").select("a", "b"), originals, threshold))

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = classes.select(F.col("rep").alias("b"), "copies")
    counted = both.join(weight, "b").select("a", F.col("copies").alias("n")).unionByName(judged.where("b is null").select("a", "n"))
    near = counted.groupBy("a").agg(F.sum("n").alias("near"))
    components = connected_components(links.unionByName(judged.where("n = 0").select("a", "b")))
    known = classes.join(near.withColumnRenamed("a", "rep"), "rep", "left")
    known = known.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("key", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = coded.select("id", "key").join(known, "key", "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
