"""Byte-level BPE over a rank file, in length-bucketed numpy matrices.

A text is cut by the vocabulary's pattern; pieces that a worker has met before
are looked up. The new pieces of a batch are laid out by length as the rows of
padded matrices of token ids. Each round, every row merges its leftmost pair of
least rank and closes the gap; finished rows leave the matrix. Pairs are looked
up in an open-addressing hash table that is two numpy arrays.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.memo import Memo

#: Unicode white space, as the pattern's \\s has it.
_BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Rank of pairs that do not merge.
_NEVER = np.int32(2**31 - 1)
#: Longest piece that gets a matrix row; longer ones use a heap, as a round per merge would be quadratic.
_LONGEST = 256
#: Rows of a matrix at most, so that a round's arrays stay small.
_ROWS = 4096
#: Distinct words of one generation that a worker remembers.
_REMEMBERED = 100_000
_MODELS: dict[tuple[str, str], ByteBpe] = {}


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)


class PairTable:
    """Hash table from a pair of token ids to the rank of their concatenation."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.mask = (1 << max(4, int(len(keys) * 2).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.ranks = np.full(self.mask + 1, _NEVER, np.int32)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            at = (_slots(keys[left]) + probe) & self.mask
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[left[free]]  # of several for one slot, the last stays
            won = free & (self.keys[at] == keys[left])
            self.ranks[at[won]] = ranks[left[won]]
            left, probe = left[~won], probe + 1
        self.probes = probe

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; pairs with a negative id never merge."""
        keys = (a.astype(np.int64) << 32) | b.astype(np.int64)
        keys[(a < 0) | (b < 0)] = -2
        at = _slots(keys) & self.mask
        out = np.where(self.keys[at] == keys, self.ranks[at], _NEVER)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1) & (keys >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            found = self.keys[at[open_]] == keys[open_]
            out[open_[found]] = self.ranks[at[open_[found]]]
            open_ = open_[~found & (self.keys[at[open_]] != -1)]
        return out


class ByteBpe:
    """Encoder and decoder for one rank file and pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes_to_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = rank
        self.pairs = PairTable(np.fromiter(pairs.keys(), np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        self.pattern = regex.compile(pattern)
        # Every match of the pattern lies within one of these, which repeat far more often.
        self.words = re.compile(f" ?[^{_BLANKS}]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+")
        self.known = Memo(_REMEMBERED, self._encode_words)

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        """The model of a rank file, read once per worker."""
        if (path, pattern) not in _MODELS:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
            _MODELS[path, pattern] = cls(ranks, pattern)
        return _MODELS[path, pattern]

    def _merge_rows(self, ids: np.ndarray) -> list[bytes]:
        """Merge the rows of a padded matrix (padding is -1) until no pair is left."""
        done: list[bytes] = [b""] * len(ids)
        rows = np.arange(len(ids))
        pair = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), -1)
        while True:
            at = pair.argmin(1)  # the leftmost of the least
            rank = pair[np.arange(len(pair)), at]
            ended = rank == _NEVER
            if ended.any():
                over = ids[ended]
                flat, width = over.astype("<i4").tobytes(), over.shape[1] * 4
                sizes = (over >= 0).sum(1) * 4
                for k, (row, size) in enumerate(zip(rows[ended].tolist(), sizes.tolist(), strict=True)):
                    done[row] = flat[k * width : k * width + size]
                if ended.all():
                    return done
                ids, pair, rows, at, rank = ids[~ended], pair[~ended], rows[~ended], at[~ended], rank[~ended]
            n, width = ids.shape
            line = np.arange(n)
            column = np.arange(width - 1)
            ids[line, at] = rank
            # Close the gap behind each merged pair.
            ids[:, :-1] = np.where(column[None, :] > at[:, None], ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ids = ids[:, :-1] if width > 2 and (ids[:, -2] < 0).all() else ids
            width = ids.shape[1]
            if pair.shape[1] > 1:
                pair[:, :-1] = np.where(column[None, : pair.shape[1] - 1] > at[:, None], pair[:, 1:], pair[:, :-1])
            pair = np.ascontiguousarray(pair[:, : width - 1])
            for k in (at - 1, at):
                inside = (k >= 0) & (k < width - 1)
                r, c = line[inside], k[inside]
                pair[r, c] = self.pairs.find(ids[r, c], ids[r, c + 1])
            if pair.shape[1] == width - 1 and width >= 2:
                pair[:, -1] = self.pairs.find(ids[:, -2], ids[:, -1])

    def _merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece, with a heap over a linked list."""
        ids = self.bytes_to_ids[np.frombuffer(piece, np.uint8)]
        first = self.pairs.find(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(r), i) for i, r in enumerate(first.tolist()) if r != _NEVER]
        heapq.heapify(heap)

        def rank(i):
            j = after[i]
            return self.ranks.get(self.tokens[ids[i]] + self.tokens[ids[j]]) if j < n else None

        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != r:
                continue
            j = after[i]
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (s := rank(k)) is not None:
                    heapq.heappush(heap, (s, k))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece by itself, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > _LONGEST:
                out[i] = self._merge_long(piece)
            else:
                buckets.setdefault(len(piece) if len(piece) <= 16 else -(-len(piece) // 16) * 16, []).append(i)
        for width, members in buckets.items():
            step = max(1, min(_ROWS, 400_000 // width))
            for low in range(0, len(members), step):
                part = members[low : low + step]
                data = np.zeros((len(part), width), np.uint8)
                sizes = np.array([len(pieces[i]) for i in part])
                used = np.arange(width)[None, :] < sizes[:, None]
                data[used] = np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)
                ids = np.where(used, self.bytes_to_ids[data], -1).astype(np.int32)
                for i, row in zip(part, self._merge_rows(ids), strict=True):
                    out[i] = row
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words; their pieces go through the matrices together."""
        split = [(w,) if w[1:].isalpha() and (w[0] == " " or w[0].isalpha()) else self.pattern.findall(w) for w in words]
        pieces = list(dict.fromkeys(p for parts in split for p in parts))
        ids = dict(zip(pieces, self.encode_pieces([p.encode() for p in pieces]), strict=True))
        return [ids[parts[0]] if len(parts) == 1 else b"".join([ids[p] for p in parts]) for parts in split]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; the new words of all texts together."""
        split = [self.words.findall(t) if t else [] for t in texts]
        known = self.known.learn(set().union(*split))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of a run of ids."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


#: Characters encoded together, and rows turned into Python strings together.
_CHARS, _SLICE = 1_000_000, 256


def _runs(column: pa.Array) -> Iterable[list[str | None]]:
    run, chars = [], 0
    for first in range(0, len(column), _SLICE):
        for text in column.slice(first, _SLICE).to_pylist():
            run.append(text)
            chars += len(text or "")
            if chars >= _CHARS:
                yield run
                run, chars = [], 0
    if run:
        yield run


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """``(id, ids, n_tokens, ids_sha256, decoded_sha256)`` for every row of ``docs``.

    ``ids`` is the binary run of little-endian unsigned 32-bit token ids (left out
    without ``with_ids``), the last column is over the bytes decoded from them.
    No special tokens: their strings are ordinary text. Null and empty texts
    have no ids. Rows are independent, so repeated rows and rows without an id
    need no care; other columns are ignored. Nothing is shuffled.
    """

    def encode(batches):
        bpe = ByteBpe.load(ranks_path, pattern)
        for batch in batches:
            ids = [x for run in _runs(batch.column(1)) for x in bpe.encode_batch(run)]
            out = {"id": batch.column(0)} | ({"ids": pa.array(ids, pa.binary())} if with_ids else {})
            out["n_tokens"] = pa.array([len(x) // 4 for x in ids], pa.int64())
            out["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
            out["decoded_sha256"] = pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + "ids binary, " * with_ids + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(encode, schema).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` from binary runs of ids; null ids give null text."""

    def decode(batches):
        bpe = ByteBpe.load(ranks_path, pattern)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    base = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return base.mapInArrow(decode, f"id {kind}, text string").withColumnRenamed("id", id_col)
