"""Token-ID output as length-delimited binary records, with an offset index.

Documents are range-partitioned by id, encoded and written as shards. Every
record is a little-endian frame: length (8 bytes), masked CRC-32 of the length
(4), payload, masked CRC-32 of the payload (4). The payload is one byte for the
width of an id (2 or 4) and the ids. The index is a table of its own with the
place of every record; training reads records in any order by seeking to them.

Shards are written through the file system the folder's address names, under a
name that no other attempt uses; only shards that the committed index lists
count. A lost task leaves an unlisted file, never a half shard in the result.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.memo import Memo
from claimweave.storage import scratch_path

#: Bytes after which a shard ends; a longer record forms a shard of its own.
SHARD_BYTES = 16_000_000
#: Distinct pieces of words of one generation that a worker remembers.
_REMEMBERED = 500_000
#: Bytes of records that a reader holds at once, if more than one.
_READ_BYTES = 16_000_000
#: Bytes of text whose distinct pieces are sought together, and of a slice taken apart at once.
_BYTES, _SLICE = 16_000_000, 1_000_000
#: Fixed value of masked checksums.
_MASK = 0xA282EAD8
#: The steps before the model for which words can be taken apart here.
_OUTLINE = [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]
_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Pieces that reach the model in one call, and how the last token of a piece ends.
_TOGETHER, _LAST = 2_000, "</w>"
_SPACES = re.compile(rb"[ \t-\r]")
#: Kinds of bytes: white space, of a letter, a digit, any other plain character, and what makes the library do a word whole.
_SPACE, _LETTER, _DIGIT, _OTHER, _WHOLE = range(5)
_ENCODERS: dict[str, WordEncoder] = {}


def masked_crc(data: bytes) -> int:
    """CRC-32, rotated and offset, so that a checksum over checksums stays meaningful."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(ids: np.ndarray) -> bytes:
    """One record."""
    width = 2 if not len(ids) or int(ids.max()) < 65536 else 4
    payload = bytes([width]) + ids.astype(f"<u{width}").tobytes()
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def read_frame(data: bytes, at: int) -> tuple[np.ndarray, int]:
    """The ids of the record at ``at`` and where the next one starts; a damaged record raises ValueError."""
    if at + 12 > len(data):
        raise ValueError(f"record at {at} is cut off")
    (size,), (check,) = struct.unpack_from("<Q", data, at), struct.unpack_from("<I", data, at + 8)
    if check != masked_crc(data[at : at + 8]) or at + 16 + size > len(data):
        raise ValueError(f"record at {at} has a damaged length")
    payload = data[at + 12 : at + 12 + size]
    if struct.unpack_from("<I", data, at + 12 + size)[0] != masked_crc(payload):
        raise ValueError(f"record at {at} has damaged ids")
    return np.frombuffer(payload, f"<u{payload[0]}", offset=1), at + 16 + size


def read_frames(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """``(offset, ids)`` of every record of a shard."""
    at = 0
    while at < len(data):
        ids, following = read_frame(data, at)
        yield at, ids
        at = following


def _located(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


class WordEncoder:
    """Ids of whole texts as the tokenizers library encodes them.

    The tokenizer must drop white space and never join across it, as the one
    with word ends does. Then the ids of a text are those of its words. Where
    the tokenizer's steps before its model are the known ones, words of plain
    Latin characters are taken apart for a whole slice of texts at once, and
    each distinct piece reaches the model once, in lower case. The library does
    all other words whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, WhitespaceSplit

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        steps = spec["normalizer"], spec["pre_tokenizer"]
        outline = [[s["type"] for s in step.get("normalizers", step.get("pretokenizers", [step]))] if step else [] for step in steps]
        cut = steps[1].get("pretokenizers", [{}])[0] if steps[1] else {}
        by_piece = outline == _OUTLINE and cut.get("pattern") == {"Regex": _PIECE} and cut.get("behavior") == "Removed"
        by_piece = by_piece and spec["model"].get("end_of_word_suffix") == _LAST and all("|" in token["content"] for token in spec["added_tokens"])
        # The model alone, for many spelled pieces in a row; a piece ends with an id of ``is_last``.
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.model.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_last[[i for token, i in vocabulary.items() if token.endswith(_LAST)]] = True
        # The model's letter for each byte, as the library's byte-level step writes it.
        letters = {b: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        alphabet = set(ByteLevel.alphabet()) - set(letters.values())
        high = {b: chr(b) for b in range(128, 256) if chr(b) in alphabet}
        rest = sorted(alphabet - set(high.values()))
        high |= dict(zip((b for b in range(128, 256) if b not in high), rest, strict=True))
        self.letters = str.maketrans({chr(b): c for b, c in (letters | high).items()} | {" ": " "})
        # Kind and lower case of each byte; of those that follow 0xC2 and 0xC3, in rows 1 and 2.
        self.kinds, self.lower = np.full((3, 256), _WHOLE, np.uint8), np.tile(np.arange(256, dtype=np.uint8), (3, 1))
        self.kinds[0, list(b" \t\n\r\x0b\x0c")] = _SPACE
        plain = [c for c in map(chr, range(256)) if by_piece and regex.fullmatch(r"[!-~\xa1-\xac\xae-\xff--'|²³¹¼½¾]", c, regex.V1)]
        for c in plain:
            *lead, last = c.encode()
            at = lead[0] - 0xC1 if lead else 0
            self.kinds[at, last] = _LETTER if regex.match(r"\p{L}", c) else _DIGIT if regex.match(r"\p{N}", c) else _OTHER
            self.lower[at, last] = c.lower().encode()[-1]
        self.kinds_1, self.lower_1 = self.kinds[0].tobytes(), self.lower[0].tobytes()
        self.plain = re.compile(f"[{re.escape(''.join(plain))}]+" if plain else "(?!)")
        self.known = Memo(_REMEMBERED, self._encode_pieces)

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out, split, rest = [b""] * len(pieces), [], []
        for i, piece in enumerate(pieces):
            (split if self.plain.fullmatch(piece.decode()) else rest).append(i)
        for at in range(0, len(split), _TOGETHER):
            some = split[at : at + _TOGETHER]
            spelled = b" ".join([pieces[i] for i in some]).decode("latin-1").translate(self.letters)
            ids = np.array(self.model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
            stops = (np.flatnonzero(self.is_last[ids]) + 1) * 4
            held, start = ids.tobytes(), 0
            for i, stop in zip(some, stops.tolist(), strict=True):
                out[i], start = held[start:stop], stop
        got = self.whole.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)
        for i, encoding in zip(rest, got, strict=True):
            out[i] = np.array(encoding.ids, "<u4").tobytes()
        return out

    def _pieces(self, data: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of whole words in UTF-8 ``data``, and how many start before each of ``ends``, where texts end."""
        held, size = bytearray(data), len(data)
        kind, low = (np.frombuffer(held.translate(table), np.uint8) for table in (self.kinds_1, self.lower_1))
        lead = np.flatnonzero((data & 0xFE) == 0xC2)
        lead = lead[lead < size - 1]
        row, last = data[lead] - 0xC1, data[lead + 1]
        kind[lead] = kind[lead + 1] = self.kinds[row, last]
        low[lead + 1] = self.lower[row, last]
        cut = np.zeros(size + 1, bool)
        cut[0] = True
        cut[ends] = True
        odd = np.flatnonzero(kind == _WHOLE)
        if len(odd):  # a word with such a byte stays in one piece, and as it is
            full = kind != _SPACE
            starts = np.flatnonzero(full & (cut[:-1] | ~np.concatenate([[False], full[:-1]])))
            stops = np.flatnonzero(full & (cut[1:] | ~np.concatenate([full[1:], [False]]))) + 1
            words = np.unique(np.searchsorted(starts, odd, "right") - 1)
            inside = np.zeros(size + 1, np.int8)
            inside[starts[words]] += 1
            inside[stops[words]] -= 1
            inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
            kind[inside], low[inside] = _WHOLE, data[inside]
        start = cut[:-1]
        start[1:] |= kind[1:] != kind[:-1]
        start |= kind == _DIGIT
        full = kind != _SPACE
        start &= full
        text = low[full]
        places = np.append(np.flatnonzero(start[full]), len(text))
        buffers = [None, pa.py_buffer(places), pa.py_buffer(text)]
        return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers), np.searchsorted(np.flatnonzero(start), ends)

    def encode(self, data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts that end at ``ends``, and of what follows the last of them; ``data`` holds whole words."""
        found = [self._pieces(data[at:stop], ends[done:following] - at) for at, stop, done, following in _slices(data, ends, _SLICE)]
        coded = pa.chunked_array([pieces for pieces, _ in found if len(pieces)], pa.large_binary()).dictionary_encode()
        if not len(coded):
            return [np.empty(0, "<u4")] * (len(ends) + 1)
        distinct = coded.chunk(0).dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known.learn(set(distinct))
        values = [known[piece] for piece in distinct]
        pool, sizes = np.frombuffer(b"".join(values), "<u4"), np.fromiter(map(len, values), np.int64, len(values)) // 4
        starts, parts, bounds, ahead = np.cumsum(sizes) - sizes, [], [], 0
        codes = iter(coded.chunks)
        for pieces, firsts in found:
            own = next(codes).indices.to_numpy() if len(pieces) else np.empty(0, np.int32)
            counts = sizes[own]
            after = np.append(0, np.cumsum(counts))
            parts.append(pool[np.repeat(starts[own] - after[:-1], counts) + np.arange(after[-1])])
            bounds.append(after[firsts] + ahead)
            ahead += int(after[-1])
        return np.split(np.concatenate(parts), np.concatenate(bounds))


def _slices(data: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Start and stop of slices of about ``size`` bytes that cut no word, and of the ``ends`` within them; at least one."""
    at = stop = done = 0
    while True:
        stop = min(at + size, len(data))
        after = int(np.searchsorted(ends, stop))
        limit = int(ends[after]) if after < len(ends) else len(data)
        space = _SPACES.search(data, stop, limit)
        stop = space.start() if space else limit
        following = int(np.searchsorted(ends, stop, "right"))
        yield at, stop, done, following
        at, done = stop, following
        if at == len(data):
            return


def encode_words(path: str, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
    """Ids of each text and ``end_id``, with one encoder per worker and file.

    Short texts are encoded together and long ones in parts, about ``_BYTES`` at a time.
    """
    if not len(texts):
        return
    encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, WordEncoder(path))
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, places, held = texts.buffers()
    ends = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(held or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends[1:] - ends[0]
    parts = []
    for at, stop, done, following in _slices(data, ends, _BYTES):
        *whole, rest = encoder.encode(data[at:stop], ends[done:following] - at)
        for ids in whole:
            yield np.concatenate([*parts, ids, [end_id]], dtype="<u4", casting="unsafe")
            parts = []
        parts.append(rest)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Both columns of about ``_BYTES`` of batches, the texts as bytes."""
    held, size = [], 0
    for batch in batches:
        held.append((batch.column(0), batch.column(1).cast(pa.large_binary())))
        size += batch.nbytes
        if size >= _BYTES:
            yield tuple(map(pa.concat_arrays, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(pa.concat_arrays, zip(*held, strict=True)))


def write_token_records(
    docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1
) -> DataFrame:
    """Write the documents' ids below ``folder`` and return the stored index.

    The index, written to ``folder/index``, has (id, part, shard, record, offset,
    bytes, n_tokens); parts, shards of a part and records of a shard are in
    ascending id order. Null and empty texts become records with the end id
    alone. Rows without an id come first; rows that share one keep separate
    records. Other columns are ignored.
    """

    def write(part: int, batches):
        target, place = _located(folder)
        target.create_dir(f"{place}/shards", recursive=True)
        shard, buffer, rows, attempt = 0, io.BytesIO(), [], uuid.uuid4().hex

        def flush():
            name = f"part-{part:06d}-{shard:06d}-{attempt}.records"
            with target.open_output_stream(f"{place}/shards/{name}") as out:
                out.write(buffer.getvalue())
            ids, offsets, sizes, counts = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, id_kind), pa.array([part] * len(ids), pa.int32()), pa.array([name] * len(ids)),
                 pa.array(range(len(ids)), pa.int64()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["id", "part", "shard", "record", "offset", "bytes", "n_tokens"],
            )

        for docs, texts in _gathered(batches):
            id_kind = docs.type
            for doc, ids in zip(docs.to_pylist(), encode_words(tokenizer_path, texts, end_id), strict=True):
                record = frame(ids)
                rows.append((doc, buffer.tell(), len(record), len(ids)))
                buffer.write(record)
                if buffer.tell() >= SHARD_BYTES:
                    yield flush()
                    shard, buffer, rows = shard + 1, io.BytesIO(), []
        if rows:
            yield flush()

    def numbered(batches):
        from pyspark import TaskContext

        yield from write(TaskContext.get().partitionId(), batches)

    kind = docs.schema[id_col].dataType.simpleString()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    placed = placed.repartitionByRange(parts, "id").sortWithinPartitions("id")
    index = placed.mapInArrow(numbered, f"id {kind}, part int, shard string, record long, offset long, bytes long, n_tokens long")
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def _sought(source: fs.FileSystem, place: str, shards: list[str], offsets: list[int], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each record; neighbours in a shard are read together."""
    out: list = [None] * len(shards)
    order = sorted(range(len(shards)), key=lambda k: (shards[k], offsets[k]))
    at = 0
    while at < len(order):
        shard, first = shards[order[at]], offsets[order[at]]
        end, stop = first, at
        with source.open_input_file(f"{place}/shards/{shard}") as file:
            while stop < len(order) and (shards[order[stop]], offsets[order[stop]]) == (shard, end):
                end, stop = end + sizes[order[stop]], stop + 1
            data = file.read_at(end - first, first)
        for k in order[at:stop]:
            out[k], following = read_frame(data, offsets[k] - first)
            if following != offsets[k] - first + sizes[k]:
                raise ValueError(f"record at {offsets[k]} of {shard} is not the one of the index")
        at = stop
    return out


def read_token_records(index: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """``(id, part, shard, record, n_tokens, ids_crc32)`` and ``ids`` of the rows of ``index``, in their order.

    ``index`` is the stored index or any choice, order and partitioning of its
    rows; each task seeks to the records of its own rows and reads nothing else.
    Rows that repeat are read again, an empty table reads no file. A damaged
    record, or one that is not as the index says, raises ValueError.
    """

    def read(batches):
        source, place = _located(folder)
        for batch in batches:
            shards, offsets, sizes = (batch.column(c).to_pylist() for c in ("shard", "offset", "bytes"))
            at = 0
            while at < len(batch):
                stop, held = at + 1, sizes[at]
                while stop < len(batch) and held + sizes[stop] <= _READ_BYTES:
                    held, stop = held + sizes[stop], stop + 1
                found = _sought(source, place, shards[at:stop], offsets[at:stop], sizes[at:stop])
                counts = pa.array([len(ids) for ids in found], pa.int64())
                if counts != batch.column("n_tokens").slice(at, stop - at):
                    raise ValueError("records do not have the length that the index says")
                kept = batch.slice(at, stop - at)
                out = [*(kept.column(c) for c in ("id", "part", "shard", "record")), counts]
                out.append(pa.array([zlib.crc32(ids.astype("<u4").tobytes()) for ids in found], pa.int64()))
                if with_ids:
                    ends = np.cumsum([0, *(len(ids) for ids in found)])
                    out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).astype(np.int64))))
                yield pa.RecordBatch.from_arrays(out, names)
                at = stop

    names = ["id", "part", "shard", "record", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    kind = index.schema["id"].dataType.simpleString()
    rows = index.select("id", "part", "shard", "record", "offset", "bytes", "n_tokens")
    schema = f"id {kind}, part int, shard string, record long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return rows.mapInArrow(read, schema)


def shuffled_token_records(index: DataFrame, folder: str, seed: int) -> DataFrame:
    """All records with their ids in a random order, which ``seed`` and the files fix; only rows of the index are moved."""
    return read_token_records(index.orderBy(F.xxhash64(F.lit(seed), "shard", "record"), "shard", "record"), folder)


def token_records(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, folder: str | None = None
) -> DataFrame:
    """Write all documents and read them back: (id, start, n_tokens, ids_crc32).

    ``start`` counts the ids of all records before. The totals of the shards,
    one row each, are the only thing that is summed up across tasks.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    index = write_token_records(docs, folder, tokenizer_path, id_col, text_col, end_id)
    # As many tasks as for writing, whatever little room the index takes.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = read_token_records(index.repartition(parts, "shard"), folder, with_ids=False)
    totals = index.groupBy("part").agg(F.sum("n_tokens").alias("total")).collect()  # a row per task that wrote
    before, ahead = {}, 0
    for part, total in sorted(tuple(r) for r in totals):
        before[part], ahead = ahead, ahead + total
    heads = spark.createDataFrame(list(before.items()), "part int, ahead long")
    from pyspark.sql import Window

    within = Window.partitionBy("part").orderBy("shard", "record").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    read = read.join(F.broadcast(heads), "part")
    start = F.col("ahead") + F.sum("n_tokens").over(within) - F.col("n_tokens")
    return read.select(F.col("id").alias(id_col), start.alias("start"), "n_tokens", "ids_crc32")
