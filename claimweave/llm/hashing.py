"""Word hashing over raw UTF-8 buffers.

The bytes of many documents are hashed together with numpy, without a Python
object per word. A word is cut into blocks of eight bytes; each block is mixed
with its position by a non-linear step, and the mixed blocks are added up with
the length and mixed again. So no rule about the bytes of two words, such as
swapped or mirrored patterns, makes their hashes equal. It does not depend on the
process, the batch or the place of the word in its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; longer documents form a chunk of their own.
CHUNK_BYTES = 500_000

_BLOCK = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEED = np.uint64(0xA0761D6478BD642F)
#: What is left of a block of n bytes.
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(_BLOCK + 1)], np.uint64)


def _table(separators: bytes | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


#: Fixed byte classes: blanks (0x09-0x0D, 0x20), and everything in ASCII but digits and letters.
BLANKS = _table([*range(0x09, 0x0E), 0x20])
NOT_ALNUM = _table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche step (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a text column: index of the first row, bytes, row offsets in them.

    Null rows count as empty. A piece holds CHUNK_BYTES or a single longer row.
    """
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    column = column.fill_null(b"") if column.null_count else column
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each row's first word."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    after = np.empty(len(data) + 1, bool)
    after[0], after[1:] = False, word
    starts = np.flatnonzero(word & (~after[:-1] | edge[:-1]))
    ends = np.flatnonzero(after[1:] & (edge[1:] | np.append(~word[1:], True))) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the index of each row's first word (one more at the end)."""
    starts, ends, firsts = word_spans(data, offsets, separators)
    if not len(starts):
        return np.empty(0, np.uint64), firsts
    padded = np.zeros(len(data) + _BLOCK, np.uint8)
    padded[: len(data)] = _LOWER[data] if lower else data
    # The eight bytes from every position on, as one number.
    eight = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    sums = mix((eight[starts] & _MASKS[np.minimum(lengths, _BLOCK)]) ^ _SEED)
    longer = np.flatnonzero(lengths > _BLOCK)
    blocks = (lengths[longer] + _BLOCK - 1) // _BLOCK - 1
    if len(longer):  # one row per further block: its word, and its number in the word
        word = np.repeat(longer, blocks)
        first = np.cumsum(blocks) - blocks
        number = np.arange(len(word)) - np.repeat(first, blocks) + 1
        at = starts[word] + number * _BLOCK
        left = np.minimum(ends[word] - at, _BLOCK)
        mixed = mix(mix((eight[at] & _MASKS[left]) ^ _SEED) + number.astype(np.uint64) * _STEP)
        sums[longer] += np.add.reduceat(mixed, first)
    return mix(sums + lengths.astype(np.uint64) * _STEP), firsts


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words, by the index of its first word."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(total + np.uint64(length))
