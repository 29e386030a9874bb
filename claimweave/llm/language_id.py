"""Language identification with hyperdimensional profiles.

Every letter has a random vector of signs. An n-gram is its letters' vectors,
each permuted by its place, multiplied together (bound); a text is the sum of
its n-grams' vectors (bundled), and so is a language, over all its training
texts. A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SEED = 11
#: Distinct n-grams whose vectors a worker keeps before it starts anew.
_KEPT = 30_000
#: Characters whose n-grams are counted together; a longer text is counted piece by piece.
_CHARS = 300_000
#: Distinct n-grams whose vectors are bundled together (32 MB as 4-byte floats at 1,024 dimensions).
_BUNDLED = 8_192
_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)], bool))
    return _LETTERS[0]


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 3-gram and count; a 3-gram packs the code points of three letters or of word edges (blanks).

    The 3-grams of a text are those of its letters, with every run of other
    characters as one blank and a blank at either end.
    """
    lowered = [t or "" for t in texts]
    points = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(lowered)), [len(t) + 1 for t in lowered])
    points = np.where(_letter_table()[points], points, 32)
    keep = np.append(True, (points[1:] != 32) | (points[:-1] != 32) | (row[1:] != row[:-1])) if len(points) else np.empty(0, bool)
    points, row = points[keep], row[keep]
    first = np.append(True, row[1:] != row[:-1]) if len(row) else keep
    # A blank before the first letter of each text.
    put = np.flatnonzero(first & (points != 32))
    points, row = np.insert(points, put, 32), np.insert(row, put, row[put])
    if len(points) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    own = (row[:-2] == row[2:]) & (points[1:-1] != 32)  # no n-gram spans two words
    grams, row = grams[own], row[:-2][own]
    kinds, place = np.unique(grams, return_inverse=True)
    cells, counts = np.unique(row * max(len(kinds), 1) + place, return_counts=True)
    return cells // max(len(kinds), 1), kinds[cells % max(len(kinds), 1)], counts


class Profiles:
    """Vectors of letters and n-grams; the same in every process."""

    def __init__(self, dim: int):
        self.dim, self.letters, self.known = dim, {}, {}

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            signs = np.random.default_rng([_SEED, point]).integers(0, 2, self.dim, dtype=np.int8)
            self.letters[point] = signs * np.int8(2) - np.int8(1)
        return self.letters[point]

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """One row of signs per n-gram."""
        if len(self.known) > _KEPT:
            self.known.clear()
        out = np.empty((len(grams), self.dim), np.int8)
        for k, gram in enumerate(grams.tolist()):
            vector = self.known.get(gram)
            if vector is None:
                a, b, c = gram >> 42, (gram >> 21) & 0x1FFFFF, gram & 0x1FFFFF
                vector = self.known[gram] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
            out[k] = vector
        return out


_PROFILES: dict[int, Profiles] = {}


def _profiles(dim: int) -> Profiles:
    return _PROFILES.get(dim) or _PROFILES.setdefault(dim, Profiles(dim))


def _packed(a: str, b: str, c: str) -> int:
    return ord(a) << 42 | ord(b) << 21 | ord(c)


def _pieces(text: str) -> Iterator[tuple[str, list[int]]]:
    """A lower-cased text in pieces of about ``_CHARS`` characters, cut between words.

    A longer word is cut with an overlap of two letters; with such a piece come
    the 3-grams with the false word edges, which it has too many.
    """
    at, extra = 0, []
    while len(text) - at > _CHARS:
        stop = at + _CHARS
        while stop > at and text[stop - 1].isalpha():
            stop -= 1
        if stop > at:
            yield text[at:stop], extra
            at, extra = stop, []
            continue
        stop = at + _CHARS
        y, z = text[stop - 2 : stop]
        yield text[at:stop], [*extra, _packed(y, z, " ")]
        at, extra = stop - 2, [_packed(" ", y, z)]
    yield text[at:], extra


def _counted(texts: list[str | None]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive texts, of about ``_CHARS`` characters together, with row, 3-gram and count of their 3-grams.

    A longer text comes alone and several times, each time with a part of its
    counts; they add up to those of the whole text.
    """

    def whole(start, stop):
        return (slice(start, stop), *_grams(lowered[start:stop]))

    lowered = [(t or "").lower() for t in texts]
    start, chars = 0, 0
    for k, text in enumerate(lowered):
        if len(text) > _CHARS:
            if start < k:
                yield whole(start, k)
            for piece, extra in _pieces(text):
                row, gram, count = _grams([piece])
                more = np.array(extra, np.int64)
                yield slice(k, k + 1), np.append(row, more * 0), np.append(gram, more), np.append(count, more * 0 - 1)
            start, chars = k + 1, 0
            continue
        chars += len(text)
        if chars >= _CHARS:
            yield whole(start, k + 1)
            start, chars = k + 1, 0
    if start < len(lowered):
        yield whole(start, len(lowered))


def _bundles(model: Profiles, row: np.ndarray, gram: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """The bundled vectors of ``n`` rows; exact, because all sums of a slice are whole numbers below 2**24."""
    out = np.zeros((n, model.dim))
    kinds, place = np.unique(gram, return_inverse=True)
    order = np.argsort(place, kind="stable")
    edges = np.searchsorted(place[order], np.arange(0, len(kinds) + _BUNDLED, _BUNDLED))
    for first, a, b in zip(range(0, len(kinds), _BUNDLED), edges[:-1], edges[1:], strict=True):
        some, own = order[a:b], kinds[first : first + _BUNDLED]
        counts = np.zeros((n, len(own)), np.float32)
        np.add.at(counts.reshape(-1), row[some] * len(own) + place[some] - first, count[some].astype(np.float32))
        out += counts @ model.vectors(own).astype(np.float32)
    return out


def prototypes(docs: DataFrame, text_col: str, lang_col: str, dim: int) -> dict[str, np.ndarray]:
    """The bundled vector of every language of ``docs``; rows without text or language teach nothing.

    A task sends one vector per language, so that what meets in Spark's sum
    grows with the tasks and languages, not with the texts.
    """

    def bundle(batches):
        model, sums = _profiles(dim), {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for run, row, gram, count in _counted(texts):
                names = {lang: k for k, lang in enumerate(dict.fromkeys(langs[run]))}
                of = np.array([names[lang] for lang in langs[run]], np.int64)
                for lang, vector in zip(names, _bundles(model, of[row], gram, count, len(names)), strict=True):
                    sums[lang] = sums.get(lang, 0) + vector
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["lang", "vector"],
        )

    base = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(text_col, F.col(lang_col).cast("string"))
    parts = base.mapInArrow(bundle, "lang string, vector array<double>")
    summed = parts.select("lang", F.posexplode("vector").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    whole = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "x"))).alias("v")).select("lang", "v.x")
    out = {lang: np.array(x) for lang, x in whole.collect()}  # a vector per language
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(out.items()) if v.any()}


def identify_language(
    docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", dim: int = 1024
) -> DataFrame:
    """``(id, lang_pred, score)`` for every row of ``docs``, learned from the labelled ``training`` rows.

    ``score`` is the cosine with the prototype, 0 at least. A text that is null
    or has no letter, and any text when nothing was learned, is ``und`` with
    score 0. Rows are judged one by one and by their text alone; of equal
    cosines the first language by name wins. Texts of any length are read whole,
    in pieces that bound the memory. Other columns are ignored.
    """
    learned = prototypes(training, text_col, lang_col, dim)
    shared = docs.sparkSession.sparkContext.broadcast((list(learned), np.array(list(learned.values())).reshape(-1, dim)))

    def predict(batches):
        (names, matrix), model = shared.value, _profiles(dim)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            held, bundles = None, None
            for run, row, gram, count in _counted(texts) if names else ():
                found = _bundles(model, row, gram, count, run.stop - run.start)
                bundles = bundles + found if run == held else found  # a further part of a long text
                held = run
                norms = np.linalg.norm(bundles, axis=1)
                cosines = bundles @ matrix.T / np.maximum(norms, 1e-30)[:, None]
                for k in np.flatnonzero(norms).tolist():
                    langs[run.start + k] = names[int(cosines[k].argmax())]
                    scores[run.start + k] = float(cosines[k].max().clip(0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return base.mapInArrow(predict, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
