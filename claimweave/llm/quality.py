"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

A document becomes a few statistics of its whole text. Standardised over all
documents, they pass through random cosines, whose inner products approximate a
Gaussian kernel. The normal equations of the ridge fit are sums over rows, so
each task adds up its own and Spark adds the tasks. The raw scores of the
training rows, binned, are made monotone by pooling adjacent violators.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave.llm.hashing import BLANKS, run_hashes, text_buffers, word_hashes, word_spans
from claimweave.storage import cut_lineage

#: Random features, kernel width (in standard deviations times the root of the number of statistics), ridge.
_FEATURES, _WIDTH, _RIDGE, _SEED = 256, 1.0, 0.3, 5
#: Bins of raw scores, over this range.
_BINS, _LOW, _HIGH = 400, -0.5, 1.5

_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "newline": [10],
    "blank": [32, 9],
    "stop": b".",
    "comma": b",;:",
    "call": b"!?",
    "mark": b"#$%&*@^~=+<>\\",
    "bar": b"|_/-",
    "quote": b"\"'`()[]{}",
}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
STATISTICS = len(_CLASSES) + 1 + 17


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text; zeros for a null or empty one."""
    out = np.zeros((len(column), STATISTICS), np.float32)
    for first, data, offsets in text_buffers(column):
        words, firsts = word_hashes(data, offsets, BLANKS, lower=True)
        starts, ends, _ = word_spans(data, offsets, BLANKS)
        lengths = (ends - starts).astype(np.float64)
        kinds = _CLASS_OF[data]
        capital = kinds[starts] == 1 if len(starts) else np.empty(0, bool)
        shout = capital & (ends - starts > 2) & (kinds[np.minimum(starts + 1, max(len(data) - 1, 0))] == 1) if len(starts) else capital
        marked = (kinds[ends - 1] >= 7) & (kinds[ends - 1] <= 9) if len(starts) else capital
        triples = run_hashes(words, 3)
        for i in range(len(offsets) - 1):
            raw, own = data[offsets[i] : offsets[i + 1]], slice(firsts[i], firsts[i + 1])
            n, size = int(firsts[i + 1] - firsts[i]), len(raw)
            if not n:
                continue
            share = np.bincount(kinds[offsets[i] : offsets[i + 1]], minlength=len(_CLASSES) + 1) / size
            counts = np.bincount(raw, minlength=256)
            p = counts[counts > 0] / size
            distinct, often = np.unique(words[own], return_counts=True)
            runs = triples[firsts[i] : max(firsts[i], firsts[i + 1] - 2)]
            lines = raw.tobytes().split(b"\n")
            packed = len(zlib.compress(raw.tobytes(), 1)) / size
            w = lengths[own]
            out[first + i] = [
                *share,
                np.log1p(size), np.log1p(n), w.mean(), w.std(), np.log1p(w.max()),
                len(distinct) / n, often.max() / n, (often == 1).sum() / len(distinct),
                1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0,
                shout[own].mean(), marked[own].mean(), capital[own].mean(),
                1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
                -(p * np.log(p)).sum(), packed, (w <= 3).mean(),
            ]
    return out


def _statistics_table(docs: DataFrame) -> DataFrame:
    """(id, x) for rows of (id, text)."""

    def compute(batches):
        for batch in batches:
            x = statistics(batch.column(1))
            flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, STATISTICS, dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), flat], ["id", "x"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(compute, f"id {kind}, x array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


@dataclass
class Model:
    """A fitted classifier: small arrays only, whatever the size of the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray | None = None
    levels: np.ndarray | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(_SEED)
        turns = rng.standard_normal((len(self.mean), _FEATURES)) / (_WIDTH * np.sqrt(len(self.mean)))
        shifts = rng.uniform(0, 2 * np.pi, _FEATURES)
        z = ((x - self.mean) / self.scale).clip(-8, 8)
        return np.concatenate([np.sqrt(2 / _FEATURES) * np.cos(z @ turns + shifts), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.levels).clip(0, 1)


def _sums(table: DataFrame, rows_of) -> np.ndarray:
    """The sum over tasks of the matrix that ``rows_of(batches)`` gives per task."""

    def task(batches):
        total = rows_of(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["k", "v"]
            )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": group["k"].iloc[:1], "v": [np.sum(np.stack(group["v"].to_list()), axis=0).tolist()]})

    parts = table.mapInArrow(task, "k int, v array<double>")
    rows = parts.groupBy("k").applyInPandas(add, "k int, v array<double>").collect()
    return np.array([r[1] for r in sorted(rows)]) if rows else np.empty((0, 0))


def fit(table: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on ``table`` (id, x) and ``labels`` (id, y with 0 or 1); None without both labels."""

    def moments(batches):
        total = None
        for batch in batches:
            x = _matrix(batch.column(1))
            part = np.stack([np.full(STATISTICS, len(x)), x.sum(0), (x * x).sum(0)])
            total = part if total is None else total + part
        return total

    found = _sums(table, moments)
    if not found.size:
        return None
    n, total, squares = found
    mean = total / n
    scale = np.sqrt(np.maximum(squares / n - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-6, scale, 1.0), np.zeros(_FEATURES + 1))
    labelled = cut_lineage(table.join(labels, "id").select("x", "y"))

    def equations(batches):
        total = None
        for batch in batches:
            a = model.features(_matrix(batch.column(0)))
            b = np.column_stack([a, batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)])
            total = a.T @ b if total is None else total + a.T @ b
        return total

    normal = _sums(labelled, equations)
    if not normal.size or not 0 < normal[-1, -1] < normal[-1, -2]:
        return None
    gram, target = normal[:, :-1], normal[:, -1]
    model.weights = np.linalg.solve(gram + _RIDGE * np.diag([1.0] * _FEATURES + [0.0]), target)

    def bins(batches):
        total = None
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            at = ((raw - _LOW) / (_HIGH - _LOW) * _BINS).clip(0, _BINS - 1).astype(int)
            part = np.column_stack([np.bincount(at, minlength=_BINS), np.bincount(at, weights=y, minlength=_BINS)])
            total = part if total is None else total + part
        return total

    model.edges, model.levels = isotonic(_sums(labelled, bins))
    return model


def isotonic(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres of used bins and their monotone label shares, from rows of (count, positives)."""
    centres = _LOW + (np.arange(len(bins)) + 0.5) * (_HIGH - _LOW) / len(bins)
    used = bins[:, 0] > 0
    blocks: list[list[float]] = []  # positives, count, bins
    for count, positive in bins[used]:
        blocks.append([positive, count, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            positive_, count_, width = blocks.pop()
            blocks[-1] = [blocks[-1][0] + positive_, blocks[-1][1] + count_, blocks[-1][2] + width]
    levels = np.concatenate([np.full(int(width), positive / count) for positive, count, width in blocks])
    return centres[used], levels


def _learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str) -> tuple[DataFrame, Model | None]:
    """The stored statistics of all documents and the model fitted on the labelled ones."""
    table = cut_lineage(_statistics_table(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))))
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("y"))
    return table, fit(table, known)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality"
) -> DataFrame:
    """``(id, score)`` for every row of ``docs``, learned from ``labels`` joined by id.

    ``score`` is between 0 and 1, higher where label 1 is likelier; it depends
    on the text alone. Null and empty texts count as having all statistics 0.
    Labels other than 0 and 1 are ignored, repeated ones count each. If the
    labels do not hold both values nothing is learned and every score is 1: there
    is nothing to reject a document for. Other columns are ignored.
    """
    table, model = _learn(docs, labels, id_col, text_col, label_id, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            scores = shared.value.score(_matrix(batch.column(1))) if shared.value else np.ones(len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    kind = table.schema["id"].dataType.simpleString()
    return table.mapInArrow(score, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    least: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """``docs`` without the rows that score below ``least``, with all columns.

    Rows are judged one by one by the model of ``score_quality``, so rows
    without an id and repeated ids need no care, and nothing is shuffled.
    """
    _, model = _learn(docs, labels, id_col, text_col, label_id, label_col)
    if model is None:
        return docs
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            if len(batch):
                yield batch.filter(pa.array(shared.value.score(statistics(batch.column(place)).astype(np.float64)) >= least))

    return docs.mapInArrow(keep, docs.schema)
