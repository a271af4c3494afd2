"""Document quality by ordinal (cumulative-link) regression on hashed text.

Ratings are ordered grades 0..K-1. One weight vector, shared by all grades,
scores a document; ordered thresholds t_1 < ... < t_{K-1} turn the score f into
``P(grade >= k) = 1 / (1 + exp(t_k - f))``. From these come the expected grade
and the tail probability by which documents are selected.

Features are hashed into ``2 ** hash_bits`` cells: each word, each word's shape
(letter case, digits, punctuation), and whether a word repeats the one before.
The score is the weighted mean over a text's words, less that of the training
texts, so a text without words scores 0, like an average one.

The model is fitted on the driver from at most ``sample_rows`` labelled
documents (a documented bound, chosen by a seeded hash of the identifier).
Everything is scored over whole texts.

Edge cases: null text reads as empty. Labels with a null grade or identifier
are ignored; a label without a document has no effect; rows that repeat an
identifier are scored each on their own. Without any usable label every
document has tail probability 0.5 and is selected. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.common import label_sample, prepare

HASH_BITS = 16
SAMPLE_ROWS = 6000
STEPS = 300
PENALTY = 1e-5
SELECT_FROM, SELECT_AT = 1, 0.5  # keep where P(grade >= 1) >= 0.5


def grade_of(quality: Column, toxic: Column) -> Column:
    """0: bad text; 1: good text that is toxic; 2: good text."""
    return (F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1)
            .when((quality == 1) & (toxic == 0), 2))


# ------------------------------------------------------------------ features

def _cells(words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of every word and of its shape, and which words repeat the one before."""
    from playmetrics.llm.wordstream import mix, shape_hashes

    shift = np.uint64(64 - bits)
    word = (words.hashes >> shift).astype(np.int64)
    shape = (mix(shape_hashes(words) + np.uint64(1)) >> shift).astype(np.int64)
    repeat = np.zeros(len(word), dtype=bool)
    repeat[1:] = words.hashes[1:] == words.hashes[:-1]
    starts = words.offsets[:-1]
    repeat[starts[starts < len(repeat)]] = False
    return word, shape, repeat


def _features(sample: DataFrame, bits: int) -> DataFrame:
    """(id, grade, cells, shares): the hashed features of labelled texts, as packed arrays."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import slices

        for batch in batches:
            for first, words in slices(batch.column(2)):
                word, shape, repeat = _cells(words, bits)
                cells, shares = [], []
                for lo, hi in zip(words.offsets[:-1], words.offsets[1:], strict=True):
                    own = np.concatenate([word[lo:hi], shape[lo:hi],
                                          np.zeros(int(repeat[lo:hi].sum()), np.int64)])
                    found, counts = np.unique(own, return_counts=True)
                    cells.append(found.astype("<i4").tobytes())
                    shares.append((counts / max(hi - lo, 1)).astype("<f8").tobytes())
                n = len(cells)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                     pa.array(cells, pa.binary()), pa.array(shares, pa.binary())],
                    names=["id", "grade", "cells", "shares"])

    return sample.mapInArrow(read, "id long, grade int, cells binary, shares binary")


# ------------------------------------------------------------------ the model

@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray
    centre: float
    thresholds: np.ndarray
    bits: int

    def scores(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, scores) for runs of rows of a text column."""
        from playmetrics.llm.wordstream import slices

        for first, words in slices(texts):
            word, shape, repeat = _cells(words, self.bits)
            each = self.weights[word] + self.weights[shape] + self.weights[0] * repeat
            sums = np.concatenate([[0.0], np.cumsum(each)])
            counts = np.diff(words.offsets)
            total = sums[words.offsets[1:]] - sums[words.offsets[:-1]]
            yield first, np.where(counts > 0, total / np.maximum(counts, 1) - self.centre, 0.0)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, one row per score."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


class Rated(NamedTuple):
    """One labelled text: its grade, and the share of each cell in its features."""

    grade: int
    cells: np.ndarray
    shares: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(rows: list[Rated], grades: int, bits: int, steps: int = STEPS,
        penalty: float = PENALTY) -> OrdinalModel:
    """Maximum likelihood by Adam over all rows."""
    size = 1 << bits
    if not rows:
        return OrdinalModel(np.zeros(size), 0.0, np.arange(grades - 1) * 1e-9, bits)
    y = np.array([r.grade for r in rows])
    lengths = np.array([len(r.cells) for r in rows])
    cells = np.concatenate([np.asarray(r.cells, np.int64) for r in rows])
    shares = np.concatenate([np.asarray(r.shares) for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    mean = np.bincount(cells, shares, size) / len(rows)
    used = np.flatnonzero(mean)
    place = np.zeros(size, np.int64)
    place[used] = np.arange(len(used))
    cells, mean = place[cells], mean[used]
    # thresholds: the first one, then the logarithms of the gaps, so they stay ordered
    share_below = np.clip([(y < k).mean() for k in range(1, grades)], 1e-3, 1 - 1e-3)
    first = np.log(share_below / (1 - share_below))
    params = np.concatenate([np.zeros(len(used)), first[:1],
                             np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    cut = len(used)
    for step in range(1, steps + 1):
        w = params[:cut]
        t = np.cumsum(np.concatenate([params[cut:cut + 1], np.exp(params[cut + 1:])]))
        f = np.bincount(row, w[cells] * shares, len(rows)) - w @ mean
        # cumulative probabilities at both sides of each row's grade
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        upper, lower = _cdf(edges[y + 1] - f), _cdf(edges[y] - f)
        p = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper), lower * (1 - lower)
        slope_f = (d_upper - d_lower) / p / len(rows)
        grad_w = np.bincount(cells, slope_f[row] * shares, cut) - slope_f.sum() * mean + penalty * w
        grad_t = (np.bincount(y, -d_upper / p, grades)[:-1]
                  + np.bincount(y, d_lower / p, grades)[1:]) / len(rows)
        tail = np.cumsum(grad_t[::-1])[::-1]
        grad = np.concatenate([grad_w, tail[:1], tail[1:] * np.exp(params[cut + 1:])])
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        rate = 0.5 * min(1.0, 2 * (1 - step / (steps + 1)))
        params -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    weights = np.zeros(size)
    weights[used] = params[:cut]
    t = np.cumsum(np.concatenate([params[cut:cut + 1], np.exp(params[cut + 1:])]))
    return OrdinalModel(weights, float(params[:cut] @ mean), t, bits)


def _cdf(x: np.ndarray) -> np.ndarray:
    return _sigmoid(np.nan_to_num(x, posinf=500, neginf=-500))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          grade: Column | None = None, grades: int = 3, bits: int = HASH_BITS,
          sample_rows: int = SAMPLE_ROWS, seed: int = 1) -> OrdinalModel:
    """Fit on at most ``sample_rows`` labels; ``grade`` defaults to :func:`grade_of`."""
    prepare(docs.sparkSession)
    grade = grade_of(F.col("quality"), F.col("toxic")) if grade is None else grade
    chosen = label_sample(labels.select(F.col(id_col).alias("label_id"), grade.alias("grade"))
                          .where("grade is not null"), sample_rows, seed, "label_id")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sample = (texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))  # <= sample_rows
              .select("id", F.col("grade").cast("int"), "text"))
    rows = sorted(_features(sample, bits).collect(), key=lambda r: (r.id, r.grade, r.cells))
    return fit([Rated(r.grade, np.frombuffer(r.cells, "<i4"), np.frombuffer(r.shares, "<f8"))
                for r in rows], grades, bits)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, score, expected_grade, p_tail, selected) for every row."""
    prepare(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, f in model.scores(batch.column(1)):
                tails = model.tails(f)
                tail = np.ascontiguousarray(tails[:, SELECT_FROM - 1])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(f)), pa.array(f), pa.array(tails.sum(axis=1)),
                     pa.array(tail), pa.array(tail >= SELECT_AT)],
                    names=["id", "score", "expected_grade", "p_tail", "selected"])

    scored = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        rate, "id long, score double, expected_grade double, p_tail double, selected boolean")
    return scored.withColumnRenamed("id", id_col)


def grade(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    return score(docs, train(docs, labels, **names), **names)


def drop_low_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model selects, with all their columns.

    Rows are judged where they lie: no identifier, join or shuffle is needed.
    """
    model = train(docs, labels, text_col=text_col)

    at = docs.columns.index(text_col)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, f in model.scores(batch.column(at)):
                chosen = model.tails(f)[:, SELECT_FROM - 1] >= SELECT_AT
                yield batch.slice(first, len(f)).filter(pa.array(chosen))

    return docs.mapInArrow(choose, docs.schema)
