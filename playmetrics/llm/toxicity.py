"""Toxicity scores by a bidirectional recurrent network over all overlapping windows.

Every text is read in windows of ``WINDOW`` words that start ``STRIDE`` apart, the
last one ending with the text. The network (see ``bigru``) scores each window
and the text takes its highest score, so one toxic passage in a long text
counts and padding with clean words does not help.

Training sees only labels whose identifier's crc32, modulo 4, is not 2: at most
``SAMPLE`` toxic documents and twice as many others (a documented bound on rows; chosen
by hash, so a repeated run sees the same). Of these it reads every window, however long
the text or its words. A document's loss is that of its pooled windows: a soft
maximum at first, then the maximum. Windows go through the network in blocks, so a long
text does not need more memory; only windows that the loss depends on are passed
back. Scores are shifted to the label's share among the training labels. Only the text
is an input.

Edge cases: a text that is null, empty or without words scores 0. Labels with
a null identifier or class are ignored, labels without a document have no
effect. Rows that repeat an identifier are scored each on their own. Without
training rows of both classes every score is 0. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.llm import bigru
from playmetrics.llm.common import crc32_mod, label_sample, prepare

HELD_MODULUS, HELD_REST = 4, 2
THRESHOLD = 0.3
WINDOW, STRIDE = 48, 24
SAMPLE = 1000
BLOCK = 2048  # windows that training holds at once
UPDATES, SOFT_UPDATES, MOST_ROUNDS, BATCH = 260, 100, 30, 40
HIDDEN = 0.5  # share of a batch's words whose embedding is hidden
RATE = 0.01


# ------------------------------------------------------------------ windows

def window_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and the row it belongs to; rows without words have none."""
    counts = np.diff(offsets)
    per_row = np.where(counts > 0, 1 + np.ceil(np.maximum(counts - WINDOW, 0) / STRIDE), 0).astype(int)
    row = np.repeat(np.arange(len(counts)), per_row)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    first = np.minimum(turn * STRIDE, np.maximum(counts[row] - WINDOW, 0))
    return offsets[row] + first, row


def _grid(starts: np.ndarray, row: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Word positions of every window, -1 after the row's end."""
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < offsets[row + 1][:, None], at, -1)


@dataclass(frozen=True)
class ToxicityModel:
    params: bigru.Params | None
    shift: float = 0.0

    def scores(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(first row, scores) for runs of rows of a text column."""
        from playmetrics.llm.wordstream import slices

        for first, words in slices(texts):
            out = np.zeros(len(words.offsets) - 1)
            starts, row = window_starts(words.offsets)
            if len(starts) and self.params is not None:
                _, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
                lex = bigru.lexicon(words.hashes[at], words.starts[at], words.ends[at], words.data)
                logits = np.empty(len(starts))
                # full windows need no mask, so they go apart from short texts
                full = starts + WINDOW <= words.offsets[row + 1]
                for some in (np.flatnonzero(full), np.flatnonzero(~full)):
                    for k in range(0, len(some), 4096):
                        part = some[k:k + 4096]
                        grid = _grid(starts[part], row[part], words.offsets)
                        numbers = np.where(grid >= 0, back[np.maximum(grid, 0)], -1)
                        logits[part] = bigru.forward(self.params, lex, numbers)[0]
                rows, cuts = np.unique(row, return_index=True)
                out[rows] = bigru.sigmoid(np.maximum.reduceat(logits, cuts) + self.shift)
            yield first, out


# ------------------------------------------------------------------ training

def fit(rows: list[tuple[int, str]], share: float, seed: int = 0) -> ToxicityModel:
    """Train on (label, text) rows; ``share`` is the label's share among all labels."""
    rows = [r for r in rows if next(_windows([r[1]]))[1].size]
    labels = np.array([y for y, _ in rows], np.float32)
    if not len(rows) or labels.min() == labels.max():
        return ToxicityModel(None)
    params = bigru.initial(seed)
    adam = bigru.Adam(params, RATE)
    rng = np.random.default_rng(seed)
    updates = min(UPDATES, MOST_ROUNDS * -(-len(rows) // BATCH))
    while adam.step < updates:
        order = rng.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            batch = order[k:k + BATCH]
            words, starts, row = next(_windows([rows[i][1] for i in batch]))
            soft = adam.step < SOFT_UPDATES * updates // UPDATES
            adam.update(params, _batch_gradients(params, words, starts, row, labels[batch], soft, rng))
    odds = labels.mean() / (1 - labels.mean())
    return ToxicityModel(params, float(np.log(share / (1 - share) / odds)))


def _windows(texts: list[str]) -> Iterator[tuple]:
    """(words, first word and row of each window) of some texts in one go."""
    from playmetrics.llm.wordstream import slices

    for _, words in slices(pa.array(texts, pa.large_string()), 1 << 40):
        yield words, *window_starts(words.offsets)


def _batch_gradients(params: bigru.Params, words, starts: np.ndarray, row: np.ndarray,
                     labels: np.ndarray, soft: bool, rng: np.random.Generator,
                     hidden: float = HIDDEN, block: int = BLOCK) -> dict:
    """Gradient of the documents' mean loss over all their windows, taken in blocks."""
    _, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
    lex = bigru.lexicon(words.hashes[at], words.starts[at], words.ends[at], words.data)
    known = (rng.random(len(lex.words)) >= hidden).astype(params["out"].dtype)

    def numbers(part: np.ndarray) -> np.ndarray:
        grid = _grid(starts[part], row[part], words.offsets)
        return np.where(grid >= 0, back[np.maximum(grid, 0)], -1)

    everything = np.arange(len(starts))
    logits = np.concatenate([bigru.forward(params, lex, numbers(everything[k:k + block]), known=known)[0]
                             for k in range(0, len(starts), block)])
    slope = _pooled_slope(logits, np.bincount(row, minlength=len(labels)), labels, soft)
    felt = np.flatnonzero(slope)  # under the maximum, one window of a document
    total: dict = {}
    for k in range(0, max(len(felt), 1), block):
        part = felt[k:k + block] if len(felt) else everything[:1]
        own = numbers(part)
        _, trace = bigru.forward(params, lex, own, keep=True, known=known)
        found = bigru.gradients(params, lex, own, trace, slope[part], known)
        for name, g in found.items():
            # a batch's blocks share a lexicon, so their table rows are the same ones
            grad = g[1] if name in bigru.TABLES else g
            if name not in total:
                total[name] = (g[0], grad) if name in bigru.TABLES else grad
            else:
                (total[name][1] if name in bigru.TABLES else total[name])[...] += grad
    return total


def _pooled_slope(logits: np.ndarray, sizes: np.ndarray, labels: np.ndarray, soft: bool
                  ) -> np.ndarray:
    """Slope of the mean cross-entropy of pooled logits, in each window's logit."""
    cuts = np.cumsum(sizes) - sizes
    top = np.repeat(np.maximum.reduceat(logits, cuts), sizes)
    part = np.exp(logits - top) if soft else (logits == top).astype(logits.dtype)
    total = np.add.reduceat(part, cuts)
    pooled = top[cuts] + (np.log(total / sizes) if soft else 0)
    error = (bigru.sigmoid(pooled.astype(np.float32)) - labels) / len(labels)
    return (part * np.repeat(error / total, sizes)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE, seed: int = 3) -> ToxicityModel:
    prepare(docs.sparkSession)
    marked = (labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic"))
              .where(F.col("toxic").isin(0, 1)
                     & (crc32_mod(F.col("label_id"), HELD_MODULUS) != HELD_REST)))
    share = marked.agg(F.avg("toxic").alias("p")).first().p
    if not share or share == 1:
        return ToxicityModel(None)
    chosen = label_sample(marked.where("toxic = 1"), sample, seed, "label_id").union(
        label_sample(marked.where("toxic = 0"), 2 * sample, seed, "label_id"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = (texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id"))  # <= 3 * sample rows
             .select("id", "toxic", "text"))
    rows = sorted(((r.id, r.toxic, r.text or "") for r in found.collect()))
    return fit([(toxic, text) for _, toxic, text in rows], share)


# ------------------------------------------------------------------ scoring

def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    prepare(docs.sparkSession)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, scores in model.scores(batch.column(1)):
                n = len(scores)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(2).slice(first, n),
                     pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                    names=["id", "held_out", "score", "predicted"])

    held = F.coalesce(crc32_mod(F.col(id_col), HELD_MODULUS) == HELD_REST, F.lit(False))
    return docs.select(F.col(id_col).cast("long"), text_col, held.alias("held")).mapInArrow(
        rate, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
