"""Language-model scores by deleted interpolation over the whole corpus.

A word's probability after its context mixes three estimates: the bigram and
the unigram maximum likelihood and a uniform share,
``l2 * c(ctx, w) / c(ctx) + l1 * c(w) / N + l0 / (V + 1)``. The weights depend on
how often the context was seen (buckets of powers of two). They are learned by
expectation-maximisation on held-out counts: every training token is scored with
its own occurrence deleted from all counts.

All counts cover all training documents and stay distributed:

1. Texts become chunks: words as numbers into the chunk's sorted word hashes.
2. Each chunk sends its distinct words and bigrams, counted, to shards by ranges
   of their 64-bit hash. A word in every document is one entry per chunk, so no
   key is hot.
3. A shard adds up and answers each chunk's entries in their order.
4. A chunk meets its answers, and every token then has its counts at hand. What
   EM needs is a histogram over (context bucket, bigram estimate, unigram
   estimate), the estimates in quarter powers of two; its size does not grow
   with the corpus, so the weights are found on the driver.

Arrays travel byte-plane by byte-plane through zstd, which halves the shuffle.

Edge cases: null text reads as empty: its one token is the end. A null
identifier counts as training. Rows that repeat an identifier are scored (and
counted) each on their own. An empty table gives an empty result; without any
training row all counts are zero and only the uniform share is left. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.common import crc32_mod, prepare, settled, shuffle_partitions

HELD_MODULUS, HELD_REST = 7, 2
CHUNK_TOKENS = 2_000_000
SLICE_BYTES = 1 << 20
END = 0x9D5C1F3A7B24E681
START = 0x5EED0FA11C0FFEE1
STEPS_PER_OCTAVE = 4
LEVELS = 64 * STEPS_PER_OCTAVE  # quantised estimates reach 2 ** -64; the level LEVELS is zero
BUCKETS = 64
EM_ROUNDS = 60


# ------------------------------------------------------------------ arrays as bytes

def squeeze(a: np.ndarray) -> bytes:
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    head = np.array([len(a)], "<u8").tobytes() + a.dtype.str.encode().ljust(8)
    return head + (pa.compress(planes, codec="zstd", asbytes=True) if len(a) else b"")


def unsqueeze(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data[:8], "<u8")[0])
    dtype = np.dtype(data[8:16].decode().strip())
    if not n:
        return np.zeros(0, dtype)
    planes = pa.decompress(data[16:], n * dtype.itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(dtype.itemsize, n).T.copy().view(dtype).reshape(-1)


def _sorted_out(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def _sorted_in(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data), dtype=np.uint64)


# ------------------------------------------------------------------ chunks

CHUNK = ("chunk long, doc_ids array<long>, held array<boolean>, offsets binary, vocab binary, "
         "tokens binary, train_tokens long, train_docs long")


def _chunk_row(number: int, ids: list, held: list[bool], hashes: list[np.ndarray],
               lengths: list[np.ndarray]) -> pa.RecordBatch:
    words, counts = np.concatenate(hashes), np.concatenate(lengths)
    past = np.cumsum(counts)
    # the end stands after each text's words
    words = np.insert(words, past, np.uint64(END))
    offsets = np.concatenate([[0], past + np.arange(1, len(past) + 1)]).astype(np.int64)
    vocab, tokens = np.unique(words, return_inverse=True)
    train = ~np.array(held)
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([ids], pa.list_(pa.int64())),
         pa.array([held], pa.list_(pa.bool_())), pa.array([squeeze(offsets)]),
         pa.array([_sorted_out(vocab)]), pa.array([squeeze(tokens.astype(np.uint32))]),
         pa.array([int(np.diff(offsets)[train].sum())]), pa.array([int(train.sum())])],
        names=[c.split()[0] for c in CHUNK.split(", ")])


def chunks(docs: DataFrame, id_col: str, text_col: str, tokens: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import slices

        number = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list[bool] = []
        hashes: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for first, words in slices(batch.column(1), SLICE_BYTES):
                n = len(words.offsets) - 1
                ids += batch.column(0).slice(first, n).to_pylist()
                held += batch.column(2).slice(first, n).to_pylist()
                hashes.append(words.hashes)
                lengths.append(np.diff(words.offsets))
                size += len(words.hashes) + n
                if size >= tokens:
                    yield _chunk_row(number, ids, held, hashes, lengths)
                    number, ids, held, hashes, lengths, size = number + 1, [], [], [], [], 0
        if ids:
            yield _chunk_row(number, ids, held, hashes, lengths)

    held = F.coalesce(crc32_mod(F.col(id_col), HELD_MODULUS) == HELD_REST, F.lit(False))
    return docs.select(F.col(id_col).cast("long"), text_col, held.alias("held")).mapInArrow(
        cut, CHUNK)


@dataclass(frozen=True)
class Chunk:
    """Tokens of some documents; a context number of ``len(vocab)`` is the start of a text."""

    offsets: np.ndarray
    held: np.ndarray
    vocab: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Chunk:
        return cls(unsqueeze(row["offsets"]), np.array(row["held"], bool), _sorted_in(row["vocab"]),
                   unsqueeze(row["tokens"]).astype(np.int64))

    @property
    def train(self) -> np.ndarray:
        """Which tokens are of training documents."""
        return np.repeat(~self.held, np.diff(self.offsets))

    @property
    def contexts(self) -> np.ndarray:
        out = np.empty_like(self.tokens)
        out[1:] = self.tokens[:-1]
        out[self.offsets[:-1]] = len(self.vocab)
        return out

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the distinct bigrams; the number of each token's bigram in them."""
        from playmetrics.llm.wordstream import mix

        size = len(self.vocab) + 1
        pairs, back = np.unique(self.contexts * size + self.tokens, return_inverse=True)
        hashes = np.append(self.vocab, np.uint64(START))
        keys = mix(hashes[pairs // size] * np.uint64(0x9E3779B97F4A7C15) + hashes[pairs % size])
        order = np.argsort(keys)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        return keys[order], place[back]


# ------------------------------------------------------------------ counting in shards

BLOCK = "kind int, shard int, chunk long, keys binary, counts binary"
ANSWER = "kind int, shard int, chunk long, totals binary, distinct long"


def _smallest(a: np.ndarray) -> np.ndarray:
    most = int(a.max(initial=0))
    return a.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def totals(cut: DataFrame, shards: int) -> DataFrame:
    """For every chunk, kind (1 words, 2 bigrams) and shard: corpus counts of its entries."""
    bounds = np.array([(s << 64) // shards for s in range(1, shards)], dtype=np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.of(row)
                train = chunk.train
                keys, back = chunk.bigrams()
                for kind, entries, number in ((1, chunk.vocab, chunk.tokens), (2, keys, back)):
                    counts = _smallest(np.bincount(number[train], minlength=len(entries)))
                    ends = np.concatenate([[0], np.searchsorted(entries, bounds), [len(entries)]])
                    parts = [(s, a, b) for s, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))
                             if a < b]
                    n = len(parts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * n, pa.int32()),
                         pa.array([s for s, _, _ in parts], pa.int32()),
                         pa.array([row["chunk"]] * n, pa.int64()),
                         pa.array([_sorted_out(entries[a:b]) for _, a, b in parts], pa.binary()),
                         pa.array([squeeze(counts[a:b]) for _, a, b in parts], pa.binary())],
                        names=[c.split()[0] for c in BLOCK.split(", ")])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [_sorted_in(k) for k in frame["keys"]]
        counts = np.concatenate([unsqueeze(c).astype(np.float64) for c in frame["counts"]])
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, counts, len(distinct)).astype(np.uint64)
        answers = np.split(total[back], np.cumsum([len(k) for k in keys])[:-1])
        seen = np.zeros(len(frame), np.int64)
        seen[0] = int((total > 0).sum())
        return pd.DataFrame({"kind": frame["kind"], "shard": frame["shard"], "chunk": frame["chunk"],
                             "totals": [squeeze(_smallest(a)) for a in answers], "distinct": seen})

    return cut.mapInArrow(send, BLOCK).groupBy("kind", "shard").applyInPandas(add_up, ANSWER)


# ------------------------------------------------------------------ mixing

@dataclass(frozen=True)
class Corpus:
    """Training tokens, distinct training tokens, training documents."""

    tokens: int
    types: int
    docs: int


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2(count))."""
    return np.frexp(context_count.astype(np.float64))[1]


def _level(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        steps = np.round(-np.log2(p) * STEPS_PER_OCTAVE)
    return np.where(p > 0, np.minimum(steps, LEVELS - 1), LEVELS).astype(np.int64)


def _value(level: np.ndarray) -> np.ndarray:
    return np.where(level == LEVELS, 0.0, 2.0 ** (-level / STEPS_PER_OCTAVE))


def deleted_cells(c12: np.ndarray, c1: np.ndarray, c2: np.ndarray, corpus: Corpus) -> np.ndarray:
    """Histogram cell of each training token, its own occurrence deleted from the counts."""
    p2 = (c12 - 1) / np.maximum(c1 - 1, 1)
    p1 = (c2 - 1) / max(corpus.tokens - 1, 1)
    return (bucket(c1 - 1) * (LEVELS + 1) + _level(p2)) * (LEVELS + 1) + _level(p1)


def learn(cells: np.ndarray, counts: np.ndarray, corpus: Corpus, rounds: int = EM_ROUNDS
          ) -> np.ndarray:
    """Weights (bucket, [uniform, unigram, bigram]) by EM; empty buckets take the pooled ones."""
    uniform = 1 / (corpus.types + 1)
    estimates = np.stack([np.full(len(cells), uniform), _value(cells % (LEVELS + 1)),
                          _value(cells // (LEVELS + 1) % (LEVELS + 1))], axis=1)
    of = cells // (LEVELS + 1) ** 2

    def em(p: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = np.full(3, 1 / 3)
        for _ in range(rounds):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (n @ share + 1e-9) / (n.sum() + 3e-9)
        return w

    weights = np.empty((BUCKETS + 1, 3))
    weights[:] = em(estimates, counts) if len(cells) else [1, 0, 0]
    for b in np.unique(of).tolist():
        weights[b] = em(estimates[of == b], counts[of == b])
    # an unseen context has no bigram estimate: its share goes to the others
    weights[0, 2] = 0
    return weights / weights.sum(axis=1, keepdims=True)


COUNTED = ("doc_ids array<long>, held array<boolean>, offsets binary, words binary, bigrams binary, "
           "cells array<long>, cell_counts array<long>, types long")
SCORED = ("id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def _context_counts(words: np.ndarray, starts: np.ndarray, docs: int) -> np.ndarray:
    """How often each token's context was seen: the count of the token before it."""
    out = np.empty(len(words))
    out[1:] = words[:-1]
    out[starts] = docs
    return out


def count(cut: DataFrame, answers: DataFrame, corpus: Corpus) -> DataFrame:
    """Chunks as corpus counts: of each token's word and of its bigram.

    ``types`` adds up to the distinct training words over all rows.
    """
    by_chunk = answers.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("kind", "shard", "totals"))).alias("answers"),
        F.sum(F.when(F.col("kind") == 1, F.col("distinct"))).alias("types"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk.of(row)
                got = {kind: np.concatenate([unsqueeze(a["totals"]).astype(np.uint64)
                                             for a in row["answers"] if a["kind"] == kind])
                       for kind in (1, 2)}
                words, pairs = got[1][chunk.tokens], got[2][chunk.bigrams()[1]]
                c2, c12 = words.astype(np.float64), pairs.astype(np.float64)
                c1 = _context_counts(c2, chunk.offsets[:-1], corpus.docs)
                train = chunk.train
                cells, counts = np.unique(
                    deleted_cells(c12[train], c1[train], c2[train], corpus), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"]], pa.list_(pa.int64())),
                     pa.array([row["held"]], pa.list_(pa.bool_())), pa.array([row["offsets"]]),
                     pa.array([squeeze(_smallest(words))]), pa.array([squeeze(_smallest(pairs))]),
                     pa.array([cells], pa.list_(pa.int64())),
                     pa.array([counts], pa.list_(pa.int64())), pa.array([row["types"]], pa.int64())],
                    names=[c.split()[0] for c in COUNTED.split(", ")])

    return cut.join(by_chunk, "chunk").mapInArrow(meet, COUNTED)


def rate(counted: DataFrame, corpus: Corpus, weights: np.ndarray) -> DataFrame:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets = unsqueeze(row["offsets"])
                c = unsqueeze(row["words"]).astype(np.float64)
                c12 = unsqueeze(row["bigrams"]).astype(np.float64)
                starts = offsets[:-1]
                c1 = _context_counts(c, starts, corpus.docs)
                w = weights[bucket(c1)]
                p = (w[:, 0] / (corpus.types + 1) + w[:, 1] * c / max(corpus.tokens, 1)
                     + w[:, 2] * c12 / np.maximum(c1, 1))
                base = np.log10((c + 1) / (corpus.tokens + corpus.types + 1))
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
                     pa.array(np.diff(offsets)), pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)),
                     pa.array([corpus.tokens] * n, pa.int64()),
                     pa.array(np.add.reduceat(base, starts)),
                     pa.array(np.add.reduceat(np.log10(p), starts))],
                    names=[x.split()[0] for x in SCORED.split(", ")])

    return counted.mapInArrow(score, SCORED)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Every row's token counts, add-one unigram score and interpolated score (log10)."""
    spark = prepare(docs.sparkSession)
    cut = chunks(docs, id_col, text_col, chunk_tokens).transform(settled)
    sums = cut.agg(F.sum("train_tokens").alias("tokens"), F.sum("train_docs").alias("docs")).first()
    seen = Corpus(sums.tokens or 0, 0, sums.docs or 0)
    # settled apart, so that the blocks are gone before the chunks are dealt out
    answers = totals(cut, shuffle_partitions(spark)).transform(settled)
    counted = count(cut, answers, seen).transform(settled)
    types = counted.agg(F.sum("types").alias("n")).first().n
    corpus = Corpus(seen.tokens, types or 0, seen.docs)
    cells = (counted.select(F.explode(F.arrays_zip("cells", "cell_counts")).alias("x"))
             .groupBy("x.cells").agg(F.sum("x.cell_counts").alias("n")).orderBy("cells").collect())
    weights = learn(np.array([r.cells for r in cells], np.int64),
                    np.array([r.n for r in cells], np.float64), corpus)
    return rate(counted, corpus, weights).withColumnRenamed("id", id_col)
