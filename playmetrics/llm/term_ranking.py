"""Ranked lexical search, term at a time with a limited set of accumulators.

Two passes over the documents, whatever their number:

1. Document frequencies of the terms that the items use, the number of documents
   with terms and of all their terms; summed in each task, then by Spark.
2. Each task indexes its documents shard by shard (postings of the items' terms
   only, ``SHARD_POSTINGS`` at most but for one document) and answers every item on
   the shard. Spark merges the shards' best.

On a shard an item's terms are read rarest first. While a document that has no
accumulator yet could still reach the k-th best partial score, postings make new
accumulators. Once the sum of the remaining terms' bounds (weight times the term's
largest impact in the shard) is below that score, no more are made; those that can
still reach it are updated exactly with the remaining terms, the others go. A
document that only holds frequent terms thus never gets an accumulator. Scores are
integers, so every score returned is exact, and a document that ties with the
k-th is never lost.

Terms are known by 64-bit hashes of their lower-cased bytes (two different terms
share one with a chance of about 2**-60). Items are read in blocks of about
``BLOCK_TERMS`` (item, term) pairs, which is what bounds the data sent to workers.

Edge cases: null and empty texts have no terms, and such documents are not counted;
repeated document rows are documents of their own; equal items (identifier and
text) count once; a null document identifier comes last among equal scores; an
item without terms, and either table being empty, gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled

TOP = 20
SHARD_POSTINGS = 4_000_000
SHARD_DOCUMENTS = 500_000
BLOCK_TERMS = 1_000_000
FOUND = "item int, doc_id long, score long"

# bytes that are no part of a term: ASCII other than letters and digits
OUTSIDE = np.ones(256, dtype=bool)
OUTSIDE[0x80:] = False
for _first, _last in ("09", "AZ", "az"):
    OUTSIDE[ord(_first):ord(_last) + 1] = False


# ------------------------------------------------------------------ terms and statistics

def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, key, term, times) of rows (item_id, key, text)."""
    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import slices

        for batch in batches:
            for first, words in slices(batch.column(2), outside=OUTSIDE):
                row = np.repeat(np.arange(first, first + len(words.offsets) - 1),
                                np.diff(words.offsets))
                pairs = np.empty(len(row), dtype=[("row", np.int64), ("term", np.uint64)])
                pairs["row"], pairs["term"] = row, words.hashes
                distinct, times = np.unique(pairs, return_counts=True)
                at = pa.array(distinct["row"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(distinct["term"].view(np.int64)), pa.array(times)],
                    names=["item_id", "key", "term", "times"])

    return items.mapInArrow(terms, "item_id long, key long, term long, times long")


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are in the sorted vocabulary, and their places there."""
    place = np.searchsorted(vocabulary, hashes)
    place[place == len(vocabulary)] = 0
    known = vocabulary[place] == hashes
    return known, place[known]


def _postings(words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences) of the vocabulary's terms in a slice, ordered by row."""
    counts = np.diff(words.offsets)
    known, place = _known(words.hashes, vocabulary)
    row = np.repeat(np.arange(len(counts)), counts)[known]
    codes, times = np.unique(row * len(vocabulary) + place, return_counts=True)
    return codes // len(vocabulary), codes % len(vocabulary), times


def _statistics(texts: DataFrame, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the documents that hold each term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import slices

        holders = np.zeros(len(vocabulary) + 2, np.int64)
        for batch in batches:
            for _, words in slices(batch.column(1), outside=OUTSIDE):
                _, term, _ = _postings(words, vocabulary)
                holders[:-2] += np.bincount(term, minlength=len(vocabulary))
                holders[-2] += np.count_nonzero(np.diff(words.offsets))
                holders[-1] += len(words.hashes)
        some = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(holders[some])],
                                         names=["place", "n"])

    rows = (texts.mapInArrow(count, "place long, n long").groupBy("place")
            .agg(F.sum("n").alias("n")).collect())  # one row a term of the block
    totals = np.zeros(len(vocabulary) + 2, np.int64)
    for place, n in rows:
        totals[place] = n
    return int(totals[-2]), int(totals[-1]), totals[:-2]


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def impacts(times: np.ndarray, sizes: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What an occurrence count is worth in a document of ``sizes`` terms, before the weight."""
    m = 100 - 25 + (25 * sizes * documents) // terms
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


# ------------------------------------------------------------------ one shard

@dataclass
class Shard:
    """Postings of a shard: term t's documents are ``docs[starts[t]:starts[t + 1]]``, ascending."""

    starts: np.ndarray
    docs: np.ndarray
    impact: np.ndarray
    best: np.ndarray  # largest impact of each term, 0 where it does not occur
    size: int

    @classmethod
    def of(cls, docs: np.ndarray, terms: np.ndarray, impact: np.ndarray, vocabulary: int,
           size: int) -> Shard:
        order = np.lexsort((docs, terms))
        starts = np.searchsorted(terms[order], np.arange(vocabulary + 1))
        best = np.zeros(vocabulary, np.int64)
        np.maximum.at(best, terms, impact)
        return cls(starts, docs[order], impact[order], best, size)


def rank(shard: Shard, terms: np.ndarray, weights: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of a shard that may be among the best k, their scores, and accumulators made.

    ``terms`` come rarest first. Every document with one of the shard's k highest
    scores is returned, with its exact score.
    """
    here = shard.best[terms] > 0
    terms, weights = terms[here], weights[here]
    bounds = weights * shard.best[terms]
    left = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # left[i]: what terms i and on can add
    score = np.zeros(shard.size, np.int64)
    has = np.zeros(shard.size, bool)
    live = np.zeros(0, np.int64)
    made, growing, kth = 0, True, 0
    for i, term in enumerate(terms.tolist()):
        if len(live) >= k:
            kth = np.partition(score[live], len(live) - k)[len(live) - k]
            growing = growing and left[i] >= kth  # an equal score may win by its identifier
        docs = shard.docs[shard.starts[term]:shard.starts[term + 1]]
        gain = weights[i] * shard.impact[shard.starts[term]:shard.starts[term + 1]]
        if growing:
            score[docs] += gain
            new = docs[~has[docs]]
            has[new] = True
            live = np.concatenate([live, new])
            made += len(new)
        else:
            live = live[score[live] + left[i] >= kth]
            at = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
            hit = docs[at] == live
            score[live[hit]] += gain[at[hit]]
    live = live[score[live] > 0]
    if len(live) > k:
        live = live[score[live] >= np.partition(score[live], len(live) - k)[len(live) - k]]
    return live, score[live], made


def _best(shard: Shard, ids: pa.Array, questions: list, k: int) -> Iterator[pa.RecordBatch]:
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy()
    items, docs, scores = [], [], []
    for item, terms, weights in questions:
        found, score, _ = rank(shard, terms, weights, k)
        order = np.lexsort((numbers[found], ~known[found], -score))[:k]
        items.append(np.full(len(order), item, np.int32))
        docs.append(found[order])
        scores.append(score[order])
    if items:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(items)), ids.take(pa.array(np.concatenate(docs))),
             pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"])


# ------------------------------------------------------------------ all documents

def _search(texts: DataFrame, pairs: DataFrame, k: int) -> DataFrame | None:
    """(item_id, key, doc_id, score): each shard's best for the items of a block."""
    table = pairs.toArrow()
    if not len(table):
        return None
    vocabulary, place = np.unique(table["term"].to_numpy().view(np.uint64), return_inverse=True)
    documents, terms, holders = _statistics(texts, vocabulary)
    keys, item_of = np.unique(table["key"].to_numpy(), return_inverse=True)
    weights = np.array([weight(documents, n) for n in holders.tolist()], np.int64)
    order = np.lexsort((place, holders[place], item_of))
    cuts = np.searchsorted(item_of[order], np.arange(len(keys) + 1))
    times = table["times"].to_numpy()
    questions = []
    for item in range(len(keys)):
        mine = order[cuts[item]:cuts[item + 1]]
        questions.append((item, place[mine], weights[place[mine]] * times[mine]))
    sent = texts.sparkSession.sparkContext.broadcast((vocabulary, questions))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from playmetrics.llm.wordstream import slices

        words_of, asked = sent.value
        ids, parts, size, held = [], [], 0, 0

        def answer() -> Iterator[pa.RecordBatch]:
            docs, places, impact = (np.concatenate(x) for x in zip(*parts, strict=True))
            shard = Shard.of(docs, places, impact, len(words_of), size)
            yield from _best(shard, pa.concat_arrays(ids), asked, k)

        for batch in batches:
            for first, words in slices(batch.column(1), outside=OUTSIDE):
                row, place, count = _postings(words, words_of)
                sizes = np.diff(words.offsets)
                parts.append((row + size, place, impacts(count, sizes[row], documents, terms)))
                ids.append(batch.column(0).slice(first, len(sizes)))
                size, held = size + len(sizes), held + len(row)
                if held >= SHARD_POSTINGS or size >= SHARD_DOCUMENTS:
                    yield from answer()
                    ids, parts, size, held = [], [], 0, 0
        if parts:
            yield from answer()

    first_of = np.unique(item_of, return_index=True)[1]
    names = texts.sparkSession.createDataFrame(
        pa.table({"item": pa.array(np.arange(len(keys)), pa.int32()), "key": pa.array(keys),
                  "item_id": table["item_id"].take(pa.array(first_of))}))
    return texts.mapInArrow(search, FOUND).join(F.broadcast(names), "item").drop("item")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS,
           id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``top`` documents with a score above 0."""
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"))
    asked = (items.select(F.col(item_id_col).cast("long").alias("item_id"),
                          F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
             .select("item_id", F.xxhash64("item_id", "text").alias("key"), "text"))
    pairs = item_terms(asked).transform(settled)
    blocks = -(-pairs.count() // block_terms)
    found = spark.createDataFrame([], "key long, item_id long, doc_id long, score long")
    for block in range(blocks):
        part = _search(texts, pairs.where(F.pmod("key", F.lit(blocks)) == block), top)
        if part is not None:
            found = found.unionByName(part)
    best = Window.partitionBy("item_id", "key").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select(F.col("item_id").alias(item_id_col), "rank",
                    F.col("doc_id").alias(id_col), "score"))
