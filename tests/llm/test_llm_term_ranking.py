"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from helpers import DOC_SCHEMA, documents, odd_documents

from playmetrics.llm import term_ranking as T

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    """docs, items: lists of (id, text)."""
    found = [(i, terms_of(t)) for i, t in docs]
    found = [(i, t) for i, t in found if t]
    n_docs, n_terms = len(found), sum(len(t) for _, t in found)
    df = Counter(w for _, t in found for w in set(t))
    out = []
    for item, text in set(items):
        scores = []
        for doc, ts in found:
            m = 100 - 25 + (25 * len(ts) * n_docs) // n_terms
            tf = Counter(ts)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 12 * m))
                        for w in terms_of(text) if tf[w])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, doc, -score))
    return out


def check(docs, items, top=20, **options):
    got = T.ranked(docs, items, top=top, **options).collect()
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()],
                 [tuple(r) for r in items.select("item_id", "text").collect()], top)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    return got


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ünï", "ünï", "X9", "Éa"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [rng.choice([" ", "-", "\n", "; "]).join(rng.choices(words, weights, k=rng.randint(1, 60)))
            for _ in range(n)], rng


def test_equals_plain_scoring(spark):
    texts, rng = corpus(1, 600)
    texts += texts[:40]  # ties
    items = [(i, " ".join(rng.choices(texts, k=1))) for i in range(25)] + [(90, "w0 w0 w1"),
                                                                          (91, "nowhere")]
    docs = documents(spark, texts).repartition(5)
    assert check(docs, spark.createDataFrame(items, ITEMS), top=7)
    check(docs, spark.createDataFrame(items, ITEMS), top=7, block_terms=40)


def test_small_shards_change_nothing(spark, monkeypatch):
    texts, rng = corpus(2, 150)
    items = spark.createDataFrame([(1, texts[3]), (2, texts[9] + " w0"), (2, "w1 w2")], ITEMS)
    monkeypatch.setattr(T, "SHARD_DOCUMENTS", 1)
    check(documents(spark, texts).repartition(3), items, top=5)


def test_accumulators_stop_growing():
    """Documents that only hold a frequent term get no accumulator; scores stay exact."""
    rng = np.random.default_rng(4)
    size = 5000
    docs = np.concatenate([np.arange(size), rng.choice(size, 200, replace=False),
                           rng.choice(size, 90, replace=False)])
    terms = np.repeat([0, 1, 2], [size, 200, 90])
    impact = rng.integers(400_000, 900_000, len(docs))
    shard = T.Shard.of(docs, terms, impact, 3, size)
    weights = {0: 1, 1: 3000, 2: 4200}
    order = np.array([2, 1, 0])
    found, scores, made = T.rank(shard, order, np.array([weights[t] for t in order]), 20)
    assert made <= 290
    plain_scores = np.zeros(size, np.int64)
    for doc, term, gain in zip(docs, terms, impact, strict=True):
        plain_scores[doc] += weights[int(term)] * gain
    best = np.sort(plain_scores)[::-1][:20]
    assert sorted(scores.tolist(), reverse=True)[:20] == best.tolist()
    assert (plain_scores[found] == scores).all()


def test_odd_rows(spark):
    items = [(1, "one word"), (1, "one word"), (1, "ärger ÄRGER one"), (None, "many text"),
             (3, None), (4, ""), (5, "??"), (6, "Long TEXT with a a a")]
    check(odd_documents(spark), spark.createDataFrame(items, ITEMS))


def test_clashing_columns_and_empty_tables(spark):
    docs = documents(spark, ["a b c", "a b", "c"]).selectExpr("*", "1 item", "2 score", "3 `rank`")
    items = spark.createDataFrame([(1, "a c", 5)], ITEMS + ", doc_id int")
    check(docs, items)
    none, nothing = spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame([], ITEMS)
    assert T.ranked(none, items).count() == 0
    assert T.ranked(docs, nothing).count() == 0
    assert T.ranked(documents(spark, ["", None, "."]), items).count() == 0
