import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_documents

from playmetrics.llm import interpolation as lm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def brute(rows):
    """Plain dictionaries; exact estimates in EM where the operator quantises them."""
    uni, bi, ctx = Counter(), Counter(), Counter()
    for doc, text in rows:
        if not held(doc):
            words = tokens(text)
            for a, b in zip(["<start>", *words], words):
                uni[b] += 1
                bi[a, b] += 1
                ctx[a] += 1
    n, v = sum(uni.values()), len(uni)
    seen = {}
    for (a, b), c in bi.items():
        seen.setdefault((ctx[a] - 1).bit_length(), []).append(
            (c, [1 / (v + 1), (uni[b] - 1) / max(n - 1, 1), (c - 1) / max(ctx[a] - 1, 1)]))

    def em(cells):
        w = [1 / 3] * 3
        for _ in range(lm.EM_ROUNDS):
            total = [0.0] * 3
            for c, p in cells:
                s = sum(x * y for x, y in zip(w, p))
                for k in range(3):
                    total[k] += c * w[k] * p[k] / s
            w = [t / sum(total) for t in total]
        return w

    weights = {b: em(cells) for b, cells in seen.items()}
    pooled = em([x for cells in seen.values() for x in cells]) if seen else [1, 0, 0]
    out = {}
    for doc, text in rows:
        words = tokens(text)
        base = sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in words)
        score = 0.0
        for a, b in zip(["<start>", *words], words):
            w = list(weights.get(ctx[a].bit_length(), pooled))
            if not ctx[a]:
                w[2] = 0
                w = [x / sum(w) for x in w]
            score += math.log10(w[0] / (v + 1) + w[1] * uni[b] / max(n, 1)
                                + w[2] * bi[a, b] / max(ctx[a], 1))
        out[doc, text] = (held(doc), len(words), sum(uni[w] > 0 for w in words), n, base, score)
    return out


def corpus(n=300):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)]
    texts = []
    for _ in range(n):
        at, text = rng.randrange(60), []
        for _ in range(rng.randrange(0, 40)):
            at = (at * 7 + rng.choice((1, 1, 1, 2, 30))) % 60
            text.append(words[at] if rng.random() < 0.95 else "Rare%d" % rng.randrange(500))
        texts.append(" ".join(text))
    return texts


@pytest.mark.parametrize("chunk_tokens", [50, 2_000_000])
def test_scores_equal_brute_force(spark, chunk_tokens):
    docs = documents(spark, corpus())
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    rows = lm.scores(docs, chunk_tokens=chunk_tokens).collect()
    assert len(rows) == 300
    text_of = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        h, n, known, total, base, score = expected[r.doc_id, text_of[r.doc_id]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, known, total)
        assert abs(r.base_score - base) < 1e-9 * max(1, abs(base))
        assert abs(r.score - score) < 0.01 * abs(score) + 0.01  # quantised estimates in EM


def test_interpolation_beats_the_base_on_held_out_texts(spark):
    rows = [r for r in lm.scores(documents(spark, corpus(1500))).collect() if r.held_out]
    assert len(rows) > 100
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.9


def test_probabilities_sum_to_at_most_one():
    corpus_ = lm.Corpus(100, 9, 5)
    cells = lm.deleted_cells(np.array([1., 5, 2]), np.array([1., 9, 40]), np.array([1., 30, 3]), corpus_)
    weights = lm.learn(cells, np.ones(3), corpus_)
    assert np.allclose(weights.sum(axis=1), 1) and (weights >= 0).all() and weights[0, 2] == 0


def test_arrays_survive_the_journey():
    for a in (np.zeros(0, np.uint16), np.arange(5, dtype=np.int64), np.array([2**63], np.uint64)):
        b = lm.unsqueeze(lm.squeeze(a))
        assert a.dtype == b.dtype and (a == b).all()
    s = np.sort(np.random.default_rng(0).integers(0, 2**64 - 1, 1000, dtype=np.uint64))
    assert (lm._sorted_in(lm._sorted_out(s)) == s).all()


def test_odd_rows_and_no_training_rows(spark):
    docs = odd_documents(spark)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    rows = lm.scores(docs).collect()
    assert len(rows) == 10
    key = lambda x: str(x)
    got = sorted(((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in rows), key=key)
    want = [(*expected[r.doc_id, r.text][:4], round(expected[r.doc_id, r.text][4], 6))
            for r in docs.collect()]
    assert got == sorted(want, key=key)
    only_held = documents(spark, ["a b"], next(i for i in range(100) if held(i)))
    row = lm.scores(only_held).first()
    assert (row.train_tokens, row.n_known, row.base_score, row.score) == (0, 0, 0.0, 0.0)
    assert lm.scores(documents(spark, [])).count() == 0
