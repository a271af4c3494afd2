import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOC_SCHEMA, documents, odd_documents

from playmetrics.llm import bigru, toxicity
from playmetrics.llm.wordstream import slices

LABELS = "doc_id long, quality int, toxic int"


def setup(texts, dtype=np.float64):
    params = bigru.initial(1, dtype)
    _, words = next(slices(pa.array(texts), 1 << 30))
    _, at, back = np.unique(words.hashes, return_index=True, return_inverse=True)
    lex = bigru.lexicon(words.hashes[at], words.starts[at], words.ends[at], words.data)
    grid = toxicity._grid(words.offsets[:-1], np.arange(len(texts)), words.offsets)[:, :9]
    return params, lex, np.where(grid >= 0, back[np.maximum(grid, 0)], -1)


def test_gradients_equal_differences():
    params, lex, windows = setup(["the quick brown fox", "lazy dogs", "a b c d e f g h i j", "fox the fox"])
    weights = np.array([0.7, -1.1, 0.4, 2.0])
    logits, trace = bigru.forward(params, lex, windows, keep=True)
    found = bigru.gradients(params, lex, windows, trace, weights)
    rng = np.random.default_rng(0)
    for name, value in params.items():
        grad = found[name]
        if name in bigru.TABLES:
            grad = np.zeros_like(value)
            grad[found[name][0]] = found[name][1]
        flat, own = value.reshape(-1), grad.reshape(-1)
        places = np.flatnonzero(own)
        assert len(places), name
        for k in rng.choice(places, min(6, len(places)), replace=False):
            old = flat[k]
            flat[k] = old + 1e-6
            up = weights @ bigru.forward(params, lex, windows)[0]
            flat[k] = old - 1e-6
            down = weights @ bigru.forward(params, lex, windows)[0]
            flat[k] = old
            assert abs((up - down) / 2e-6 - own[k]) < 1e-5 * max(1, abs(own[k])), name


def test_words_after_the_end_do_not_matter():
    params, lex, windows = setup(["the quick fox", "lazy dogs and cats run far"])
    both = bigru.forward(params, lex, windows)[0]
    alone = bigru.forward(params, lex, windows[:1, :3])[0]
    assert abs(both[0] - alone[0]) < 1e-12


@pytest.mark.parametrize("n", [0, 1, 47, 48, 49, 72, 73, 500])
def test_windows_cover_every_word_and_overlap(n):
    offsets = np.array([0, n, n + 3])
    starts, row = toxicity.window_starts(offsets)
    own = starts[row == 0]
    covered = {w for s in own for w in range(s, min(s + toxicity.WINDOW, n))}
    assert covered == set(range(n)) and (row == 1).sum() == 1
    assert all(b - a <= toxicity.STRIDE for a, b in zip(own, own[1:]))


def corpus(spark, n=360, seed=3):
    rng = random.Random(seed)
    parts = ["the", "and", "ing", "tion", "er", "on", "re", "st"]
    bad = ["vile%s" % p for p in parts] + ["nasty"]
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4)))
                 for _ in range(rng.randrange(10, 160))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append((i + 1, 1, int(toxic)))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS), labels


def test_held_out_accuracy_and_no_leak(spark):
    docs, labels, truth = corpus(spark)
    # held-out labels are wrong on purpose: they must not be seen
    spoiled = spark.createDataFrame(
        [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in truth], LABELS)
    rows = {r.doc_id: r for r in toxicity.toxicity(docs, spoiled).collect()}
    held = [(rows[d], t) for d, _, t in truth if rows[d].held_out]
    assert [r.held_out for r in rows.values()] == [
        zlib.crc32(str(d).encode()) % 4 == 2 for d in rows]
    assert len(held) > 60
    right = [r.predicted == t for r, t in held]
    assert np.mean(right) > 0.95
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows.values())


def test_scores_equal_one_text_at_a_time(spark):
    docs, labels, _ = corpus(spark, 60)
    model = toxicity.train(docs, labels)
    rows = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        words = r.text.split()
        starts = [*range(0, max(len(words) - toxicity.WINDOW, 0), toxicity.STRIDE),
                  max(len(words) - toxicity.WINDOW, 0)]
        best = 0.0
        for a in starts:
            window = " ".join(words[a:a + toxicity.WINDOW])
            best = max(best, float(next(model.scores(pa.array([window])))[1][0]))
        assert abs(rows[r.doc_id] - best) < 1e-5


def test_blocks_do_not_change_a_gradient():
    texts = [" ".join(f"w{(i * 7 + k) % 50}" for k in range(n)) for i, n in enumerate((300, 20, 90))]
    words, starts, row = next(toxicity._windows(texts))
    params = bigru.initial(2, np.float64)
    for soft in (True, False):
        whole, parts = (toxicity._batch_gradients(
            params, words, starts, row, np.array([1.0, 0.0, 0.0]), soft, np.random.default_rng(4),
            block=block) for block in (1000, 3))
        for name, g in whole.items():
            pairs = zip(g, parts[name], strict=True) if name in bigru.TABLES else [(g, parts[name])]
            assert all(np.allclose(a, b, atol=1e-6) for a, b in pairs), name


def test_a_toxic_place_anywhere_in_long_texts_is_learned_from():
    """A third of the texts have 60 windows of which one or two hold a toxic word, and every
    text has a very long word."""
    rng = random.Random(8)
    clean = ["calm%d" % i for i in range(300)]

    def text(toxic, size):
        words = rng.choices(clean, k=size) + ["x" * 5000]
        if toxic:
            words[rng.randrange(size)] = rng.choice(("vileness", "vilely", "nasty"))
        return " ".join(words)

    rows = [(i % 2, text(i % 2, 1500 if i % 3 == 0 else rng.randrange(20, 200))) for i in range(120)]
    model = toxicity.fit(rows, 0.5)
    sizes = (30, 1500, 15000)
    bad, good = ([float(next(model.scores(pa.array([text(t, n)])))[1][0]) for n in sizes] for t in (1, 0))
    assert min(bad) >= 0.3 and max(good[:2]) < 0.3 and bad[2] > good[2]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.toxicity(docs, none).collect()] == [0.0] * 10
    odd = spark.createDataFrame([(4, 1, 1), (5, None, None), (None, 1, 1), (6, 1, 0), (77, 1, 1)], LABELS)
    rows = toxicity.toxicity(docs, odd).collect()
    assert len(rows) == 10 and {r.score for r in rows if r.doc_id in (1, 2, 3)} == {0.0}
    assert toxicity.toxicity(spark.createDataFrame([], DOC_SCHEMA), odd).count() == 0
