import random
import re

import numpy as np
from helpers import DOC_SCHEMA, documents, odd_documents

from playmetrics.llm import ordinal_quality as oq

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=240, seed=2):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "house", "river", "stone"]
    texts, labels = [], []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        kind = i % 4
        if kind == 0:
            body = [w.upper() + "!!" for w in body]
        if kind == 1:
            body[::4] = ["vile"] * len(body[::4])
        texts.append(" ".join(body))
        labels.append((i + 1, int(kind != 0), int(kind == 1)))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS), labels


def test_grades_are_learned_and_hold_on_other_texts(spark):
    docs, labels, truth = corpus(spark)
    train = labels.where("doc_id % 3 > 0")
    rows = {r.doc_id: r for r in oq.score(docs, oq.train(docs, train)).collect()}
    held = [(rows[d], q, t) for d, q, t in truth if d % 3 == 0]
    assert all(r.selected == bool(q) for r, q, _ in held)
    good = [r.expected_grade for r, q, t in held if q and not t]
    toxic = [r.expected_grade for r, q, t in held if q and t]
    assert np.mean(good) > np.mean(toxic) + 0.3
    assert all(0 <= r.p_tail <= 1 and 0 <= r.expected_grade <= 2 for r, _, _ in held)


def test_scores_equal_a_plain_loop(spark):
    docs, labels, _ = corpus(spark, 60)
    model = oq.train(docs, labels)
    from playmetrics.llm.wordstream import mix, shape_hashes, slices
    import pyarrow as pa

    def cell(h):
        return int(h) >> (64 - model.bits)

    rows = {r.doc_id: r.score for r in oq.score(docs, model).collect()}
    for r in docs.collect():
        tokens = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        total, last = 0.0, None
        for token in tokens:
            _, one = next(slices(pa.array([token])))
            total += model.weights[cell(one.hashes[0])]
            total += model.weights[cell(mix(shape_hashes(one) + np.uint64(1))[0])]
            total += model.weights[0] * (token.lower() == last)
            last = token.lower()
        assert abs(rows[r.doc_id] - (total / len(tokens) - model.centre)) < 1e-9


def test_thresholds_stay_ordered_and_unused_grades_do_no_harm():
    rows = [oq.Rated(g, np.array([g]), np.array([1.0])) for g in (0, 0, 3, 3, 3)]
    model = oq.fit(rows, 5, 4)
    assert (np.diff(model.thresholds) > 0).all()
    f = model.weights[[0, 3]] - model.centre
    tails = model.tails(f)
    assert tails[0, 0] < 0.5 < tails[1, 2] and (np.diff(tails, axis=1) <= 0).all()


def test_odd_rows_and_missing_labels(spark):
    docs = odd_documents(spark)
    none = spark.createDataFrame([], LABELS)
    out = oq.drop_low_quality(docs, none)
    assert out.columns == docs.columns and out.count() == docs.count()
    odd_labels = spark.createDataFrame([(None, 1, 1), (4, None, None), (5, 0, 1), (99, 0, 0),
                                        (6, 1, 0)], LABELS)
    assert oq.grade(docs, odd_labels).count() == docs.count()
    assert oq.grade(spark.createDataFrame([], DOC_SCHEMA), odd_labels).count() == 0
