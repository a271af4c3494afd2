import random
import re

import numpy as np
import pytest
from helpers import documents, odd_documents

from playmetrics.llm import odd_sketch
from playmetrics.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {d: (len(s), root(d)) for d, s in sets}


def mutated(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = "w%d" % rng.randrange(10**6)
    return " ".join(out)


def corpus(seed=3):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = ["w%d" % rng.randrange(10**6) for _ in range(rng.randrange(40, 160))]
        texts += [" ".join(words)] * rng.randrange(1, 4)
        texts += [mutated(rng, words, rng.randrange(0, 7)) for _ in range(9)]
        chain = list(words)  # neighbours are alike, the ends are not
        for _ in range(8):
            at = rng.randrange(len(chain))
            chain[at] = "c%d" % rng.randrange(10**6)
            texts.append(" ".join(chain).upper())
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [3, 4])
def test_components_equal_brute_force(spark, seed):
    docs = documents(spark, corpus(seed))
    expected = brute([(r.doc_id, r.text) for r in docs.collect()])
    rows = odd_sketch.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_copies_whose_original_is_absent_are_still_met(spark):
    # every text differs from the next in one place: only the second pass can join them all
    rng = random.Random(8)
    words = ["w%d" % i for i in range(60)]
    texts = [mutated(rng, words, 1) for _ in range(60)]
    docs = documents(spark, texts)
    rows = odd_sketch.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(
        list(enumerate(texts, 1)))


def test_odd_rows(spark):
    rows = odd_sketch.near_duplicates(odd_documents(spark)).collect()
    by = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert len(rows) == 10
    assert by[(1, 0)] == 1 and by[(2, 0)] == 2 and by[(3, 0)] == 3
    assert by[(4, 1)] == 4 and by[(5, 1)] == 4 and by[(None, 1)] is None
    assert by[(7, 6)] == 6 and by[(8, 1)] == 8
    out = odd_sketch.drop_near_duplicates(odd_documents(spark))
    assert out.columns == odd_documents(spark).columns
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in out.collect()) == [
        -1, 1, 2, 3, 4, 6, 8]


def test_empty_table(spark):
    assert odd_sketch.near_duplicates(documents(spark, [])).count() == 0


def test_sketch_test_keeps_true_links():
    rng = np.random.default_rng(1)
    most = odd_sketch.most_ones(128, 512, 0.75)
    seen = []
    for _ in range(400):
        a = rng.integers(0, 2**63, (1, 128)).astype(np.uint64)
        b = np.where(rng.random((1, 128)) < 0.75, a, rng.integers(0, 2**63, (1, 128)).astype(np.uint64))
        x = odd_sketch.odd_sketches(a, 512) ^ odd_sketch.odd_sketches(b, 512)
        seen.append(int(np.bitwise_count(x).sum()))
    assert max(seen) < most and abs(np.mean(seen) - 56.6) < 3
    far = odd_sketch.odd_sketches(rng.integers(0, 2**63, (200, 128)).astype(np.uint64), 512)
    assert np.bitwise_count(far[1:] ^ far[:-1]).sum(axis=1).min() > most


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 7)],
                                  "a long, b long")
    rows = {r.id: r.component for r in components(edges).collect()}
    assert rows == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_set_parities_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size, change in ((40, 5), (150, 40), (3000, 900)):
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        b = a.copy()
        b[:change] = rng.integers(0, 2**63, change).astype(np.uint64)
        x, y = odd_sketch.set_parities(np.concatenate([a, b]), np.array([0, size]))
        assert int(np.bitwise_count(x ^ y).sum()) <= 2 * change


def test_large_group_of_half_alike_texts_leaves_few_pairs(spark):
    rng = random.Random(6)
    words = ["w%d" % i for i in range(150)]
    texts = [" ".join(words)] * 5 + [mutated(rng, words, rng.choice((2, 3, 6, 9)))
                                     for _ in range(150)]
    docs = documents(spark, texts)
    rows = odd_sketch.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(
        list(enumerate(texts, 1)))


@pytest.mark.parametrize("similarity", [(75, 100), (3, 5)])
def test_prefix_join_finds_every_alike_pair_of_different_parts(spark, similarity):
    rng = random.Random(9)
    part, whole = similarity
    sets, base = {}, [rng.sample(range(4000), rng.randint(1, 90)) for _ in range(40)]
    for i in range(260):
        kept = [x for x in base[i % 40] if rng.random() > rng.choice((0, 0.05, 0.15, 0.3))]
        sets[i] = sorted(set(kept + rng.sample(range(4000, 9000), rng.randint(0, 12))))
    parts = {i: rng.choice((i, i, 1000 + i % 7)) for i in sets}
    rows = spark.createDataFrame([(i, parts[i], v) for i, v in sets.items() if v],
                                 "class_id long, part long, shingles array<long>")
    got = odd_sketch.prefix_pairs(odd_sketch.prefix_rows(rows, similarity), similarity).collect()
    wanted = {(a, b) for a in sets for b in sets if a < b and parts[a] != parts[b]
              and len({*sets[a], *sets[b]}) and whole * len({*sets[a]} & {*sets[b]})
              >= part * len({*sets[a], *sets[b]})}
    found = {tuple(r) for r in got}
    assert len(found) == len(got) and wanted <= found
    assert all(parts[a] != parts[b] for a, b in found)


def test_many_texts_that_share_a_passage_make_few_pairs(spark, monkeypatch):
    """3,000 texts, each its own class, share 160 words and differ in 50; no two but the
    planted ones are alike, and what is compared does not grow with their square."""
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(160))
    own = [[f"o{rng.randrange(10**9)}" for _ in range(50)] for _ in range(3000)]
    texts = [passage + " " + " ".join(x) for x in own]
    planted = {}
    for i in range(0, 300, 10):  # two changed words of the own half
        words = list(own[i])
        words[7], words[40] = "changed", f"c{i}"
        planted[len(texts) + 1] = i + 1
        texts.append(passage + " " + " ".join(words))
    pairs = []
    real = odd_sketch._close

    def counted(*args):
        out = real(*args)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(odd_sketch, "_close", counted)
    rows = odd_sketch.near_duplicates(documents(spark, texts).repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in rows} == {
        i: planted.get(i, i) for i in range(1, len(texts) + 1)}
    assert sum(pairs) <= len(texts)


def test_a_group_without_its_original_makes_few_pairs(spark, monkeypatch):
    """Copies of an absent text, half the pairs of which are alike: pivots connect them, and
    what is left for the prefix join does not grow with their square."""
    rng = random.Random(12)
    words = ["w%d" % i for i in range(160)]
    texts = [mutated(rng, words, rng.choice((1, 2))) for _ in range(500)]
    texts += [mutated(rng, words, 7) for _ in range(200)]
    pairs = []
    real = odd_sketch.prefix_pairs

    def counted(*args):
        out = real(*args)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(odd_sketch, "prefix_pairs", counted)
    rows = odd_sketch.near_duplicates(documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(
        list(enumerate(texts, 1)))
    assert sum(pairs) <= 2 * len(texts)
