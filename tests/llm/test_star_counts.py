"""Components and further pivots: right classes in few jobs."""

import random

from helpers import documents

from playmetrics.llm import components as C
from playmetrics.llm import odd_sketch as O
from playmetrics.llm.components import _unfinished, components


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def _plain(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for pair in pairs for x in pair}


def test_components_of_chains_rings_and_stars(spark):
    rng = random.Random(4)
    pairs = ([(i, i + 1) for i in range(0, 40)] + [(100 + i, 100 + (i + 1) % 7) for i in range(7)]
             + [(200, 201 + i) for i in range(9)] + [(300, 300), (301, 302), (302, 301)]
             + [(rng.randrange(400, 440), rng.randrange(400, 440)) for _ in range(30)])
    found = {r["id"]: r["component"] for r in components(_edges(spark, pairs)).collect()}
    want = _plain([p for p in pairs if p[0] != p[1]])
    assert found == want


def test_unfinished_is_one_job(spark):
    group = "unfinished-jobs"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert not _unfinished(_edges(spark, [(5, 1), (6, 1), (9, 2)]))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # the grouped count and its sum, nothing else
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 3
    assert _unfinished(_edges(spark, [(5, 1), (6, 5)]))
    assert _unfinished(_edges(spark, [(5, 1), (5, 2)]))


def test_all_drawn_pivots_meet_at_once(spark):
    rows = [(b, c, c % 3) for b in range(6) for c in range(b, b + 12)]
    apart = spark.createDataFrame(rows, "bucket long, class_id long, part long")
    once = {tuple(r) for r in O._turns(apart, 1).collect()}
    twice = {tuple(r) for r in O._turns(apart, 2).collect()}
    assert once < twice and len(twice) <= 2 * len(rows)
    assert all(a < b and a % 3 != b % 3 for a, b in twice)
    # every class meets a pivot of another part in each bucket, unless it has all pivots' part
    assert {c for pair in twice for c in pair} == {c for _, c, _ in rows}


def test_a_round_writes_its_edges_twice(spark, monkeypatch):
    rounds, written = [], []
    settled, unfinished = C.settled, C._unfinished
    monkeypatch.setattr(C, "settled", lambda df: written.append(1) or settled(df))
    monkeypatch.setattr(C, "_unfinished", lambda df: rounds.append(1) or unfinished(df))
    pairs = [(i, i + 1) for i in range(30)]
    assert {r["component"] for r in components(_edges(spark, pairs)).collect()} == {0}
    # the edges at first, and both stars of each round; the last look ends them
    assert len(written) == 1 + 2 * (len(rounds) - 1) and len(rounds) > 2


def test_drawn_pivots_meet_with_the_leader(spark, monkeypatch):
    """Copies of an absent text grow together in one turn, not in one for each kind of pivot."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(160)]
    texts = []
    for _ in range(300):
        own = list(words)
        for _ in range(rng.choice((1, 3, 5))):
            own[rng.randrange(160)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    calls = []
    real = O._apart_still
    monkeypatch.setattr(O, "_apart_still", lambda *a: calls.append(1) or real(*a))
    rows = O.near_duplicates(documents(spark, texts)).collect()
    assert len(rows) == 300 and len(calls) == 1
