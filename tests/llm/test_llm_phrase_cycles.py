"""Phrase counts by dynamic counting against plain counts of every phrase."""

import random
import re
from collections import Counter, defaultdict

from helpers import DOC_SCHEMA, documents, odd_documents

from playmetrics.llm import phrase_cycles as P
from playmetrics.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest, best):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {q[i:i + k] for q, a in candidates.items() for k in range(2, len(q))
                   for i in range(len(q) - k + 1) if a >= f[q[i:i + k]]}
        rows = []
        for p, a in candidates.items():
            if p not in dropped:
                n = totals[lang]
                low = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                l, r = f[p[:low[1]]], f[p[low[1]:]]  # noqa: E741
                rows.append((-low[0], -a, " ".join(p).encode(), l, r, n))
        for rank, (score, a, p, l, r, n) in enumerate(sorted(rows)[:best], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def check(df, least=3, longest=5, best=50, shards=2):
    got = P.collocations(df, least=least, longest=longest, best=best, shards=shards).collect()
    want = plain([(r.lang, r.text) for r in df.select("lang", "text").collect()],
                 least, longest, best)
    assert sorted(map(tuple, got)) == want
    return want


def corpus(spark, seed, n, langs=("en", "de", None)):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "x-1", "é", "É", "state", "map"]
    fixed = ["new york city", "map of the state", "the the the the"]
    rows = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words)
                 for _ in range(rng.randint(0, 25))]
        text = "".join(p + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " "]) for p in parts)
        rows.append((i, text, rng.choice(langs), "s", len(text)))
    return spark.createDataFrame(rows, DOC_SCHEMA)


def test_equals_plain_counts(spark):
    df = corpus(spark, 1, 300).repartition(6)
    want = check(df, shards=P.SHARDS)
    assert any(len(r[2].split()) > 3 for r in want)
    assert len(check(df, least=10, best=5)) == 15


def test_few_shards_and_one_block(spark):
    df = corpus(spark, 2, 120, ("en",)).coalesce(1)
    check(df, shards=1)
    check(df, shards=3, longest=3)


def test_slots_that_phrases_share_cost_no_exactness(spark, monkeypatch):
    monkeypatch.setattr(P, "FEWEST_BITS", 5)
    monkeypatch.setattr(P, "MOST_BITS", 5)
    check(corpus(spark, 3, 150).repartition(5))


def test_lengths_are_interleaved(spark):
    """Longer phrases join while shorter ones are counted: fewer steps than a circle each."""
    texts = ["red green blue black white " * 40] * 64
    path = scratch_path(spark, "phrase-test")
    df = documents(spark, texts).repartition(16).select("lang", "text")
    P.write_words(df, 8, path)
    found, steps = P.frequent(spark, path, 16, 8, 100, 5)
    assert found.count() == 25 and steps < 2 * 8  # level by level it would be 5 * 8
    counts = {(r.k, r.n) for r in found.collect()}
    assert (1, 64 * 40) in counts and (5, 64 * 39) in counts


def test_odd_rows_and_clashing_columns(spark):
    df = odd_documents(spark).selectExpr("*", "1 phrase", "2 words", "3 score")
    check(df, least=1, longest=3, shards=1)
    check(df, least=2)


def test_empty_tables(spark):
    assert P.collocations(spark.createDataFrame([], DOC_SCHEMA)).count() == 0
    assert P.collocations(documents(spark, ["", None, " . "])).count() == 0
    assert P.collocations(documents(spark, ["a b"])).count() == 0


def test_words_that_no_block_spelled_are_asked_for_again(spark, monkeypatch):
    monkeypatch.setattr(P, "NAMED", 1 << 62)
    assert check(corpus(spark, 4, 150).repartition(3))


def test_blocks_take_few_bytes_a_word(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(3000)}" for _ in range(4000)) for _ in range(40)]
    path = scratch_path(spark, "phrase-test")
    P.write_words(documents(spark, texts).coalesce(1).select("lang", "text"), 2, path)
    blocks = spark.read.schema(P.WRITTEN).parquet(path)
    size = blocks.selectExpr("sum(length(kinds) + length(words))").first()[0]
    assert size <= 3 * 40 * 4000


def test_a_step_leaves_the_counts_so_far_where_they_are(spark):
    """Only what is added is exchanged; the sum is that of both."""
    path = scratch_path(spark, "phrase-test")
    state = spark.range(3000).selectExpr("id phrase", "cast(9 as int) mark", "id % 7 n")
    state.write.bucketBy(4, "phrase").option("path", path).saveAsTable("phrase_test")
    try:
        added = spark.range(2000, 5000).selectExpr("id phrase", "cast(9 as int) mark", "1 n")
        added = added.groupBy("phrase").agg(P.F.max("mark").alias("mark"), P.F.sum("n").alias("n"))
        total = P._sum_of(spark.table("phrase_test"), added)
        plan = total._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        got = {r.phrase: (r.mark, r.n) for r in total.collect()}
        assert got == {i: (9, (i % 7 if i < 3000 else 0) + (i >= 2000)) for i in range(5000)}
    finally:
        P._drop(spark, "phrase_test", path)
