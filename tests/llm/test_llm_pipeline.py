import random
from collections import Counter

import corpus_pipeline
import pytest
from helpers import DOC_SCHEMA, odd_documents
from test_llm_content_sort import LOWER
from test_llm_odd_sketch import brute as near_components
from test_llm_odd_sketch import mutated
from test_llm_packing import brute_pieces, check_sequences
from test_llm_weak_pii import plain

from playmetrics.llm import weak_pii

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture()
def sf_dir(spark, tmp_path):
    rng = random.Random(9)
    rows, labels = [], []

    def add(text, quality, labelled=True):
        rows.append((len(rows) + 1, text, "en", f"s{len(rows) % 4}", len(text)))
        if labelled:
            labels.append((len(rows), quality, 0))

    words = ["w%s" % c for c in "abcdefghijklmnopqrstuvwxyz"]
    texts = []
    for _ in range(60):
        body = [rng.choice(words) + rng.choice(words) for _ in range(rng.randrange(30, 120))]
        if rng.random() < 0.3:
            body[3] = "mail u%d@site.example.com" % rng.randrange(99)
            body[9] = "+1 (456) 555-2186"
        texts.append(" ".join(body))
    for text in texts:
        add(text, 1)
    for k in range(40):  # junk
        add(" ".join("%s!!" % rng.choice(words).upper() for _ in range(40)), 0, k % 3 > 0)
    for text in texts[:20]:  # exact copies up to case, and near copies
        add(text.upper() if rng.random() < 0.2 else text, 1, False)
        add(mutated(rng, text.split(" "), 1), 1, False)
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{path}/labels.parquet")
    return path, rows


def brute(rows):
    kept = [(d, t) for d, t, *_ in rows if "!!" not in t]
    newest = {}
    for d, t in kept:
        newest[t.translate(LOWER)] = max(d, newest.get(t.translate(LOWER), 0))
    kept = [(d, t) for d, t in kept if newest[t.translate(LOWER)] == d]
    part = near_components(kept)
    kept = [(d, t) for d, t in kept if part[d][1] == d]
    masked = []
    for d, t in kept:
        spans = [weak_pii.Span(k, int(a), int(b)) for k, a, b in
                 (s.split(":") for s in plain(t).split(",") if s)]
        masked.append((d, weak_pii.masked(t, spans)))
    return masked


def test_run_equals_brute_force(spark, sf_dir):
    path, rows = sf_dir
    expected = brute(rows)
    out = corpus_pipeline.run(spark, path).collect()
    assert Counter(tuple(r)[:5] for r in out) == brute_pieces(expected, 4096)
    check_sequences(out, 4096)
    assert len({r.doc_id for r in out}) < 70 < len(rows)


def test_stages_keep_the_columns_and_clean_documents(spark, sf_dir):
    path, rows = sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "personal_data", "packing"]
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), DOC_SCHEMA)
        seen.append(docs.count())
    assert seen[0] == sum("!!" not in t for _, t, *_ in rows)
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    final = {r.doc_id: r.text for r in docs.collect()}
    clean = {d: t for d, t in brute(rows)}
    assert final == clean


def test_stages_survive_odd_rows_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "odd")
    spark.createDataFrame([], LABELS).write.parquet(f"{path}/labels.parquet")
    odd = odd_documents(spark)
    for docs in (odd, odd.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, path)
            rows = out.collect()
            if name != "packing":
                assert out.columns == docs.columns, name
                docs = spark.createDataFrame(rows, odd.schema)
        assert bool(rows) == bool(docs.count())


def test_registered_with_the_other_queries():
    import __spark_entry__ as entry
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in names if k.startswith("op")}
    assert "pipeline" in names and "pipeline" not in entry.oracle_sql()
    assert {"op6_secret_owners", "op7_content_sort"} <= set(entry.oracle_sql())
