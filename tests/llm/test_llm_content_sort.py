import hashlib
from collections import defaultdict

import pytest
from helpers import documents, odd_documents

from playmetrics.llm import content_sort

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, keep=max):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(LOWER)].append(-1 if doc is None else doc)
    return sorted((doc, keep(ids), len(ids), hashlib.sha256(norm.encode()).hexdigest())
                  for norm, ids in groups.items() for doc in ids), len(groups)


@pytest.mark.parametrize("hot_share", [2, 4, 1000])
def test_marks_equal_brute_force_with_and_without_salts(spark, hot_share):
    docs = odd_documents(spark).union(
        documents(spark, ["Hot Text"] * 40 + ["hot text"] * 25 + ["Straße"] * 30, 100)
        .selectExpr("*", "1L", "'q'"))
    rows = content_sort.mark_copies(docs, hot_share=hot_share).collect()
    expected, groups = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id,
                  r.group_size, r.text_sha256) for r in rows)
    assert got == expected
    assert sum(r.kept for r in rows) == groups
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_smallest_identifier_and_non_ascii_case(spark):
    docs = documents(spark, ["Ä", "ä", "AB", "ab"])
    rows = {r.doc_id: r for r in content_sort.mark_copies(docs, keep="smallest").collect()}
    assert rows[1].group_size == 1 and rows[2].group_size == 1
    assert rows[3].kept and not rows[4].kept and rows[4].keep_id == 3


def test_drop_copies_keeps_columns_and_one_row_each(spark):
    docs = odd_documents(spark)
    out = content_sort.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == [2, 3, 5, 7, 8]


def test_empty_table(spark):
    assert content_sort.mark_copies(documents(spark, [])).count() == 0


@pytest.mark.parametrize("hot_share", [2, 5, 1000])
def test_dropping_agrees_with_marking_on_hot_texts(spark, hot_share):
    docs = documents(spark, ["Hot Text"] * 60 + ["hot text"] * 25 + ["other"] * 9 + ["x", "y"], 100)
    for keep in ("largest", "smallest"):
        marks = content_sort.mark_copies(docs, keep=keep, hot_share=hot_share).where("kept")
        out = content_sort.drop_copies(docs, keep=keep, hot_share=hot_share)
        assert sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in marks.collect())
        assert out.count() == 4
