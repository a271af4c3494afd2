"""Token counts against the library's count of every whole text."""

import random

from helpers import DOC_SCHEMA, documents, odd_documents

from playmetrics.llm import resync_counts as R
from playmetrics.llm.common import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def whole(text):
    return len(R._tokenizer(PATH).encode(text or "", add_special_tokens=False))


def check(df, **options):
    rows = df.select("doc_id", "text").collect()
    got = R.token_counts(df, PATH, **options).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = [(r.doc_id, len((r.text or "").encode()), whole(r.text),
             whole(r.text) > options.get("limit", R.LIMIT)) for r in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def mixed_texts(seed, count, size):
    rng = random.Random(seed)
    parts = ["the", " cat", "  ", "\n\n", "'ll", "'", "ré", " don't", "<|endoftext|>", "<|endo",
             "text|>", " 123", "4567", "!!!", " …", "日本語", "🙂", " ", "　 x", "\t", " ",
             "a" * 40, " " * 30, " ", "é", " É", "\x1f", "x<|endoftext|>y"]
    return ["".join(rng.choice(parts) for _ in range(size)) for _ in range(count)]


def test_chunks_are_spliced_to_the_whole_count(spark):
    texts = mixed_texts(3, 40, 150) + ["word " * 500, "a" * 3000, " " * 2000, "ab'll " * 300]
    check(documents(spark, texts), chunk=128, margin=4, huge=100, limit=50)


def test_production_sizes(spark):
    texts = [" ".join(mixed_texts(7, 200, 60)), "x" * 70_000, "tale of " * 20_000, "short"]
    check(documents(spark, texts))


def test_texts_counted_in_place(spark):
    check(documents(spark, mixed_texts(11, 60, 80) + [None, "", " ", "  a", "a ", "é é"]))


def test_margins_widen_until_boundaries_meet(spark):
    """A run of letters longer than the overlap has no boundary; its cuts go at last."""
    text = "plain words before " * 20 + "q" * 900 + " plain words after" * 20
    df = documents(spark, [text, text, "b" * 2000])
    check(df, chunk=128, margin=4, huge=100)
    large = df.selectExpr("doc_id id", "text").withColumn("key", R.F.sha2("text", 256))
    assert R._huge_counts(large, PATH, 128, 4).count() == 2  # once for equal texts


def test_odd_rows_and_empty_table(spark):
    check(odd_documents(spark))
    check(odd_documents(spark), chunk=64, margin=4, huge=10)
    check(spark.createDataFrame([], DOC_SCHEMA))


def test_copies_of_a_huge_text_and_clashing_columns(spark):
    texts = ["same long text here " * 100] * 30 + ["other text " * 90]
    df = documents(spark, texts).selectExpr("*", "1 id", "2 key", "3 n_tokens", "4 layout")
    check(df, chunk=256, margin=16, huge=500)
