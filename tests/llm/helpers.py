"""Rows every operator must survive."""

from pyspark.sql import SparkSession

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts, first_id=1, **extra):
    rows = [(first_id + i, t, "en", "src%d" % (i % 3), len(t) if t else 0)
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def odd_documents(spark: SparkSession):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    long_text = "a long text with many words " * 4000
    rows = [
        (1, None, None, None, None, 1, "x"), (2, "", "en", "s", 0, 1, "x"),
        (3, " \t\n ", "en", "s", 4, 1, None), (4, "one", "en", "s", 3, 2, "y"),
        (5, "ONE", "en", None, 3, 2, "y"), (5, "ONE", "en", None, 3, 2, "y"),
        (6, long_text, "en", "s", len(long_text), 3, "z"),
        (7, long_text, None, "s", len(long_text), 3, "z"),
        (None, "one", "en", "s", 3, 4, "w"), (8, "Ärger ÄRGER \u0000 ▁", "de", "s", 14, 5, "v"),
    ]
    schema = DOC_SCHEMA + ", keep_id long, `select` string"
    return spark.createDataFrame(rows, schema)
