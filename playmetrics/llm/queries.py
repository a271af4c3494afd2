"""Registered queries of this subpackage and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playmetrics.llm import (
    content_sort,
    hnsw,
    interpolation,
    odd_sketch,
    ordinal_quality,
    packing,
    phrase_cycles,
    piece_bpe,
    resync_counts,
    secret_owners,
    term_ranking,
    toxicity,
    weak_pii,
)
from playmetrics.llm.common import read, tokenizer_path


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_and_decode(read(spark, sf_dir, "documents"),
                                       tokenizer_path("piece_bpe_32k.model"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return ordinal_quality.grade(docs, read(spark, sf_dir, "labels"))


def op5_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_pii.find(read(spark, sf_dir, "documents"))


def op6_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_owners.scan(read(spark, sf_dir, "documents"))


def op7_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.mark_copies(read(spark, sf_dir, "documents"))


def op8_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.scores(read(spark, sf_dir, "documents"))


def op9_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(read(spark, sf_dir, "documents"))


def op10_bigru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_accumulator_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_ranking.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_dynamic_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_cycles.collocations(read(spark, sf_dir, "documents"))


def op13_resync_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resync_counts.token_counts(read(spark, sf_dir, "documents"),
                                      tokenizer_path("byte_bpe_50k.json"))


OP7_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""


def _secret_sql() -> str:
    """Matches and the pieces between them give positions; ownership is counted per value."""
    kinds = []
    for order, (kind, pattern, group, least) in enumerate(secret_owners.KINDS):
        quoted = pattern.replace("'", "''")
        kinds.append(f"""
  SELECT row, doc_id, owner, {order} AS k, '{kind}' AS kind, i,
         list_sum(list_transform(gaps[:i], lambda g: length(g)))
           + coalesce(list_sum(list_transform(hits[:i - 1], lambda m: length(m))), 0) AS s,
         length(hits[i]) AS size, vals[i] AS v, {least} AS least
  FROM (SELECT row, doc_id, owner, hits, vals, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT row, doc_id, owner, regexp_extract_all(t, '{quoted}', 0) AS hits,
           regexp_extract_all(t, '{quoted}', {group}) AS vals,
           string_split_regex(t, '{quoted}') AS gaps
    FROM d WHERE regexp_matches(t, '{quoted}')))""")
    base = len(secret_owners.BASE)
    counts = ", ".join(f"count(f.k) FILTER (f.k = {i}) AS n_{kind[0]}"
                       for i, kind in enumerate(secret_owners.BASE))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source AS owner, coalesce(text, '') AS t
           FROM documents),
found AS (SELECT *, kind || ':' || s::BIGINT || ':' || (s + size)::BIGINT AS w FROM ({
    " UNION ALL ".join(kinds)}) WHERE length(v) >= least),
own AS (
  SELECT v, count(DISTINCT o) AS owners, count(DISTINCT (o, coalesce(doc_id, -1))) AS repositories
  FROM (SELECT v, doc_id, coalesce(owner, chr(1)) AS o FROM found) GROUP BY v),
told AS (
  SELECT *, owners >= {secret_owners.EXAMPLE_OWNERS}
            OR repositories >= {secret_owners.EXAMPLE_SPREAD} * owners AS example FROM own),
judged AS (
  SELECT f.*, owners, repositories, example, NOT example
           AND len(list_distinct(string_split(v, ''))) >= {secret_owners.VARIED} AS live
  FROM found f JOIN told USING (v)),
f AS (SELECT * FROM judged WHERE k < {base} OR live)
SELECT d.doc_id, {counts},
       sha256(coalesce(string_agg(f.w, ',' ORDER BY f.s, f.k) FILTER (f.k < {base}), '')) AS base_sha256,
       coalesce(string_agg(f.w, ',' ORDER BY f.s, f.k), '') AS spans,
       count(f.k) FILTER (f.live) AS n_live, count(f.k) FILTER (f.example) AS n_example,
       coalesce(max(owners), 0) AS most_owners, coalesce(max(repositories), 0) AS most_repositories
FROM d LEFT JOIN f ON f.row = d.row GROUP BY d.row, d.doc_id
"""


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
      WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3),
                                           lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT l.b, r.other FROM reached r JOIN links l ON l.a = r.doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id,
       doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""

OP11_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
totals AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM docs),
wanted AS (
  SELECT item_id, text, term, count(*) AS times FROM (
    SELECT item_id, text, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
held AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM held, totals GROUP BY term),
scored AS (
  SELECT item_id, text, r, doc_id, sum(times * w * ((1000000000 * tf)
      // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM held JOIN weighed USING (term) JOIN wanted USING (term), totals GROUP BY ALL),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, text
      ORDER BY score DESC, doc_id NULLS LAST, r) AS place
  FROM scored WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 20
"""

OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
           FROM pieces, (SELECT unnest(range(1, 6)) AS k)),
f AS (SELECT lang, ws[i:i + k - 1] AS ph, count(*) AS a FROM starts GROUP BY ALL),
candidates AS (SELECT * FROM f WHERE len(ph) > 1 AND a >= 100),
inner_parts AS (
  SELECT DISTINCT lang, outer_a, ph[i:i + k - 1] AS ph FROM (
    SELECT lang, ph, k, outer_a, unnest(range(1, len(ph) - k + 2)) AS i FROM (
      SELECT lang, ph, a AS outer_a, unnest(range(2, len(ph))) AS k FROM candidates))),
covered AS (SELECT lang, ph, max(outer_a) AS outer_a FROM inner_parts GROUP BY ALL),
alone AS (
  SELECT c.* FROM candidates c LEFT JOIN covered o USING (lang, ph)
  WHERE o.outer_a IS NULL OR 100 * o.outer_a < 100 * c.a),
cuts AS (SELECT *, unnest(range(1, len(ph))) AS k FROM alone),
scores AS (
  SELECT c.lang, c.ph, c.a, k, l.a AS l, r.a AS r, n,
         (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.ph = c.ph[:k]
  JOIN f r ON r.lang = c.lang AND r.ph = c.ph[k + 1:]),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) AS pick FROM scores),
placed AS (
  SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, n, score, row_number() OVER (
      PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank
  FROM low WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM placed WHERE rank <= 2000
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_hnsw": op1_hnsw,
        "op2_piece_bpe": op2_piece_bpe,
        "op3_best_fit_packing": op3_best_fit_packing,
        "op4_ordinal_quality": op4_ordinal_quality,
        "op5_weak_pii": op5_weak_pii,
        "op6_secret_owners": op6_secret_owners,
        "op7_content_sort": op7_content_sort,
        "op8_interpolation": op8_interpolation,
        "op9_odd_sketch": op9_odd_sketch,
        "op10_bigru_toxicity": op10_bigru_toxicity,
        "op11_accumulator_limit": op11_accumulator_limit,
        "op12_dynamic_counting": op12_dynamic_counting,
        "op13_resync_counts": op13_resync_counts,
    }


def llm_oracles() -> dict[str, str]:
    return {"op6_secret_owners": _secret_sql(), "op7_content_sort": OP7_SQL,
            "op9_odd_sketch": OP9_SQL, "op11_accumulator_limit": OP11_SQL,
            "op12_dynamic_counting": OP12_SQL}
