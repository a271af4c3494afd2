"""Exact deduplication by content sort (native: DataFrame functions only).

Normalised texts are range-partitioned by sampled splitters (Spark's range
partitioner on the text's first characters and its hash), sorted by full text
within each partition by Spark's external sort so that equal texts become
neighbours, and each run of equal neighbours keeps one row. The comparison is
of full texts, never of a hash alone.

Skew: a text that a sample finds in more than ``1 / hot_share`` of the rows is
dealt out by (text, salt), so its run is spread over several partitions. Each
salted run is reduced to its head, and the at most ``2 * hot_share`` heads are
merged by full text. A hot text the sample misses is still exact; it only
stays in one run, which Spark's window spills to disk.

Edge cases: null text equals the empty text. A null identifier sorts below all
others. Rows that repeat an identifier and a text count as copies, and exactly
one row of each group is kept. An empty table gives an empty result. Columns
of the input other than the two named ones are not read, so their names cannot
clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from playmetrics.llm.common import ascii_lower, prepare, settled, shuffle_partitions, unused_name

HOT_SHARE = 1000
HOT_SAMPLE_ROWS = 200_000
LEAD_CHARS = 48


def hot_texts(docs: DataFrame, text: str, hot_share: int, sample_rows: int) -> dict[int, int]:
    """Hash of each hot normalised text -> number of salts; fewer than ``hot_share`` entries.

    Only decides how rows are dealt out, never which rows are equal.
    """
    total = docs.count()
    if not total:
        return {}
    sample = docs if total <= sample_rows else docs.sample(sample_rows / total, seed=17)
    counts = (sample.groupBy(F.xxhash64(ascii_lower(F.col(text))).alias("h"))
              .agg(F.count(F.lit(1)).alias("n")))
    seen = min(total, sample_rows)
    rows = counts.where(F.col("n") * hot_share > seen).collect()  # fewer than hot_share
    return {r.h: -(-r.n * hot_share // seen) for r in rows}


def _dealt(docs: DataFrame, id_col: str, text_col: str, hot: dict[int, int]
           ) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` range-partitioned so that equal texts of one salt meet, and the added columns' names.

    The normalised text is computed behind the exchange, so a text travels once.
    """
    spark = docs.sparkSession
    name = {k: unused_name(docs, f"{k}_of_text") for k in ("lead", "hash", "salts", "salt", "norm")}
    norm = ascii_lower(F.col(text_col))
    if hot:
        pairs = F.create_map(*[F.lit(x) for kv in hot.items() for x in kv])
        salts = F.coalesce(F.element_at(pairs, F.xxhash64(norm)), F.lit(1))
    else:
        salts = F.lit(1)
    # the identifier decides the salt, so rows that repeat one stay together
    salt = F.expr(f"cast(pmod(xxhash64(`{id_col}`), `{name['salts']}`) as int)")
    dealt = (docs.withColumns({name["lead"]: F.left(norm, F.lit(LEAD_CHARS)),
                               name["hash"]: F.xxhash64(norm), name["salts"]: salts.cast("int")})
             .withColumn(name["salt"], salt)
             .repartitionByRange(shuffle_partitions(spark), name["lead"], name["hash"],
                                 name["salt"])
             .withColumn(name["norm"], norm))
    return dealt, name


def _run(name: dict[str, str], id_col: str, keep: str) -> WindowSpec:
    # lead and hash follow from the text, so they may stand before it in the sort; they keep
    # the splitters that Spark samples and sends to the driver short
    order = F.desc_nulls_last(id_col) if keep == "largest" else F.asc_nulls_last(id_col)
    return Window.partitionBy(name["lead"], name["hash"], name["norm"], name["salt"]).orderBy(order)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", hot_share: int = HOT_SHARE,
                sample_rows: int = HOT_SAMPLE_ROWS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hot = hot_texts(docs, "text", hot_share, sample_rows)
    dealt, name = _dealt(docs, "id", "text", hot)
    run = _run(name, "id", keep)
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    salted, norm = F.col(name["salts"]) > 1, F.col(name["norm"])
    runs = (dealt.withColumns({"rank": F.row_number().over(run),
                               "run_keep": F.first("id").over(whole),
                               "run_size": F.count(F.lit(1)).over(whole)})
            .select("id", salted.alias("salted"), "rank", "run_keep", "run_size",
                    F.sha2(norm, 256).alias("text_sha256"),
                    F.when(salted & (F.col("rank") == 1), norm).alias("head"))
            .transform(settled))
    best = F.max if keep == "largest" else F.min
    heads = (runs.where(F.col("head").isNotNull()).groupBy("head")
             .agg(best("run_keep").alias("all_keep"), F.sum("run_size").alias("all_size"),
                  F.first("text_sha256").alias("text_sha256"))
             .drop("head"))
    joined = runs.drop("head").join(F.broadcast(heads), "text_sha256", "left")  # <= hot_share rows
    keep_id = F.when(F.col("salted"), F.col("all_keep")).otherwise(F.col("run_keep"))
    size = F.when(F.col("salted"), F.col("all_size")).otherwise(F.col("run_size"))
    return joined.select(F.col("id").alias(id_col), keep_id.alias("keep_id"),
                         size.alias("group_size"),
                         ((F.col("rank") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
                         "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", hot_share: int = HOT_SHARE,
                sample_rows: int = HOT_SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`mark_copies` would keep, with all their columns.

    Rows travel once. The best identifier of each hot text is found beforehand,
    by an aggregation that every task reduces to one row per hot text.
    """
    prepare(docs.sparkSession)
    hot = hot_texts(docs, text_col, hot_share, sample_rows)
    dealt, name = _dealt(docs, id_col, text_col, hot)
    rank = unused_name(docs, "rank_of_text")
    heads = dealt.withColumn(rank, F.row_number().over(_run(name, id_col, keep))).where(
        F.col(rank) == 1)
    if hot:
        norm = ascii_lower(F.col(text_col))
        best_id, best_sha = unused_name(docs, "best_id"), unused_name(docs, "best_sha")
        best = (docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
                .where(F.xxhash64("norm").isin(list(hot))).groupBy("norm")
                .agg((F.max if keep == "largest" else F.min)("id").alias(best_id))
                .select(best_id, F.sha2("norm", 256).alias(best_sha)))  # <= hot_share rows
        heads = heads.join(F.broadcast(best), (F.col(name["salts"]) > 1) & (
            F.sha2(F.col(name["norm"]), 256) == F.col(best_sha)), "left").where(
            (F.col(name["salts"]) == 1) | F.col(id_col).eqNullSafe(F.col(best_id)))
    return heads.select(docs.columns)
