"""Differences of two versions of a table, found from digests before any row is compared.

A digest does not depend on the order of rows. There is one for each partition and
bucket of keys; they are written once beside a version. Two versions are first
compared by these small tables. Only partitions with a difference are read, and of
those only the rows of differing buckets meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmetrics.functions.params import JSON_KEY_OPTIONS

BUCKETS = 256


def _hashes(rows: DataFrame, columns: list[str], seed: int = 0) -> list[Column]:
    """A 64-bit hash per column in which NULL differs from every value; nested values as JSON."""
    out = []
    for c in columns:
        nested = isinstance(rows.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType))
        value = F.to_json(c, JSON_KEY_OPTIONS) if nested else F.col(c)
        out.append(F.xxhash64(F.lit(seed), value, F.col(c).isNull()))
    return out


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def digests(rows: DataFrame, partition: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """(partition, bucket, num_rows, total, parity): equal where both versions hold the same rows.

    ``total`` adds one hash of every row and ``parity`` xors another, so neither order
    nor pairs of equal rows hide a difference. All combines before the shuffle.
    """
    columns = sorted(c for c in rows.columns if c != partition)
    one, two = (F.xxhash64(*_hashes(rows, columns, seed)) for seed in (0, 1))
    return rows.select(partition, _bucket(key, buckets), one.alias("_one"), two.alias("_two")).groupBy(
        partition, "bucket").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.sum(F.col("_one").cast("decimal(20,0)")).alias("total"), F.bit_xor("_two").alias("parity"))


def differing(a_digests: DataFrame, b_digests: DataFrame) -> DataFrame:
    """Distinct (partition, bucket) whose digests are not in both versions alike."""
    lone = a_digests.unionByName(b_digests).groupBy(*a_digests.columns).agg(
        F.count(F.lit(1)).alias("versions")).where("versions = 1")
    return lone.select(a_digests.columns[0], "bucket").distinct()


def changed_keys(a: DataFrame, b: DataFrame, apart: DataFrame, key: str,
                 buckets: int = BUCKETS) -> DataFrame:
    """(partition, key, removed, added, changed_columns) of the keys whose rows differ.

    A key with one differing row on each side is changed, and its columns are named; else
    its rows are counted as removed and added. Repeated rows count as often as they
    occur. The partitions named by ``apart`` reach both scans as a filter: the list has
    one value per differing partition, never a row of the table.
    """
    partition = apart.columns[0]
    columns = sorted(c for c in a.columns if c not in (partition, key))
    values = [r[0] for r in apart.select(partition).distinct().collect()]
    wanted = F.col(partition).isin([v for v in values if v is not None])
    if None in values:
        wanted = wanted | F.col(partition).isNull()

    def side(rows: DataFrame, sign: int) -> DataFrame:
        return rows.where(wanted).select(
            partition, key, _bucket(key, buckets), F.array(*_hashes(rows, columns)).alias("hashes"),
            F.lit(sign).cast("long").alias("sign"))

    both = side(a, 1).unionByName(side(b, -1))
    marks = apart.select(F.col(partition).alias("_p"), F.col("bucket").alias("_b"))
    near = both.join(marks, F.col(partition).eqNullSafe(F.col("_p"))
                     & (F.col("bucket") == F.col("_b")), "left_semi")
    # rows that both versions hold cancel out, most of them before the shuffle
    left = near.groupBy(partition, key, "hashes").agg(F.sum("sign").alias("n")).where("n <> 0")
    gone, come = F.col("n") > 0, F.col("n") < 0
    zero = F.lit(0).cast("long")
    keys = left.groupBy(partition, key).agg(
        F.coalesce(F.sum(F.when(gone, F.col("n"))), zero).alias("removed"),
        F.coalesce(F.sum(F.when(come, -F.col("n"))), zero).alias("added"),
        F.max(F.when(gone, F.col("hashes"))).alias("_a"),
        F.max(F.when(come, F.col("hashes"))).alias("_b"))
    names = F.array(*[F.when(F.col("_a")[i] != F.col("_b")[i], F.lit(c))
                      for i, c in enumerate(columns)]) if columns else F.array()
    alike = (F.col("removed") == 1) & (F.col("added") == 1)
    return keys.select(partition, key, "removed", "added",
                       F.when(alike, F.array_compact(names.cast("array<string>"))).alias("changed_columns"))


def diff_report(a: DataFrame, b: DataFrame, a_digests: DataFrame, b_digests: DataFrame, key: str,
                buckets: int = BUCKETS) -> DataFrame:
    """(partition, change, column_name, num_rows): rows removed, added and changed, and for
    changed ones each column's share of them. Partitions without a difference have no row."""
    if set(a.columns) != set(b.columns):
        raise ValueError(f"the versions differ in columns: {sorted(set(a.columns) ^ set(b.columns))}")
    apart = differing(a_digests, b_digests)
    partition = apart.columns[0]
    keys = changed_keys(a, b, apart, key, buckets)
    null, one = F.lit(None).cast("string"), F.lit(1).cast("long")

    def entry(change: str, column: Column, n: Column) -> Column:
        return F.struct(F.lit(change).alias("change"), column.alias("column_name"), n.alias("n"))

    changed = F.concat(F.array(entry("changed", null, one)),
                       F.transform("changed_columns", lambda c: entry("changed", c, one)))
    moved = F.array(entry("removed", null, F.col("removed")), entry("added", null, F.col("added")))
    entries = F.when(F.col("changed_columns").isNotNull(), changed).otherwise(moved)
    return (keys.select(partition, F.explode(entries).alias("e")).select(partition, "e.*")
            .groupBy(partition, "change", "column_name").agg(F.sum("n").alias("num_rows"))
            .where("num_rows > 0"))
