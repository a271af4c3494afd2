"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum with map-side combine and one join; the edges
are checkpointed after every round, so lineage stays short and a lost executor
costs one round. The edges only ever live in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.llm.common import settled


def _rows(frame: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(a, b) for each of the named pairs of columns, in one pass over the rows."""
    made = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])
    return frame.select(F.explode(made).alias("p")).select("p.a", "p.b")


def _apart(least: DataFrame) -> DataFrame:
    """Rows by a computed key, so that a join exchanges both sides and Spark can split a
    node that very many edges share; grouped rows would keep their partitions."""
    return least.withColumn("a", F.col("a") + F.lit(0))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _rows(edges, ("a", "b"), ("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    # a row for each edge at most; the small star makes them distinct
    return (both.where("b > a").join(_apart(least), "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return _rows(down.join(_apart(least), "a"), ("a", "m"), ("b", "m")).where("a <> b").distinct()


def _unfinished(edges: DataFrame) -> bool:
    """Whether an edge does not yet point from a leaf straight to its only root.

    One grouped count tells it: a leaf has one edge and is nobody's root.
    """
    ends = F.array(F.struct(F.col("a").alias("id"), F.lit(1).alias("leaf"), F.lit(0).alias("root")),
                   F.struct(F.col("b").alias("id"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
    roles = edges.select(F.explode(ends).alias("end")).select("end.*")
    counted = roles.groupBy("id").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root"))
    return counted.where("leaf + root > 1").agg(F.count(F.lit(1))).first()[0] > 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of an edge (columns a, b); component is its least id."""
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().transform(settled)
    while _unfinished(edges):
        # the small star reads its edges twice
        edges = _small_star(_large_star(edges).transform(settled)).transform(settled)
    leaves = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return leaves.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
                        .distinct())
