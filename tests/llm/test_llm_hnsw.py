import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmetrics.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, rank int"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, 0, 7) for i, v in enumerate(vectors)], SCHEMA)


def exact(vectors, query, top):
    rows = []
    for i, v in enumerate(vectors):
        if i != query and v is not None and len(v) == len(vectors[query]):
            d = np.asarray(v, np.float32).astype(float) - np.asarray(vectors[query], np.float32)
            rows.append((math.sqrt((d * d).sum()), i))
    return sorted(rows)[:top]


def test_recall_scores_and_shards(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 3
    vectors = [(centres[rng.integers(30)] + rng.normal(size=16)).astype(np.float32).tolist()
               for _ in range(3000)]
    for i in range(0, 900, 3):  # many copies of one vector
        vectors[i] = vectors[0]
    df = frame(spark, vectors)
    rows = hnsw.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=700).collect()
    hits = total = 0
    for q in range(0, 3000, 100):
        got = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        want = exact(vectors, q, 10)
        assert [g[0] for g in got] == list(range(1, 11))
        assert [(g[2], g[1]) for g in got] == sorted((g[2], g[1]) for g in got)
        by_id = dict((i, d) for d, i in exact(vectors, q, 3000))
        assert all(abs(by_id[i] - d) < 1e-9 for _, i, d in got)
        hits += len({g[1] for g in got} & {i for _, i in want})
        total += 10
        if q == 0:  # its copies, smallest identifiers first
            assert [g[1] for g in got] == [3 * k for k in range(1, 11)]
    assert hits / total >= 0.9


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 2.0], None, [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 2.5],
               [1.0, 2.0, 3.0], [], [4.0, 4.0]]
    df = frame(spark, vectors).union(frame(spark, [vectors[0]])).union(
        spark.createDataFrame([(None, [1.0, 2.0], 0, 1)], SCHEMA))
    rows = hnsw.nearest(df, df).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in rows} == {
        (0, 1, 6), (0, 2, 9), (6, 1, 0), (6, 2, 9), (9, 1, 6), (9, 2, 0)}


def test_empty_table(spark):
    df = frame(spark, [])
    assert hnsw.nearest(df, df).count() == 0


def test_a_rebuilt_graph_is_the_same():
    points = np.random.default_rng(1).normal(size=(500, 8))
    a, b = hnsw.Graph(points, 3), hnsw.Graph(points, 3)
    assert all((x == y).all() for x, y in zip(a.links, b.links, strict=True))
    again = hnsw.Graph.of(**a.flat())
    assert (again.search(points[:20], 20) == a.search(points[:20], 20)).all()


def test_doubles_keep_their_precision_and_range(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0 + 1e-12, 0.0]), (2, [1.0 + 3e-12, 0.0]), (3, [1e150, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in hnsw.nearest(df, df).collect()}
    assert got[0, 1][0] == 1 and abs(got[0, 1][1] - 1e-12) < 1e-15
    assert got[0, 2][0] == 2 and got[0, 3] == (3, 1e150)


def test_shards_are_searched_side_by_side(spark):
    vectors = np.random.default_rng(5).normal(size=(4000, 8)).astype(np.float32).tolist()
    df = frame(spark, vectors)
    index = hnsw.build(df, 11, shard_rows=512)
    met = hnsw.meetings(index, df.where("vec_id % 2 = 0"))
    rows = met.select("shard", "block", F.spark_partition_id().alias("task")).collect()
    shards, blocks = {r.shard for r in rows}, {r.block for r in rows}
    assert len(shards) == 8 and len(blocks) == 2 and len(rows) == 16
    assert len({r.task for r in rows}) >= 4
    for shard in shards:  # a graph is in one place, for all blocks
        assert len({r.task for r in rows if r.shard == shard}) == 1
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(dim") == 3  # blocks made, blocks sent, graphs


def test_several_blocks_and_columns_of_the_same_names(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 16)
    vectors = np.random.default_rng(6).normal(size=(300, 6)).astype(np.float32).tolist()
    df = frame(spark, vectors)
    for name in ("query_id", "vector", "dim", "shard", "block", "id", "score"):
        df = df.withColumn(name, F.lit("clash"))
    rows = hnsw.nearest(df, df, shard_rows=64).collect()
    hits = sum(r.vec_id in {i for _, i in exact(vectors, r.query_id, 10)} for r in rows)
    assert len(rows) == 3000 and hits >= 2950


@pytest.mark.parametrize("shard_rows", [hnsw.SHARD_ROWS, 200])
def test_recall_on_the_given_table(spark, shard_rows):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = hnsw.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=shard_rows).collect()
    every = [(r.vec_id, np.array(r.embedding, float)) for r in df.collect()
             if r.embedding is not None and None not in r.embedding
             and np.isfinite(r.embedding).all() and any(r.embedding)]
    hits = total = 0
    for q, v in every:
        if q % 100 == 0:
            want = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in every
                          if i != q and len(w) == len(v))[:10]
            got = sorted((r.rank, r.score) for r in rows if r.query_id == q)
            # by distance, since ties may be more than ten
            hits += sum(g[1] <= want[-1][0] + 1e-9 for g in got)
            total += len(want)
    assert total and hits / total >= 0.9
