"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard.

Equal vectors are first merged into one point with its smallest identifiers, so
copies neither cut a graph into cliques nor crowd out other neighbours. Points
are dealt to shards by hash. A task builds its shard's graph by inserting the
points in blocks: every block searches the graph so far (all its points at once,
as arrays), keeps diverse neighbours by the usual heuristic, and links both
ways. The graph is stored as flat arrays: per layer, a matrix of neighbour
numbers. A search walks down from the top layer and keeps a beam on the ground
layer. Each shard returns its best points per query, and these are merged with
exact distances in double precision.

Queries travel to the shards: a shard's graph is one row that is shuffled once, and
each block of queries is sent to every shard. Shards are searched side by side, one
block at a time. No shard, block or merge holds more than a bounded number of rows:
a shard about ``shard_rows`` points, a block ``QUERY_BLOCK`` queries.

Edge cases: vectors that are null, zero, or hold a null or non-finite component
take no part. Vectors of different lengths are indexed apart, and a query only
meets its own length. Rows that repeat an identifier and a vector count once; a
query never returns its own identifier. Ties go to the smaller identifier, rows
without an identifier take no part. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playmetrics.llm.common import prepare, settled

NEIGHBOURS = 16  # links per point on upper layers; twice as many on the ground layer
BUILD_BEAM = 64
SEARCH_BEAM = 160
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
INSERT_BLOCK = 256


# ------------------------------------------------------------------ one shard's graph

def _distances(points: np.ndarray, which: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its row of point numbers (-1: infinite)."""
    diff = points[np.maximum(which, 0)] - queries[:, None, :]
    out = np.einsum("qnd,qnd->qn", diff, diff)
    out[which < 0] = np.inf
    return out


def _beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray,
          width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of all queries at once on one layer; entries as (query, n) numbers.

    Returns point numbers and squared distances by distance, -1 and inf where fewer were met.
    """
    n = len(queries)
    row = np.arange(n)
    seen = np.zeros((n, len(points) + 1), dtype=bool)  # the last column takes the -1s
    seen[:, -1] = True
    first = np.full((n, max(width, entry.shape[1])), -1, np.int64)
    first[:, :entry.shape[1]] = entry
    np.put_along_axis(seen, first, True, axis=1)
    found, far = first, _distances(points, first, queries)
    order = np.argsort(far, axis=1)[:, :width]
    found, far = np.take_along_axis(found, order, 1), np.take_along_axis(far, order, 1)
    done = found < 0
    active = row
    while len(active):
        waiting = np.where(done[active], np.inf, far[active])
        best = waiting.argmin(axis=1)
        going = waiting[np.arange(len(active)), best] < np.inf
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        near = links[found[active, best]].astype(np.int64)
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        d = _distances(points, near, queries[active])
        all_found = np.concatenate([found[active], near], axis=1)
        all_far = np.concatenate([far[active], d], axis=1)
        all_done = np.concatenate([done[active], near < 0], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        found[active] = np.take_along_axis(all_found, order, 1)
        far[active] = np.take_along_axis(all_far, order, 1)
        done[active] = np.take_along_axis(all_done, order, 1)
    return found, far


def _diverse(points: np.ndarray, found: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the row than to any kept one.

    Free places go to the nearest of the others, which keeps sparse regions connected.
    """
    n, width = found.shape
    vectors = points[np.maximum(found, 0)]
    square = np.einsum("nwd,nwd->nw", vectors, vectors)
    between = square[:, :, None] + square[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    kept = np.zeros((n, width), dtype=bool)
    count = np.zeros(n, np.int64)
    for k in range(width):
        clash = (kept & (between[:, k, :] < far[:, k, None])).any(axis=1)
        take = (found[:, k] >= 0) & ~clash & (count < most)
        kept[take, k] = True
        count += take
    order = np.argsort(np.where(found < 0, 2, ~kept).astype(np.int8), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(found, order, 1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((n, most - out.shape[1]), -1)], axis=1)
    return out


class Graph:
    """Points, the layer each one reaches, and per layer a matrix of neighbour numbers."""

    def __init__(self, points: np.ndarray, seed: int = 0, neighbours: int = NEIGHBOURS):
        self._take(np.ascontiguousarray(points, dtype=np.float64))
        n = len(points)
        rng = np.random.default_rng(seed)
        height = np.floor(-np.log(1 - rng.random(n)) / np.log(neighbours)).astype(np.int64)
        # tall points first: then every layer exists before points below it search through it
        self.order = np.argsort(-height, kind="stable")
        self.height = height
        self.neighbours = neighbours
        self.links = [np.full((n, neighbours * (2 if layer == 0 else 1)), -1, np.int32)
                      for layer in range(int(height.max(initial=0)) + 1)]
        self.entry = int(self.order[0]) if n else -1
        # the graph doubles from one point, so that no block outgrows what it is linked to
        at = 1
        while at < n:
            size = min(at, INSERT_BLOCK)
            self._insert(self.order[at:at + size])
            at += size

    def _take(self, points: np.ndarray) -> None:
        """Original vectors; the graph compares them in single precision where that can hold them."""
        self.exact = points
        fits = np.abs(points).max(initial=0) < 1e15
        self.points = points.astype(np.float32) if fits else points

    def _descend(self, queries: np.ndarray, layer_to: int) -> np.ndarray:
        entry = np.full((len(queries), 1), self.entry, np.int64)
        for layer in range(len(self.links) - 1, layer_to, -1):
            entry = _beam(self.points, self.links[layer], queries, entry, 1)[0]
        return entry

    def _insert(self, block: np.ndarray) -> None:
        queries = self.points[block]
        top = int(self.height[block].max())
        entry = self._descend(queries, top)
        for layer in range(min(top, len(self.links) - 1), -1, -1):
            found, far = _beam(self.points, self.links[layer], queries, entry, BUILD_BEAM)
            own = np.flatnonzero(self.height[block] >= layer)
            most = self.links[layer].shape[1]
            chosen = _diverse(self.points, found[own], far[own], min(self.neighbours, most))
            self.links[layer][block[own], :chosen.shape[1]] = chosen
            self._link_back(layer, block[own], chosen)
            entry = found[:, :8]

    def _link_back(self, layer: int, block: np.ndarray, chosen: np.ndarray) -> None:
        links = self.links[layer]
        most = links.shape[1]
        target = chosen.reshape(-1).astype(np.int64)
        source = np.repeat(block, chosen.shape[1])
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, starts, counts = np.unique(target, return_index=True, return_counts=True)
        wide = np.full((len(nodes), most + int(counts.max(initial=0))), -1, np.int64)
        wide[:, :most] = links[nodes]
        column = np.arange(len(target)) - np.repeat(starts, counts) + most
        wide[np.repeat(np.arange(len(nodes)), counts), column] = source
        full = (wide >= 0).sum(axis=1) > most
        loose = wide[~full]
        order = np.argsort(loose < 0, axis=1, kind="stable")[:, :most]
        links[nodes[~full]] = np.take_along_axis(loose, order, 1)
        if full.any():
            far = _distances(self.points, wide[full], self.points[nodes[full]])
            order = np.argsort(far, axis=1, kind="stable")
            links[nodes[full]] = _diverse(self.points, np.take_along_axis(wide[full], order, 1),
                                          np.take_along_axis(far, order, 1), most)

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Numbers of the ``beam`` nearest points met, per query, -1 where fewer."""
        queries = np.ascontiguousarray(queries, dtype=self.points.dtype)
        return _beam(self.points, self.links[0], queries, self._descend(queries, 0), beam)[0]

    # a shard travels as one row of flat arrays

    def flat(self) -> dict:
        return {"n": len(self.exact), "dim": self.exact.shape[1], "entry": self.entry,
                "points": self.exact.tobytes(), "layers": [x.tobytes() for x in self.links]}

    @classmethod
    def of(cls, n: int, dim: int, entry: int, points: bytes, layers: list[bytes]) -> Graph:
        graph = cls.__new__(cls)
        graph._take(np.frombuffer(points, np.float64).reshape(n, dim))
        graph.links = [np.frombuffer(x, np.int32).reshape(n, -1) for x in layers]
        graph.entry = entry
        return graph


# ------------------------------------------------------------------ on Spark

def usable(vector: Column) -> Column:
    """Not null, not all zero, and no null or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _points(vectors: DataFrame, top: int) -> DataFrame:
    """Distinct vectors with their ``top`` smallest identifiers.

    The rank filter is pushed below the shuffle as a group limit, so a vector
    that many rows have sends at most ``top`` rows per task.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = vectors.withColumn("rank", rank).where(F.col("rank") <= top)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


SHARD = ("dim int, shard long, n int, entry int, points binary, layers array<binary>, "
         "ids array<array<long>>")


def build(vectors: DataFrame, top: int, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, neighbours: int = NEIGHBOURS) -> DataFrame:
    """One row per shard: its graph as flat arrays and the identifiers of its points."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & usable(F.col("vector"))).distinct()
    points = _points(rows, top).withColumn("dim", F.size("vector")).transform(settled)
    shards = -(-points.count() // shard_rows) or 1

    def one(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        # the order of arrival must not matter: a repeated task has to build the same graph
        frame = frame.assign(first=[x[0] for x in frame["ids"]]).sort_values("first")
        graph = Graph(np.stack(frame["vector"].to_numpy()), int(key[1]), neighbours)
        return pd.DataFrame([{**graph.flat(), "shard": key[1], "ids": [list(x) for x in frame["ids"]]}],
                            columns=[c.split()[0] for c in SHARD.split(", ")])

    dealt = points.withColumn("shard", F.expr(f"pmod(xxhash64(vector), {shards})"))
    return dealt.groupBy("dim", "shard").applyInPandas(one, SHARD).transform(settled)


def meetings(index: DataFrame, queries: DataFrame, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """One row per shard and block of queries of its length: the graph beside the queries.

    There is one partition per shard, which AQE leaves alone: shards hold megabytes and
    long work, so they must not be merged by their size.
    """
    asked = queries.select(F.col(id_col).cast("long").alias("query_id"),
                           F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("query_id").isNotNull() & usable(F.col("vector"))).distinct()
    asked = asked.withColumn("dim", F.size("vector"))
    blocks = -(-asked.count() // QUERY_BLOCK) or 1
    packed = (asked.withColumn("block", F.expr(f"pmod(xxhash64(query_id, vector), {blocks})"))
              .groupBy("dim", "block").agg(F.collect_list("query_id").alias("query_ids"),
                                           F.collect_list("vector").alias("query_vectors")))
    shards = index.agg(F.count(F.lit(1)).alias("n"), F.max("shard").alias("last")).first()
    parts = max(shards.n, 1)
    every = F.sequence(F.lit(0).cast("long"), F.lit(shards.last or 0).cast("long"))
    sent = packed.withColumn("shard", F.explode(every)).repartition(parts, "dim", "shard")
    return index.repartition(parts, "dim", "shard").join(sent.hint("merge"), ["dim", "shard"])


def search(index: DataFrame, queries: DataFrame, top: int,
           id_col: str = "vec_id", vector_col: str = "embedding",
           beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found over all shards of ``index``."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, graph, ids = None, None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                at = row.column("dim")[0].as_py(), row.column("shard")[0].as_py()
                if at != held:  # a shard's blocks follow each other
                    r = row.select([c.split()[0] for c in SHARD.split(", ")]).to_pydict()
                    graph = Graph.of(r["n"][0], r["dim"][0], r["entry"][0], r["points"][0],
                                     r["layers"][0])
                    held, ids = at, r["ids"][0]
                q = np.array(row.column("query_vectors")[0].as_py(), np.float64)
                yield from _best(graph, ids, row.column("query_ids")[0].as_py(), q, top, beam)

    meeting = meetings(index, queries, id_col, vector_col)
    found = meeting.mapInArrow(look, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    # a repeated query identifier with two vectors asks once; the nearer answers stay
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return (best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def _best(graph: Graph, ids: list[list[int]], query_ids: list[int], queries: np.ndarray, top: int,
          beam: int) -> Iterator[pa.RecordBatch]:
    """Each query's ``top`` nearest identifiers in one shard, exact distances."""
    for at in range(0, len(queries), INSERT_BLOCK):
        q = queries[at:at + INSERT_BLOCK]
        near = graph.search(q, max(beam, top + 1))
        which, score = [], []
        out_ids = []
        exact = np.sqrt(_distances(graph.exact, near, q))
        for k, query_id in enumerate(query_ids[at:at + INSERT_BLOCK]):
            rows = [(d, i) for d, p in zip(exact[k].tolist(), near[k].tolist(), strict=True)
                    if p >= 0 for i in ids[p] if i != query_id]
            for d, i in sorted(rows)[:top]:
                which.append(query_id)
                out_ids.append(i)
                score.append(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int64()), pa.array(out_ids, pa.int64()),
             pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, top: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
            beam: int = SEARCH_BEAM) -> DataFrame:
    """The ``top`` nearest rows of ``vectors`` found for each row of ``queries``."""
    # one identifier more than asked for, since the query's own may be among them
    index = build(vectors, top + 1, id_col, vector_col, shard_rows)
    return search(index, queries, top, id_col, vector_col, beam)
