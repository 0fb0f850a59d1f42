"""Nearest neighbours by vantage-point trees, one for each shard of the vectors."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadtables.session import stage

#: Vectors of a shard on average; a shard's tree and one batch of queries are what a task holds.
SHARD_ROWS = 16_384
#: Vectors of a leaf.
LEAF = 256
#: Queries searched together.
_QUERIES = 256


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean, from the differences themselves."""
    out = np.empty((len(queries), len(points)))
    for i in range(0, len(queries), 32):
        gap = queries[i:i + 32, None, :] - points[None, :, :]
        out[i:i + 32] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


class Tree:
    """A vantage-point tree over distinct points; equal vectors are one point with their ids in order, so copies do not
    deepen it. Inner nodes: (point, radius, inside, outside, (least, greatest) distance on either side)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.points, at = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, at.ravel()))
        self.ids = ids[order]
        self.starts = np.searchsorted(at.ravel()[order], np.arange(len(self.points) + 1))
        self.root = self._build(np.arange(len(self.points)), np.random.default_rng(0))

    def _build(self, own: np.ndarray, rng: np.random.Generator):
        if len(own) <= LEAF:
            return own
        sample = self.points[rng.choice(own, min(64, len(own)), replace=False)]
        tries = rng.choice(own, 8, replace=False)
        vantage = int(tries[np.argmax(distances(self.points[tries], sample).var(axis=1))])
        far = distances(self.points[vantage][None], self.points[own])[0]
        order = np.argsort(far, kind="stable")
        half = len(own) // 2
        near, rest = own[order[:half]], own[order[half:]]
        spans = (far[order[0]], far[order[half - 1]], far[order[half]], far[order[-1]])
        return vantage, spans, self._build(near, rng), self._build(rest, rng)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """For each query the k nearest ids but its own, nearest first, ties to the smaller id; -1 where there are fewer.

        A side of a node is left out if, by the triangle inequality, all of it is farther than `factor` times the k-th
        distance so far. Factor 1 is exact; a smaller one leaves out more.
        """
        self.best = np.full((len(queries), k), np.inf)
        self.names = np.full((len(queries), k), -1, np.int64)
        self._walk(self.root, np.arange(len(queries)), queries, own, k, factor)
        return self.names, self.best

    def _walk(self, node, active: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> None:
        if not len(active):
            return
        if isinstance(node, np.ndarray):
            self._merge(node, active, queries, own, k)
            return
        vantage, (low, radius, beyond, high), inside, outside = node
        d = distances(queries[active], self.points[vantage][None])[:, 0]
        gaps = (np.maximum(np.maximum(low - d, d - radius), 0), np.maximum(np.maximum(beyond - d, d - high), 0))
        first_in = gaps[0] <= gaps[1]
        slack = 1 + 1e-12
        sides = (inside, outside)
        for near in (0, 1):
            mine = first_in if near == 0 else ~first_in
            self._walk(sides[near], active[mine], queries, own, k, factor)
            mine = mine & (gaps[1 - near] <= factor * self.best[active, k - 1] * slack + 1e-12)
            self._walk(sides[1 - near], active[mine], queries, own, k, factor)

    def _merge(self, points: np.ndarray, active: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> None:
        far = distances(queries[active], self.points[points])
        for row, q in enumerate(active):
            near = np.flatnonzero(far[row] <= self.best[q, k - 1])
            if not len(near):
                continue
            ids = [self.ids[self.starts[p]:self.starts[p + 1]][:k + 1] for p in points[near]]
            names = np.concatenate([*ids, self.names[q]])
            dist = np.concatenate([np.repeat(far[row, near], [len(i) for i in ids]), self.best[q]])
            keep = np.flatnonzero((names != own[q]) | (dist == np.inf))
            order = keep[np.lexsort((names[keep], dist[keep]))][:k]
            self.names[q], self.best[q] = names[order], dist[order]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest vectors by Euclidean distance in double precision.

    Both tables hold vec_id and embedding. Vectors are dealt to shards by hash of their id, each shard's tree is built
    once and written, and all queries visit all shards, where their shard lists meet the tree in a stream of bounded
    batches. A query's own row is no candidate; fewer candidates give fewer rows; ties go to the smaller vec_id. Null
    ids and vectors that are null, zero or hold null or non-finite components take no part, and only vectors of the
    same length are compared. Rows that repeat an id and vector count once. Extra columns are ignored.
    """
    points = _usable(vectors)
    counted = points.groupBy("size").agg(F.countDistinct("vec_id").alias("n")).collect()
    shards = {r["size"]: -(-r["n"] // shard_rows) for r in counted}
    if not shards:
        return points.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    number = F.coalesce(*(F.when(F.col("size") == s, F.lit(n)) for s, n in shards.items())).cast("long")
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec_id"), number)).repartition("size", "shard").sortWithinPartitions("size", "shard")
    trees = stage(dealt.mapInArrow(_plant, "size int, shard long, kind int, vec_id long, embedding array<double>, tree binary"), "trees")
    asked = _usable(queries).where(F.col("size").isin(*shards)).withColumn("shard", F.explode(F.sequence(F.lit(0), number - 1)))
    asked = asked.select("size", "shard", F.lit(1).alias("kind"), "vec_id", "embedding", F.lit(None).cast("binary").alias("tree"))
    rows = trees.unionByName(asked).repartition("size", "shard").sortWithinPartitions("size", "shard", "kind")

    def search(batches):
        tree = None
        for batch in batches:
            kinds = batch.column(2).to_numpy()
            at = 0
            while at < len(kinds):
                if kinds[at] == 0:
                    tree = pickle.loads(batch.column(5)[at].as_py())
                    at += 1
                    continue
                to = at
                while to < len(kinds) and kinds[to] == 1 and to - at < _QUERIES:
                    to += 1
                part = batch.slice(at, to - at)
                ids = part.column(3).to_numpy()
                asked = np.array(part.column(4).to_pylist(), np.float64)
                names, best = tree.search(asked, ids, k, factor)
                found = np.isfinite(best)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, found.sum(axis=1))), pa.array(names[found]), pa.array(best[found])],
                                                 names=["query_id", "vec_id", "score"])
                at = to

    hits = rows.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (double), size, of the vectors that take part; a repeated row once."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return v.where(F.col("vec_id").isNotNull() & F.coalesce(fits, F.lit(False))).distinct().withColumn("size", F.size("embedding"))


def _plant(batches):
    """One row with the tree of each shard; the rows of a shard follow each other."""
    key, ids, vectors = None, [], []

    def tree():
        grown = Tree(np.concatenate(ids), np.concatenate(vectors))
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([0], pa.int32()), pa.nulls(1, pa.int64()),
             pa.nulls(1, pa.list_(pa.float64())), pa.array([pickle.dumps(grown)], pa.binary())],
            names=["size", "shard", "kind", "vec_id", "embedding", "tree"])

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes, shards = batch.column("size").to_numpy(), batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero((sizes[1:] != sizes[:-1]) | (shards[1:] != shards[:-1])) + 1), len(sizes)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = (int(sizes[a]), int(shards[a]))
            if own != key and ids:
                yield tree()
                ids, vectors = [], []
            key = own
            part = batch.slice(a, b - a)
            ids.append(part.column("vec_id").to_numpy())
            vectors.append(np.array(part.column("embedding").to_pylist(), np.float64))
    if ids:
        yield tree()
