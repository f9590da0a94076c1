"""Approximate nearest neighbours through learned partitions.

A bounded sample of vectors (``SAMPLE``, by hash of the id) gives a neighbour
graph; its nodes are dealt into balanced parts that cut few edges; a small
classifier (one hidden layer) learns where a vector's neighbours lie.  It puts
every vector of the table into its most probable part and routes a query to
its ``probes`` most probable ones, where all vectors are ranked by their exact
inner product in double precision.  ``probes`` is the smallest number that
reaches ``TARGET`` recall for held-out sample vectors against brute force.

Scale: every row is indexed, in one pass.  A part is worked on in blocks of at
most about ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES`` queries, however many rows share a part
or a vector; a block gives each of its queries at most k rows.  The driver
holds the sample, the classifier and a count per part.

Edge cases: a vector that is null, empty, all zero, of another dimension than
most of the sample, or with a null or non-finite component takes no part, nor does a row without id;
ties go to the smaller id; rows that share an id are one candidate (and one
query), by the best of their scores; fewer candidates than k: all of them; no
valid vector: an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import map_arrow, written

SAMPLE = 8192
PART_NODES = 256        # sample nodes per part
MAX_PARTS = 32
NEIGHBOURS = 12
TARGET = 0.95
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 2048
HIDDEN = 128


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part."""
    v = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vec"))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(sound, F.lit(False)) & F.coalesce(F.exists("vec", lambda x: x != 0), F.lit(False)))


@dataclass
class Router:
    """Classifier of vectors into parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows of largest inner product with each row, nearest first."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        s = x[a:a + 1024] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        near = np.argpartition(-s, k - 1, axis=1)[:, :k] if k else np.empty((len(s), 0), np.int64)
        order = np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable")
        out[a:a + 1024] = np.take_along_axis(near, order, 1)
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Parts of at most 1.1 times the mean size: nearest centres under that capacity, then moves that cut fewer edges."""
    n, room = len(x), int(np.ceil(1.1 * len(x) / parts))
    centres = x[rng.choice(n, parts, replace=False)]
    for _ in range(6):
        s = x @ centres.T
        part, size = np.full(n, -1), np.zeros(parts, np.int64)
        for i in np.argsort(-s.max(1), kind="stable"):
            for j in np.argsort(-s[i], kind="stable"):
                if size[j] < room:
                    part[i], size[j] = j, size[j] + 1
                    break
        for j in range(parts):
            if size[j]:
                c = x[part == j].mean(0)
                centres[j] = c / max(np.linalg.norm(c), 1e-300)
    both = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()], 1),
                           np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])], 1)])
    for _ in range(rounds):
        links = np.zeros((n, parts), np.int32)
        np.add.at(links, (both[:, 0], part[both[:, 1]]), 1)
        best = links.argmax(1)
        gain = links[np.arange(n), best] - links[np.arange(n), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[:int((gain > 0).sum())]:
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i], moved = best[i], moved + 1
        if not moved:
            break
    return part


def train_router(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, epochs: int = 25) -> Router:
    """Fit the classifier to ``target``, the share of each row's neighbours in each part (Adam, cross entropy)."""
    d, parts = x.shape[1], target.shape[1]
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    ws = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(2 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(w) for w in ws], [np.zeros_like(w) for w in ws], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            i = order[a:a + 256]
            h = np.maximum(x[i] @ ws[0] + ws[1], 0)
            z = h @ ws[2] + ws[3]
            z = np.exp(z - z.max(1, keepdims=True))
            g = (z / z.sum(1, keepdims=True) - target[i]) / len(i)
            gh = (g @ ws[2].T) * (h > 0)
            step += 1
            for k, grad in enumerate((x[i].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                ws[k] -= 0.003 * (1 - epoch / epochs) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*ws)


def learn(x: np.ndarray, k: int, target_recall: float = TARGET, seed: int = 5) -> Router:
    """Parts, classifier and number of probes from the sample."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    x = x[rng.permutation(len(x))]
    parts = int(min(MAX_PARTS, max(1, len(x) // PART_NODES)))
    if parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    held, x = x[:len(x) // 8], x[len(x) // 8:]
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(x / np.linalg.norm(x, axis=1, keepdims=True), graph, parts, rng)
    near = np.zeros((len(x), parts))
    np.add.at(near, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    np.add.at(near, (np.arange(len(x)), part), 2.0)
    router = train_router(x, near / near.sum(1, keepdims=True), rng)
    where = router.scores(x).argmax(1)
    routed = np.argsort(-router.scores(held), axis=1, kind="stable")
    truth = np.argsort(-(held @ x.T), axis=1, kind="stable")[:, :k]
    place = np.argsort(routed, axis=1)                      # rank of each part for each query
    needed = np.take_along_axis(place, where[truth], 1)
    recall = [(needed < m).mean() for m in range(1, parts + 1)]
    router.probes = next((m for m, r in enumerate(recall, 1) if r >= target_recall), parts)
    return router


def fit(vectors: DataFrame, k: int, sample: int = SAMPLE, target_recall: float = TARGET) -> Router | None:
    rows = vectors.orderBy(F.xxhash64("id"), "id", "vec").limit(sample).collect()
    if not rows:
        return None
    sizes = [len(r.vec) for r in rows]
    dim = max(set(sizes), key=sizes.count)
    return learn(np.array([r.vec for r in rows if len(r.vec) == dim]), k, target_recall)


def top(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int):
    """For each query the k candidates of largest inner product, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    depth = k + len(ids) - len(np.unique(ids))
    for a in range(0, len(q), 256):
        s = q[a:a + 256] @ x.T
        s[q_ids[a:a + 256, None] == ids[None, :]] = -np.inf
        if len(ids) > depth:
            least = np.partition(s, len(ids) - depth, axis=1)[:, len(ids) - depth]
        else:
            least = np.full(len(s), -np.inf)
        for j, row in enumerate(s):
            # products of a matrix multiply differ in their last bits; all that may be among the best are computed alike
            i = np.flatnonzero((row >= least[j] - 1e-9 * (1 + abs(least[j]))) & (row > -np.inf)) if np.isfinite(least[j]) else np.flatnonzero(row > -np.inf)
            exact = (x[i] * q[a + j]).sum(1)
            best = i[np.lexsort((ids[i], -exact))[:depth]]
            yield q_ids[a + j], ids[best], (x[best] * q[a + j]).sum(1)


def search(vectors: DataFrame, queries: DataFrame, k: int, router: Router | None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query among ``vectors`` (both ``id, vec``), its own id left out."""
    spark = vectors.sparkSession
    if router is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = router.w1.shape[0]
    routed = T.StructType([T.StructField("id", T.LongType()), T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("part", T.IntegerType())])

    def route(probes):
        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.asarray(b.column(1).flatten()).reshape(-1, dim)
                best = np.argsort(-router.scores(x), axis=1, kind="stable")[:, :probes]
                at = pa.array(np.repeat(np.arange(b.num_rows), best.shape[1]))
                yield [b.column(0).take(at), b.column(1).take(at), pa.array(best.ravel().astype(np.int32))]

        return run

    same = F.size("vec") == dim
    index = written(map_arrow(vectors.filter(same), route(1), routed), "ann-index")
    asked = written(map_arrow(queries.filter(same), route(router.probes), routed), "ann-queries")
    # a row per part: blocks of vectors and of queries
    blocks = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("nb")).join(
        asked.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("nq")), "part")
    blocks = F.broadcast(written(blocks, "ann-blocks"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("id", "vec"), F.col(n)).cast("int")
    left = asked.join(blocks, "part").select("part", deal("nq").alias("qb"), spread("nb").alias("b"), "id", "vec")
    right = index.join(blocks, "part").select("part", spread("nq").alias("qb"), deal("nb").alias("b"), "id", "vec")
    found = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def rank(q: pa.Table, c: pa.Table) -> pa.Table:
        out = [(np.full(0, 0), np.full(0, 0), np.full(0, 0.0))]
        if q.num_rows and c.num_rows:
            (q_ids, qx), (ids, x) = ((np.asarray(t.column("id")), np.asarray(t.column("vec").combine_chunks().flatten()).reshape(-1, dim)) for t in (q, c))
            out += [(np.full(len(i), qi), i, s) for qi, i, s in top(ids, x, q_ids, qx, k)]
        cols = [np.concatenate([o[j] for o in out]) for j in range(3)]
        return pa.table([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2])], names=["query_id", "vec_id", "score"])

    keys = ["part", "qb", "b"]
    got = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rank, found)
    best = got.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest found of every row whose id is divisible by ``every``, against all rows."""
    vectors = valid_vectors(df, id_col, vector)
    return search(vectors, vectors.filter(F.col("id") % every == 0), k, fit(vectors, k))
