"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the neighbour graph is cut into balanced partitions (recursive bisection: a
spectral split at the median, refined by swaps that shorten the cut), and a small neural network learns
which partitions a vector's neighbours lie in. Every vector is then put into its most probable
partition; a query goes to its ``probes`` most probable ones and is compared there exactly. ``probes``
is the least number that finds ``TARGET`` of the true neighbours of further sampled vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.llm.common import staged

#: Sampled vectors for the graph and the network, and further ones to choose ``probes``.
FIT_ROWS, CHECK_ROWS = 4000, 500
PARTITIONS = 32
GRAPH_NEIGHBOURS = 10
HIDDEN, EPOCHS, BATCH, RATE = 128, 40, 128, 2e-3
TARGET = 0.98
#: Candidates and queries compared in one group.
BLOCK_ROWS, BLOCK_QUERIES = 1024, 1024

FOUND = "query_id long, vec_id long, score double"


def usable(column: str) -> Column:
    """Neither NULL nor empty, no NULL or non-finite component, not all zero."""
    big = float(np.finfo(np.float32).max)
    v = F.col(column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= big))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(points: np.ndarray, among: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """Positions of the ``k`` nearest rows of ``among`` for each point."""
    squares = np.square(among).sum(axis=1)
    k = min(k, len(among) - skip_self)
    found = np.zeros((len(points), max(0, k)), np.int64)
    for a in range(0, len(points) if k > 0 else 0, 512):
        part = points[a : a + 512]
        distance = squares - 2 * part @ among.T
        if skip_self:
            distance[np.arange(len(part)), np.arange(a, a + len(part))] = np.inf
        found[a : a + 512] = np.argpartition(distance, k - 1, axis=1)[:, :k]
    return found


def balanced_partitions(graph: np.ndarray, parts: int) -> np.ndarray:
    """A partition number for each node of a neighbour graph; sizes differ by at most a few."""
    labels = np.zeros(len(graph), np.int64)
    stack = [(np.arange(len(graph)), 0, parts)]
    while stack:
        nodes, first, count = stack.pop()
        labels[nodes] = first
        if count > 1 and len(nodes) > 1:
            left, right = bisect(graph, nodes, count // 2 / count)
            stack += [(left, first, count // 2), (right, first + count // 2, count - count // 2)]
    return labels


def bisect(graph: np.ndarray, nodes: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Splits ``nodes`` so that the left side has ``share`` of them and few edges cross."""
    place = np.full(len(graph), -1)
    place[nodes] = np.arange(len(nodes))
    source = np.repeat(np.arange(len(nodes)), graph.shape[1])
    target = place[graph[nodes].ravel()]
    source, target = source[target >= 0], target[target >= 0]
    n = len(nodes)
    degree = np.bincount(source, minlength=n) + np.bincount(target, minlength=n) + 1.0

    def spread(x: np.ndarray) -> np.ndarray:
        return (np.bincount(source, x[target], n) + np.bincount(target, x[source], n) + x) / degree

    x = np.random.default_rng(3).standard_normal(n)
    for _ in range(60):
        x = spread(x)
        x -= (x * degree).sum() / degree.sum()
        x /= np.linalg.norm(x) + 1e-12
    size = min(max(1, round(n * share)), n - 1)
    left = np.zeros(n, bool)
    left[np.argsort(x, kind="stable")[:size]] = True
    for _ in range(8):
        side = np.where(left, 1.0, -1.0)
        pull = np.bincount(source, side[target], n) + np.bincount(target, side[source], n)
        from_left = np.flatnonzero(left)[np.argsort(pull[left], kind="stable")]
        from_right = np.flatnonzero(~left)[np.argsort(-pull[~left], kind="stable")]
        m = min(len(from_left), len(from_right), max(1, n // 20))
        gain = pull[from_right[:m]] - pull[from_left[:m]]
        swaps = int((gain > 0).sum() // 2)
        if not swaps:
            break
        left[from_left[:swaps]], left[from_right[:swaps]] = False, True
    return nodes[left], nodes[~left]


@dataclass
class Router:
    """Two-layer network from a vector to the scores of the partitions."""

    mean: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def best(self, x: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` most probable partitions, the most probable first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :count]


def train_router(x: np.ndarray, wanted: np.ndarray) -> Router:
    """Fits the network to each vector's distribution over partitions, by Adam on cross entropy."""
    draw = np.random.default_rng(11)
    d, parts = x.shape[1], wanted.shape[1]
    mean = x.mean(axis=0)
    router = Router(
        mean, 1 / (x.std() + 1e-9),
        draw.standard_normal((d, HIDDEN)) * (2 / d) ** 0.5, np.zeros(HIDDEN),
        draw.standard_normal((HIDDEN, parts)) * (1 / HIDDEN) ** 0.5, np.zeros(parts),
    )
    weights = [router.w1, router.b1, router.w2, router.b2]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(x))
        for a in range(0, len(x), BATCH):
            rows = order[a : a + BATCH]
            inputs = (x[rows] - mean) * router.scale
            hidden = np.maximum(inputs @ router.w1 + router.b1, 0)
            scores = hidden @ router.w2 + router.b2
            p = np.exp(scores - scores.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - wanted[rows]) / len(rows)
            back = error @ router.w2.T * (hidden > 0)
            steps = [inputs.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, m, v, g in zip(weights, first, second, steps, strict=True):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return router


def learn(sample: np.ndarray, check: np.ndarray, k: int, parts: int = PARTITIONS) -> Router:
    """Graph, partitions, network and number of probes from sampled vectors."""
    parts = max(1, min(parts, len(sample) // 8))
    graph = nearest(sample, sample, GRAPH_NEIGHBOURS, skip_self=True)
    labels = balanced_partitions(graph, parts)
    wanted = np.zeros((len(sample), parts))
    for column in [np.arange(len(sample)), *graph.T]:
        np.add.at(wanted, (np.arange(len(sample)), labels[column]), 1)
    router = train_router(sample, wanted / wanted.sum(axis=1, keepdims=True))
    router.probes = parts
    if len(check):
        home = router.best(sample, 1)[:, 0]
        order = router.best(check, parts)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(check), axis=0), axis=1)
        needed = np.take_along_axis(place, home[nearest(check, sample, k)], axis=1)
        reached = [(needed < p).mean() for p in range(1, parts + 1)]
        router.probes = next((p for p, r in enumerate(reached, 1) if r >= TARGET), parts)
    return router


def _routed(router: Router, spark) -> Column:
    shared = spark.sparkContext.broadcast(router)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def partitions(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        for column in columns:
            if len(column):
                x = np.stack(column.to_numpy()).astype(np.float64)
                yield pd.Series(list(known.best(x, known.probes).astype(np.int32)), dtype=object)
            else:
                yield pd.Series([], dtype=object)

    return partitions(F.col("vector"))


def _search(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        asked = group["is_query"].to_numpy()
        vectors = np.stack(group["vector"].to_numpy()).astype(np.float64)
        ids = group["vec_id"].to_numpy()
        candidates, names = vectors[~asked], ids[~asked]
        found = []
        for query, name in zip(vectors[asked], ids[asked], strict=True):
            score = np.sqrt(np.square(candidates - query).sum(axis=1))
            best = np.lexsort((names, score))[: k + 1]
            best = best[names[best] != name][:k]
            found += [(name, names[j], score[j]) for j in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return run


def _numbers(count: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count).cast("long") - 1))


def neighbours(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query, nearest first.

    Queries are the vectors whose vec_id is divisible by ``every``; candidates are all others. The score
    is the Euclidean distance in double precision, ties go to the smaller vec_id. Rows without vec_id and
    vectors that are NULL, empty, zero or hold a NULL or non-finite component take no part, nor do those of
    another length than the most common one (the smaller on a tie). Rows equal in vec_id and vector count
    once. Of equal vectors only the ``k`` + 1 smallest ids can be among anybody's nearest; the others
    are left out of the index without changing a result. An empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    rows = embeddings.filter(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")
    )
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == length["d"]).distinct()
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    queries = F.pmod("vec_id", F.lit(every)) == 0
    place = F.row_number().over(smallest)
    kept = rows.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    vectors = staged(kept, "ann-vectors")

    by_hash = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS + CHECK_ROWS).collect()
    sample = np.array([r["vector"] for r in by_hash], dtype=np.float64)
    size = len(sample) * FIT_ROWS // (FIT_ROWS + CHECK_ROWS)
    router = learn(sample[:size], sample[size:], k) if size > 1 else learn(sample, sample[:0], k)

    index = staged(vectors.withColumn("parts", _routed(router, spark)), "ann-index")
    # A query that equals more than k + 1 others may not be in the index; it is routed by itself.
    asked = rows.filter(queries).withColumn("parts", _routed(router, spark))
    asked = staged(asked.withColumn("part", F.explode("parts")).drop("parts"), "ann-queries")
    index = index.withColumn("part", F.col("parts")[0]).drop("parts")
    parts = (
        index.groupBy("part")
        .agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
        .join(
            asked.groupBy("part").agg(
                F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks")
            ),
            "part",
        )
    )
    # One row for each partition, at most PARTITIONS.
    parts = F.broadcast(parts)
    own = F.xxhash64("vec_id", F.lit(1))
    candidates = (
        index.join(parts, "part")
        .withColumn("block", F.pmod(own, F.col("blocks")))
        .withColumn("query_block", _numbers("query_blocks"))
        .withColumn("is_query", F.lit(False))
    )
    dealt = (
        asked.join(parts, "part")
        .withColumn("query_block", F.pmod(own, F.col("query_blocks")))
        .withColumn("block", _numbers("blocks"))
        .withColumn("is_query", F.lit(True))
    )
    columns = ["part", "block", "query_block", "is_query", "vec_id", "vector"]
    found = (
        candidates.select(*columns)
        .union(dealt.select(*columns))
        .groupBy("part", "block", "query_block")
        .applyInPandas(_search(k), FOUND)
    )
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
