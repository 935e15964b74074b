"""Centroid clustering of integer vectors with bounds over the centroids' history (ns-bounds).

A vector carries its cluster, the distance to its centroid and the least distance to another one, each with the
round in which it was computed. The centroids of all rounds are kept. A later round loosens a bound by the
norm of the centroid's total displacement since that round, which is never more than the sum of the
steps between. Where the loosened bounds still tell the own centroid from all others, nothing is computed;
else the own distance is made exact, and if that does not decide either, all centroids are scanned.

State lies in the row of its vector, so a round is one pass without a shuffle. Sums of clusters change by
the vectors that moved. All arithmetic that decides is on integers; bounds are kept apart by more than the
rounding of a double, and a tie is always scanned.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import staged

DIMENSIONS = 64
#: A component counts as floor(GRID * component).
GRID = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
#: Largest size of an integer component: squared distances of 64 of them fit a long.
LARGEST = 1 << 27
#: Bounds closer than this, relatively, are not trusted.
MARGIN = 1e-9
#: Products below this are exact as doubles.
EXACT = 1 << 53
STATE = (
    "vec_id long, v array<int>, cluster int, before int, upper double, upper_at int, lower double, "
    "lower_at int, distance long"
)
STATE_TYPES = [
    ("cluster", pa.int32()), ("before", pa.int32()), ("upper", pa.float64()), ("upper_at", pa.int32()),
    ("lower", pa.float64()), ("lower_at", pa.int32()), ("distance", pa.int64()),
]


def integer_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, v) of the vectors with all components finite, on the integer grid.

    A component beyond ``LARGEST`` on the grid is an error: its distances would not fit a long.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def component(x: Column) -> Column:
        scaled = x.cast("double") * GRID
        too_large = F.raise_error(F.lit(f"a component is larger than {LARGEST // GRID}")).cast("long")
        return F.when(F.abs(scaled) < LARGEST, F.floor(scaled)).otherwise(too_large).cast("int")

    kept = embeddings.filter((F.size("embedding") == dimensions) & finite)
    return kept.select("vec_id", F.transform("embedding", component).alias("v"))


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of every vector to every centroid, as int64."""
    largest = max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0))
    if 4 * int(largest) ** 2 * vectors.shape[1] < EXACT:
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]
        return d.astype(np.int64)
    return np.stack([own_squared(vectors, c[None, :]) for c in centroids], axis=1)


def own_squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of every vector to the centroid in its row."""
    d = vectors - centroids
    return np.einsum("ij,ij->i", d, d)


def displacements(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """[round, cluster]: way of a centroid from that round to the last, and the longest of all others."""
    now = history[-1].astype(np.float64)
    own = np.stack([np.sqrt(((now - c) ** 2).sum(1)) for c in history])
    others = np.zeros_like(own)
    for j in range(own.shape[1] if own.shape[1] > 1 else 0):
        others[:, j] = np.delete(own, j, axis=1).max(1)
    return own, others


def assign(batches: Iterator[pa.RecordBatch], history: list[np.ndarray], last: bool) -> Iterator[pa.RecordBatch]:
    """One round: every vector to its nearest centroid, ties to the smaller number."""
    now, centroids = len(history) - 1, history[-1]
    own_way, other_way = displacements(history)
    for batch in batches:
        n = batch.num_rows
        v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
        if now == 0:
            cluster = np.full(n, -1)
            before, upper, lower = cluster, np.zeros(n), np.zeros(n)
            upper_at = lower_at = np.zeros(n, np.int64)
            scan = np.arange(n)
        else:
            get = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            cluster, upper, lower = get("cluster").copy(), get("upper").copy(), get("lower").copy()
            upper_at, lower_at, before = get("upper_at").copy(), get("lower_at").copy(), cluster.copy()
            far = (lower - other_way[lower_at, cluster]) * (1 - MARGIN) - MARGIN
            near = (upper + own_way[upper_at, cluster]) * (1 + MARGIN) + MARGIN
            open_ = np.flatnonzero(~(near < far))
            upper[open_] = np.sqrt(own_squared(v[open_], centroids[cluster[open_]]))
            upper_at[open_] = now
            scan = open_[~(upper[open_] * (1 + MARGIN) + MARGIN < far[open_])]
        if len(scan):
            d = squared(v[scan], centroids)
            best = d.argmin(1)
            rows = np.arange(len(scan))
            cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
            upper_at, lower_at = upper_at.copy(), lower_at.copy()
            cluster[scan], upper[scan] = best, np.sqrt(d[rows, best])
            d[rows, best] = np.iinfo(np.int64).max
            lower[scan] = np.sqrt(d.min(1)) if d.shape[1] > 1 else np.inf
            upper_at[scan] = lower_at[scan] = now
        distance = own_squared(v, centroids[cluster]) if last else np.zeros(n, np.int64)
        found = (cluster, before, upper, upper_at, lower, lower_at, distance)
        columns = [pa.array(x, type=t) for x, (_, t) in zip(found, STATE_TYPES, strict=True)]
        names = ["vec_id", "v", *[name for name, _ in STATE_TYPES]]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), *columns], names)


def moved_sums(state: DataFrame, dimensions: int) -> DataFrame:
    """(cluster, n, s0, s1, ...): what the vectors that changed their cluster add to it or take from it."""
    moved = state.filter("cluster <> before")
    arrived = moved.select("cluster", F.lit(1).cast("long").alias("sign"), "v")
    left = moved.filter("before >= 0").select(
        F.col("before").alias("cluster"), F.lit(-1).cast("long").alias("sign"), "v"
    )
    return arrived.union(left).groupBy("cluster").agg(
        F.sum("sign").alias("n"),
        *[F.sum(F.col("sign") * F.get("v", F.lit(i))).alias(f"s{i}") for i in range(dimensions)],
    )


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hash of seed and id; of one id, the smaller components first."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(key.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return np.array([r["v"] for r in chosen], dtype=np.int64)


def centroid_rounds(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
    dimensions: int = DIMENSIONS,
) -> tuple[list[DataFrame], list[np.ndarray]]:
    """State after each assignment, and the centroids it was made to. See ``clustered``."""
    vectors = staged(integer_vectors(embeddings, dimensions), "vectors")
    history = [first_centroids(vectors, clusters, seed)]
    if not len(history[0]):
        return [], history
    sums = np.zeros((len(history[0]), dimensions + 1), dtype=object)
    state, states = vectors, []
    for number in range(rounds + 1):
        step = partial(assign, history=list(history), last=number == rounds)
        state = staged(state.mapInArrow(step, STATE), f"round-{number}")
        states.append(state)
        if number == rounds:
            break
        # As many rows as clusters.
        for r in moved_sums(state, dimensions).collect():
            sums[r["cluster"]] += np.array(list(r)[1:], dtype=object)
        following = history[-1].copy()
        for j, (n, *s) in enumerate(sums):
            if n:
                following[j] = [x // n for x in s]
        history.append(following)
    return states, history


def clustered(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector.

    Vectors that are NULL, have another number of components than ``dimensions`` or hold a NULL or non-finite one take
    no part. The first centroids are vectors chosen by a hash of their id, fewer than ``clusters`` if there are fewer
    vectors; a vector without id can be chosen only then. Each of ``rounds`` rounds assigns all vectors, ties to the
    smaller number, and sets every centroid that has vectors to the floor of their mean; then all are assigned once
    more. Rows of one id are vectors of their own, equal vectors may share a first centroid's place, and empty clusters
    stay. Other columns take no part; an empty table gives no row.
    """
    spark = embeddings.sparkSession
    states, history = centroid_rounds(embeddings, clusters, rounds, seed, dimensions)
    facts_schema = "number int, cluster_inertia long, inertia long, centroid string"
    if not states:
        final = spark.createDataFrame([], "vec_id long, cluster int, distance long")
        facts = spark.createDataFrame([], facts_schema)
    else:
        final = states[-1]
        by_cluster = final.groupBy("cluster").agg(F.sum("distance").alias("s"))
        totals = {r["cluster"]: r["s"] for r in by_cluster.collect()}
        whole = sum(totals.values())
        texts = [",".join(map(str, c)) for c in history[-1].tolist()]
        facts = spark.createDataFrame([(j, s, whole, texts[j]) for j, s in totals.items()], facts_schema)
    # One row for each cluster.
    return final.join(F.broadcast(facts), F.col("cluster") == F.col("number")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2("centroid", 256).alias("centroid_sha256"),
    )
