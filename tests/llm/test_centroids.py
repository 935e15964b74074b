"""Clusters against plain rounds over all distances, with awkward vectors; the SQL on the given table."""

import hashlib
import math

import numpy as np
import pytest
from support import SMALL

from contract.compare import connect, difference
from regiostat.llm import centroids as C
from regiostat.llm.oracle import clusters_sql
from regiostat.llm.queries import op13_centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, v string, distance string"


def plain(rows, clusters=40, rounds=5, seed=2, dimensions=64):
    """Plain rounds with Python integers; (vec_id, cluster, distance, its inertia, all, hash) of each vector."""
    kept = [
        (r[0], [math.floor(256 * float(x)) for x in r[1]])
        for r in rows
        if r[1] is not None and len(r[1]) == dimensions and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    name = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centres = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    square = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for number in range(rounds + 1):
        best = [min((square(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        if number < rounds:
            for j in range(len(centres)):
                own = [v for (_, v), (_, b) in zip(kept, best, strict=True) if b == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    total = {}
    for d, j in best:
        total[j] = total.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    found = [(i, j, d, total[j], sum(total.values()), sha[j]) for (i, _), (d, j) in zip(kept, best, strict=True)]
    return sorted(found, key=str)


def got(df):
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def random_rows(n, dimensions=64, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimensions))
    made = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dimensions)) * spread
    return [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(made)]


def test_the_sql_gives_the_same(spark):
    assert difference(op13_centroids(spark, SMALL), connect(SMALL), clusters_sql()) is None


def test_awkward_vectors(spark):
    good = random_rows(70)
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] * 64), (105, [nan] * 64),
           (106, [inf] + [0.0] * 63), (107, [0.0] * 63 + [-inf])]
    more = [(None, good[3][1]), (5, good[5][1]), (5, good[6][1]), (108, [0.0] * 64), (109, [-0.001] * 64), (110, [1000.5] * 64)]
    rows = good + bad + more + good[:10]
    assert got(C.clustered(vectors(spark, rows))) == plain(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 41])
def test_few_vectors(spark, n):
    rows = random_rows(n)
    assert got(C.clustered(vectors(spark, rows))) == plain(rows)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(k, [float(k % 3), 0.0]) for k in range(60)]
    want = plain(rows, clusters=8, rounds=3, dimensions=2)
    assert got(C.clustered(vectors(spark, rows), clusters=8, rounds=3, dimensions=2)) == want


def test_large_components_are_exact_and_too_large_ones_an_error(spark):
    rows = [(k, [s * 400_000.0 + 64 * k, -s * 300_000.0]) for k in range(50) for s in (1, -1)]
    want = plain(rows, clusters=5, rounds=4, dimensions=2)
    assert got(C.clustered(vectors(spark, rows), clusters=5, rounds=4, dimensions=2)) == want
    with pytest.raises(Exception, match="larger than"):
        C.clustered(vectors(spark, [(1, [1e30, 0.0])]), dimensions=2).collect()


def test_bounds_spare_scans_and_a_total_displacement_is_used(spark):
    rows = random_rows(3000, spread=0.2)
    states, history = C.centroid_rounds(vectors(spark, rows), clusters=8)
    assert len(states) == C.ROUNDS + 1 == len(history)
    scanned = [s.filter(f"lower_at = {r}").count() for r, s in enumerate(states)]
    assert scanned[0] == 3000 and scanned[-1] < 1500
    own, others = C.displacements(history)
    for t, then in enumerate(history):
        assert np.allclose(own[t], np.linalg.norm(history[-1] - then, axis=1))
    steps = [np.linalg.norm(b - a, axis=1) for a, b in zip(history, history[1:], strict=False)]
    assert (own[0] <= sum(steps) + 1e-9).all() and (own[0] < sum(steps) - 1e-9).any()
    assert (others[:, 0] == own[:, 1:].max(1)).all()
