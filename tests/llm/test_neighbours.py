import math

import numpy as np
import pytest

from regiostat.llm.neighbours import balanced_partitions, learn, nearest, neighbours


def exact(rows, k, every):
    """query -> [(vec_id, distance)] by comparing everything."""
    found = {}
    for q, a in rows:
        if q % every == 0:
            others = sorted((math.dist(a, b), i) for i, b in rows if i != q)[:k]
            found[q] = [(i, d) for d, i in others]
    return found


def clustered(n, seed=1, d=16):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, d))
    x = centres[draw.integers(0, 12, n)] + 0.5 * draw.normal(size=(n, d))
    return x.astype(np.float32).astype(float)


def test_partitions_are_balanced_and_follow_the_graph():
    x = clustered(640)
    graph = nearest(x, x, 8, skip_self=True)
    labels = balanced_partitions(graph, 8)
    sizes = np.bincount(labels)
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 8
    assert (labels[graph] == labels[:, None]).mean() > 0.6


def test_probes_follow_the_target():
    x = clustered(1200)
    router = learn(x[:1000], x[1000:], 10, 16)
    assert 1 <= router.probes < 16


def test_recall(spark):
    x = clustered(6000)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours(table, 10, 100).collect()
    wanted = exact(rows, 10, 100)
    hits = 0
    for r in found:
        hits += r["vec_id"] in {i for i, _ in wanted[r["query_id"]]}
        assert r["score"] == pytest.approx(math.dist(x[r["query_id"]], x[r["vec_id"]]), abs=1e-12)
    assert len(found) == 600 and hits / 600 >= 0.9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.0, 0.0], 1),
        (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [], 1),
        (8, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (9, [1.0, 0.5], 1), (9, [1.0, 0.5], 2),
    ]
    rows += [(k, [1.0, 0.0], 1) for k in range(200, 230)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = {}
    for r in sorted(neighbours(table, 4, 100).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert found[0] == [(1, 100, 0.0), (2, 200, 0.0), (3, 201, 0.0), (4, 202, 0.0)]
    assert found[200] == [(1, 0, 0.0), (2, 100, 0.0), (3, 201, 0.0), (4, 202, 0.0)]
    assert set(found) == {0, 100, 200}


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours(spark.createDataFrame([], schema)).collect() == []
    assert neighbours(spark.createDataFrame([(0, [1.0])], schema)).collect() == []
    two = neighbours(spark.createDataFrame([(0, [1.0]), (1, [3.0])], schema)).collect()
    assert [tuple(r) for r in two] == [(0, 1, 1, 2.0)]
