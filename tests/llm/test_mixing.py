import random
import re

import numpy as np
import pytest

from regiostat.llm.mixing import flight, landing, mixed, mixture, source_targets, word_count


def water_filled(sizes, weights, share, most):
    """Targets by sharing what stops at its limit again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        each = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += each * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("seed", range(3))
def test_targets_equal_repeated_sharing(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{k:02}é"[: 3 + k % 2]: draw.choice([0, 1, 7, 50, 900, 20_000]) for k in range(14)}
    sizes[None] = 333
    rows = [(s, v) for s, v in sizes.items()] + [(next(iter(sizes)), 0)]
    found = source_targets(spark.createDataFrame(rows, "source string, size long")).collect()
    wanted = water_filled(sizes, (5, 2, 1), 1.5, 2)
    assert {r["source"]: r["target"] for r in found} == pytest.approx(wanted)


def test_flight_keeps_both_totals():
    draw = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 700):
        size = draw.integers(0, 500, n)
        p = np.full(n, 0.37)
        moved = flight(p, size, draw.integers(-(2**62), 2**62, n), 0)
        open_ = (moved > 1e-9) & (moved < 1 - 1e-9)
        assert open_.sum() <= 2
        assert moved.sum() == pytest.approx(p.sum()) and moved @ size == pytest.approx(p @ size)
        assert ((moved >= 0) & (moved <= 1)).all()
        landed = landing(moved, size)
        assert set(landed.tolist()) <= {0.0, 1.0}


def test_flight_keeps_probabilities():
    size = np.array([3, 8, 8, 1, 20, 5, 9, 2])
    ties = np.random.default_rng(2).integers(-(2**62), 2**62, (4000, len(size)))
    mean = np.mean([landing(flight(np.full(8, 0.5), size, t, 0), size) for t in ties], axis=0)
    assert mean == pytest.approx(0.5, abs=0.08)


def test_word_count(spark):
    texts = ["a b", None, "", " \t a\x0bb\x0cc\r\nd ", "a\xa0b \x1c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = [r[0] for r in rows.orderBy("id").select(word_count("text")).collect()]
    assert found == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def corpus(documents):
    draw = random.Random(9)
    return documents(
        [
            (k, " ".join(["w"] * draw.randint(0, 60)), "en", draw.choice(["a", "b", "c", "d", None]))
            for k in range(3000)
        ]
    )


def test_words_come_near_the_targets(documents):
    found = mixture(corpus(documents), block_rows=64).collect()
    assert len(found) == 3000
    taken, target, sizes = {}, {}, {}
    for r in found:
        key = r["source_size"]
        taken[key] = taken.get(key, 0) + r["taken"]
        sizes[key] = sizes.get(key, 0) + r["size"]
        target[key] = r["target"]
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 2 * r["size"]
    for key, wanted in target.items():
        assert sizes[key] == key and abs(taken[key] - wanted) <= 60


def test_reruns_agree_and_copies_take_effect(documents):
    rows = corpus(documents)
    one = sorted((r["doc_id"], r["taken"]) for r in mixture(rows, block_rows=100).collect())
    two = sorted((r["doc_id"], r["taken"]) for r in mixture(rows.repartition(7), block_rows=100).collect())
    assert one == two
    out = mixed(rows, block_rows=100)
    assert out.columns == rows.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    words = {r["doc_id"]: len((r["text"] or "").split()) for r in rows.collect()}
    for doc_id, taken in one:
        if words[doc_id]:
            assert counts.get(doc_id, 0) * words[doc_id] == taken


def test_awkward_rows(awkward):
    found = mixture(awkward).collect()
    assert len(found) == awkward.count()
    assert all(r["taken"] == 0 for r in found if r["size"] == 0)
    assert mixed(awkward).columns == awkward.columns


def test_empty_table(none):
    assert mixture(none).collect() == [] and mixed(none).collect() == []


def test_columns_of_any_name_stay_as_they_are(spark):
    names = ["mix_copies", "mix_tie", "mix_copy", "copies", "tie", "row", "copy", "size"]
    rows = [(k, "w " * (k % 9), f"s{k % 4}", *[f"{n}{k}" for n in names]) for k in range(60)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names)
    table = spark.createDataFrame(rows, schema)
    got = mixed(table)
    assert got.columns == table.columns
    assert set(map(tuple, got.collect())) <= set(map(tuple, table.collect()))
    assert mixed(table.limit(0)).collect() == []
