import numpy as np

from regiostat.llm.quality import (
    BUCKETS,
    GRAMS,
    distinct_buckets,
    dual_coordinate_descent,
    good_documents,
    log_count_ratios,
    logistic_curve,
    quality_scores,
)


def test_buckets_are_those_of_all_grams(monkeypatch):
    mark = np.zeros(BUCKETS, np.int32)
    texts = [b"some text, some more text", b"", b"a", b"\xc3\xa9\xc3\xa9 and others"]
    together = [set(b.tolist()) for b in distinct_buckets(texts, mark)]
    alone = [set(next(distinct_buckets([t], mark)).tolist()) for t in texts]
    assert together == alone
    assert [len(s) for s in alone] == [
        len({(n, t[k : k + n]) for n in GRAMS for k in range(len(t) - n + 1)}) for t in texts
    ]
    monkeypatch.setattr("regiostat.llm.quality.PIECE", 5)
    assert set(next(distinct_buckets(texts[:1], mark)).tolist()) == alone[0]


def test_dual_coordinate_descent_reaches_the_optimum():
    draw = np.random.default_rng(4)
    rows = [np.unique(draw.integers(0, 30, 8)).astype(np.int32) for _ in range(120)]
    labels = np.array([int((r < 12).sum() > (r >= 18).sum()) for r in rows])
    ratio = draw.normal(size=30).astype(np.float32)
    w, bias = dual_coordinate_descent(rows, labels, ratio, 1.0, 400)
    x = np.zeros((120, 31))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r] / np.sqrt(np.square(ratio[r]).sum())
    x[:, 30] = 1
    y = np.where(labels > 0, 1, -1)

    def loss(v):
        return v @ v / 2 + np.maximum(0, 1 - y * (x @ v)).sum()

    # Subgradient steps from zero come no lower.
    v, least = np.zeros(31), np.inf
    for step in range(1, 6000):
        v -= (v - x.T @ (y * (y * (x @ v) < 1))) / (step + 10)
        least = min(least, loss(v))
    assert loss(np.append(w, bias)) <= least * 1.005


def test_ratios_and_curve():
    ratio = log_count_ratios(np.array([9.0, 0.0]), np.array([0.0, 9.0]))
    assert ratio[0] == -ratio[1] > 2
    margins = np.linspace(-2, 2, 400)
    labels = (np.random.default_rng(1).random(400) < 1 / (1 + np.exp(-3 * margins - 1))).astype(int)
    slope, shift = logistic_curve(margins, labels)
    assert abs(slope - 3) < 0.8 and abs(shift - 1) < 0.5


def labelled_corpus(spark, documents):
    draw = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(600):
        words = [str(w) for w in draw.choice(["tree", "house", "river", "cloud", "stone"], 12)]
        good = k % 3 > 0
        rows.append((k, " ".join(words) if good else "!! ".join(words).upper(), "en", "a"))
        labels.append((k, int(good), None, "clash"))
    labels += [(None, 1, 0, ""), (5, None, 1, ""), (6, 7, 0, ""), (10_000, 1, 0, "")]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_held_out_rows_are_told_apart(spark, documents, awkward):
    rows, labels = labelled_corpus(spark, documents)
    found = {r["doc_id"]: r for r in quality_scores(rows, labels).collect()}
    held = [r for r in found.values() if r["held_out"]]
    assert len(found) == 600 and 60 < len(held) < 180
    assert all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found.values())
    odd = quality_scores(awkward, labels).collect()
    assert len(odd) == awkward.count() and all(r["score"] is not None for r in odd)
    kept = good_documents(rows, labels)
    assert kept.columns == rows.columns and 380 < kept.count() < 420


def test_learns_nothing_from_held_out_labels(spark, documents):
    rows, labels = labelled_corpus(spark, documents)
    turned = labels.selectExpr(
        "doc_id", "IF(pmod(crc32(CAST(doc_id AS STRING)), 5) = 0, 1 - quality, quality) AS quality"
    )
    one = {r["doc_id"]: r["score"] for r in quality_scores(rows, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in quality_scores(rows, turned).collect()}
    assert one == two


def test_empty_tables(spark, none, awkward):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_scores(none, empty).collect() == []
    found = quality_scores(awkward, empty).collect()
    assert {r["score"] for r in found} == {0.5}
