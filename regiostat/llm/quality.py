"""Quality classifier: naive Bayes support vectors over hashed character n-grams.

A text's features are the indicators of its byte 2-, 3- and 4-grams, hashed to ``BUCKETS``. Each
indicator is scaled by its class log-count ratio, counted over all learnable documents; the scaled
vector has length 1. A linear hinge-loss model is fitted to a bounded sample by dual coordinate
descent, and a logistic curve on other rows of the sample turns its margin into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.llm.common import fold, labelled, slices, staged

BUCKETS = 1 << 17
GRAMS = (2, 3, 4)
#: Labelled documents in the sample that the margin is fitted to; a fourth of it sets the curve.
FIT_ROWS = 6000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20
THRESHOLD = 0.3
#: A longer text is read in pieces of so many bytes.
PIECE = 1 << 20

FEATURES = T.StructType(
    [T.StructField("label", T.IntegerType()), T.StructField("tie", T.LongType()), T.StructField("buckets", T.BinaryType())]
)


def _grams(data: np.ndarray) -> list[np.ndarray]:
    """Bucket of the n-gram that starts at each byte, for every n."""
    found = []
    for n in GRAMS:
        size = max(0, len(data) - n + 1)
        key = np.full(size, n, np.uint32)
        for k in range(n):
            key = key * np.uint32(0x01000193) + data[k : k + size]
        key = (key ^ (key >> np.uint32(15))) * np.uint32(0x9E3779B1)
        found.append(key >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return found


def distinct_buckets(texts: list[bytes], mark: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct buckets of each text; ``mark`` is scratch space of ``BUCKETS`` numbers."""
    if len(texts) == 1 and len(texts[0]) > PIECE:
        seen = np.zeros(BUCKETS, bool)
        last = max(GRAMS) - 1
        for a in range(0, len(texts[0]), PIECE):
            piece = np.frombuffer(texts[0][a : a + PIECE + last], np.uint8)
            for gram in _grams(piece):
                seen[gram] = True
        yield np.flatnonzero(seen).astype(np.int32)
        return
    grams = _grams(np.frombuffer(b"".join(texts), np.uint8))
    a = 0
    for text in texts:
        b = a + len(text)
        buckets = np.concatenate([g[a : max(a, b - n + 1)] for n, g in zip(GRAMS, grams, strict=True)])
        place = np.arange(len(buckets), dtype=np.int32)
        mark[buckets] = place
        yield buckets[mark[buckets] == place].astype(np.int32)
        a = b


@dataclass
class Model:
    """Scale and weight of each bucket, the bias, and the curve from margin to score."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, buckets: np.ndarray) -> float:
        scale = float(np.square(self.ratio[buckets]).sum()) ** 0.5
        return float(self.weight[buckets].sum()) / scale + self.bias if scale else self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _class_counts(rows: DataFrame) -> DataFrame:
    """(bucket, good, bad): documents of each class that have the bucket, counted per task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, BUCKETS + 1), np.int64)
        mark = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            labels = batch["label"].to_numpy()
            for first, texts in slices(batch["text"]):
                for k, buckets in enumerate(distinct_buckets(texts, mark), first):
                    totals[labels[k], buckets] += 1
                    totals[labels[k], BUCKETS] += 1
        used = np.flatnonzero(totals.sum(axis=0))
        yield pd.DataFrame({"bucket": used, "good": totals[1, used], "bad": totals[0, used]})

    counted = rows.select("text", "label").mapInPandas(run, "bucket int, good long, bad long")
    return counted.groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))


def _sample_features(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark = np.zeros(BUCKETS, np.int32)
        for batch in batches:
            labels, ties = batch["label"].to_numpy(), batch["tie"].to_numpy()
            for first, texts in slices(batch["text"]):
                found = [np.sort(b).tobytes() for b in distinct_buckets(texts, mark)]
                part = slice(first, first + len(found))
                yield pd.DataFrame({"label": labels[part], "tie": ties[part], "buckets": found})

    return rows.select("text", "label", "tie").mapInPandas(run, FEATURES)


def log_count_ratios(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """log of a bucket's share among the counts of good over that among bad documents."""
    p, q = good + SMOOTHING, bad + SMOOTHING
    return np.log((p / p.sum()) / (q / q.sum())).astype(np.float32)


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + cost * hinge losses, one dual variable at a time.

    A row is the scaled indicators of its buckets, with length 1, and a constant 1 for the bias.
    """
    scale = np.array([max(1e-12, float(np.square(ratio[r]).sum()) ** 0.5) for r in rows])
    y = np.where(labels > 0, 1.0, -1.0)
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(rows)):
            buckets = rows[i]
            values = ratio[buckets] / scale[i]
            slope = y[i] * (float(w[buckets] @ values) + bias) - 1
            length = 2.0 if len(buckets) else 1.0
            new = min(max(alpha[i] - slope / length, 0.0), cost)
            change = (new - alpha[i]) * y[i]
            if change:
                w[buckets] += change * values
                bias += change
                worst = max(worst, abs(change))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(label 1) = 1 / (1 + exp(-slope * margin - shift)), by Newton steps."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    aim = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (aim - p))
        theta = theta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit(documents: DataFrame, labels: DataFrame, label: str, learnable: Column) -> Model:
    """Learns from the rows of ``labels`` that ``learnable`` admits.

    The log-count ratios count every such document; margin and curve see ``FIT_ROWS`` of them, those
    with the smallest hash of doc_id. With fewer than two classes the score is the share of label 1.
    """
    rows = labelled(documents, labels, label, learnable)
    counted = _class_counts(rows).collect()
    good, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    totals = [0, 0]
    for bucket, g, b in counted:
        if bucket == BUCKETS:
            totals = [b, g]
        else:
            good[bucket], bad[bucket] = g, b
    ratio = log_count_ratios(good, bad)
    if not min(totals):
        share = (totals[1] + 1) / (sum(totals) + 2)
        return Model(ratio, np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share / (1 - share))))
    tie = F.xxhash64("doc_id")
    wanted = labels.filter(learnable & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    wanted = wanted.select("doc_id", tie.alias("tie")).distinct().orderBy("tie").limit(FIT_ROWS)
    sample = rows.join(F.broadcast(wanted), "doc_id")
    found = staged(_sample_features(sample), "quality-sample").orderBy("tie").collect()
    buckets = [np.frombuffer(r["buckets"], np.int32) for r in found]
    y = np.array([r["label"] for r in found])
    curve = np.arange(len(found)) % 4 == 3
    train = np.flatnonzero(~curve)
    w, bias = dual_coordinate_descent([buckets[k] for k in train], y[train], ratio, COST, EPOCHS)
    model = Model(ratio, w * ratio, bias, 1.0, 0.0)
    check = np.flatnonzero(curve)
    margins = np.array([model.margin(buckets[k]) for k in check])
    if len(set(y[check].tolist())) == 2:
        model.slope, model.shift = logistic_curve(margins, y[check])
    return model


def score_column(documents: DataFrame, model: Model, text: str = "text") -> Column:
    """Score of each text from 0 to 1; NULL counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mark = np.zeros(BUCKETS, np.int32)
        known = shared.value
        for column in columns:
            margins = [
                known.margin(buckets)
                for _, texts in slices(column)
                for buckets in distinct_buckets(texts, mark)
            ]
            yield pd.Series(known.score(np.array(margins, dtype=float)))

    return score(F.col(text))


def quality_scores(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    Labels are learned only from rows whose crc32(doc_id) modulo 5 is not 0; ``held_out`` marks the
    others. NULL and empty texts get the score of a text without n-grams. A NULL doc_id is not held
    out and never learned from. Only doc_id and text are read. An empty table gives an empty result.
    """
    model = fit(documents, labels, label, fold("doc_id", 5) != 0)
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        score_column(documents, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The rows of ``documents`` that are predicted good, with all their columns, whatever their names.

    NULL and empty texts are judged by the score of a text without n-grams. Repeated rows stay or go together, and so
    do rows without id by their text. An empty table stays empty.
    """
    model = fit(documents, labels, label, fold("doc_id", 5) != 0)
    return documents.filter(score_column(documents, model) >= THRESHOLD)
