"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

The labelled sample is split by a hash of doc_id into three parts: one gives the lexicon (words and
word beginnings that toxic documents have far more often), one the trees, one the calibration, so that
no part sees features fitted to its own rows. Features are densities of two lexicon tiers, how near
second-person words stand to lexicon words, and rates of capitals, punctuation and obfuscated words.
Trees and calibration are Spark ML models; scores are computed inside Spark.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.llm.common import fold, labelled, staged

#: Labelled documents in the sample, and the parts of ten that lexicon and trees get.
FIT_ROWS = 15_000
LEXICON_PARTS, TREE_PARTS = 4, 4
#: Lexicon entries kept, strongest first; toxic documents that an entry needs.
LEXICON_SIZE = 4000
LEAST_DOCUMENTS = 4
#: Lengths of word beginnings that count as entries besides whole words.
BEGINNINGS = (3, 4, 5, 6, 7)
#: Log ratio of document frequencies from which an entry belongs to the weak and the strong tier.
WEAK, STRONG = 1.5, 3.0
#: Words on either side of a lexicon word in which a second-person word counts as near.
NEAR = 6
#: Words whose tier a Python worker keeps; beyond that it starts anew.
WORDS_KEPT = 300_000
TREES, DEPTH = 25, 4
THRESHOLD = 0.3

# Second-person words of the languages that occur.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)

FEATURES = (
    "strong_density", "weak_density", "strong_count", "near_second_person", "second_person_density",
    "capitals", "shouted_words", "punctuation", "exclamations", "symbols", "digits", "obfuscated",
    "log_words", "word_length",
)

WORD = re.compile(r"[^\W\d_]+")
OBFUSCATED = re.compile(r"[^\W\d_][*@$#!|0-9]+[^\W\d_]")
SHOUTED = re.compile(r"\b[A-Z]{3,}\b")


def entries(word: str) -> list[str]:
    """What a word counts for: itself, and its beginnings, written with a star."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def _entry_counts(rows: DataFrame) -> DataFrame:
    """(entry, toxic, clean): sampled documents of each class with the entry, counted per task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = set(WORD.findall(text.lower())) if isinstance(text, str) else set()
                counts[label].update({e for w in words for e in entries(w)})
        seen = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame(
            {"entry": pd.Series(seen, dtype=object), "toxic": [counts[1][e] for e in seen], "clean": [counts[0][e] for e in seen]}
        )

    counted = rows.select("text", "label").mapInPandas(run, "entry string, toxic long, clean long")
    return counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(rows: DataFrame) -> dict[str, int]:
    """Entry -> tier, 1 weak or 2 strong, from labelled texts; at most ``LEXICON_SIZE`` entries."""
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {}
    ratio = F.log(
        ((F.col("toxic") + 0.5) / (toxic + 1.0)) / ((F.col("clean") + 0.5) / (clean + 1.0))
    )
    best = (
        _entry_counts(rows)
        .filter(F.col("toxic") >= LEAST_DOCUMENTS)
        .withColumn("ratio", ratio)
        .filter(F.col("ratio") >= WEAK)
        .orderBy(F.desc(F.col("ratio") * F.log("toxic")), "entry")
        .limit(LEXICON_SIZE)
        .collect()
    )
    return {r["entry"]: 2 if r["ratio"] >= STRONG else 1 for r in best}


class Extractor:
    """Dense features of one text after another, with a memory for words seen before."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.tiers: dict[str, int] = {}

    def tier(self, word: str) -> int:
        found = self.tiers.get(word)
        if found is None:
            if len(self.tiers) >= WORDS_KEPT:
                self.tiers.clear()
            get = self.lexicon.get
            found = self.tiers[word] = max(get(e, 0) for e in entries(word))
        return found

    def __call__(self, text: str | None) -> list[float]:
        text = text if isinstance(text, str) else ""
        words = WORD.findall(text.lower())
        tiers = list(map(self.tier, words))
        strong, weak = tiers.count(2), tiers.count(1)
        second = [k for k, w in enumerate(words) if w in SECOND_PERSON]
        near = 0
        if strong and second:
            hits = np.flatnonzero(np.array(tiers) == 2)
            left = np.searchsorted(second, hits - NEAR)
            near = int((np.searchsorted(second, hits + NEAR, side="right") > left).sum())
        data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
        capitals, small = int(data[65:91].sum()), int(data[97:123].sum())
        size, n = max(1, int(data.sum())), max(1, len(words))
        marks = int(data[33:48].sum() + data[58:65].sum() + data[91:97].sum() + data[123:127].sum())
        letters = sum(map(len, words))
        return [
            strong / n,
            weak / n,
            math.log1p(strong),
            near / max(1, strong),
            len(second) / n,
            capitals / max(1, capitals + small),
            len(SHOUTED.findall(text)) / n,
            marks / size,
            int(data[33]) / size,
            int(data[35:39].sum() + data[42] + data[124]) / size,
            int(data[48:58].sum()) / size,
            len(OBFUSCATED.findall(text)) / n,
            math.log1p(len(words)),
            letters / n,
        ]


def feature_column(documents: DataFrame, lexicon: dict[str, int]) -> Column:
    """The dense features of each text as a vector; NULL counts as empty."""
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def features(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        extract = Extractor(shared.value)
        for column in columns:
            yield pd.Series([extract(text) for text in column], dtype=object)

    return array_to_vector(features(F.col("text")))


@dataclass
class Model:
    """Lexicon, trees and calibration; without two classes to learn from only a share."""

    lexicon: dict[str, int]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float

    def scored(self, documents: DataFrame) -> DataFrame:
        """``documents`` with a column ``score``."""
        if self.trees is None or self.calibration is None:
            return documents.withColumn("score", F.lit(self.share))
        rows = documents.withColumn("features", feature_column(documents, self.lexicon))
        raw = self.trees.transform(rows).withColumn("raw", _raw())
        found = self.calibration.transform(raw).withColumn("score", F.col("calibrated"))
        return found.select(*documents.columns, "score")


def _raw() -> Column:
    return vector_to_array(F.col("probability"))[1]


def fit(documents: DataFrame, labels: DataFrame, label: str, learnable: Column) -> Model:
    """Learns from the ``FIT_ROWS`` learnable labelled documents with the smallest hash of doc_id."""
    tie = F.xxhash64("doc_id")
    wanted = labels.filter(learnable & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    wanted = wanted.select("doc_id").distinct().withColumn("tie", tie).orderBy("tie").limit(FIT_ROWS)
    sample = labelled(documents, labels, label, learnable).join(F.broadcast(wanted), "doc_id")
    sample = staged(sample.withColumn("part", F.pmod("tie", F.lit(10))), "toxicity-sample")
    share = sample.agg((F.sum("label") + 1) / (F.count("*") + 2)).first()[0]
    lexicon = learn_lexicon(sample.filter(F.col("part") < LEXICON_PARTS))
    rest = staged(
        sample.filter(F.col("part") >= LEXICON_PARTS).select(
            "part", F.col("label").cast("double").alias("label"), feature_column(sample, lexicon).alias("features")
        ),
        "toxicity-features",
    )
    for_trees = rest.filter(F.col("part") < LEXICON_PARTS + TREE_PARTS).coalesce(2)
    for_curve = rest.filter(F.col("part") >= LEXICON_PARTS + TREE_PARTS)
    classes = [{r[0] for r in x.select("label").distinct().collect()} for x in (for_trees, for_curve)]
    if any(len(c) < 2 for c in classes):
        return Model(lexicon, None, None, 0.5 if share is None else float(share))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(for_trees)
    raw = trees.transform(for_curve).withColumn("raw", _raw())
    curve = IsotonicRegression(featuresCol="raw", predictionCol="calibrated").fit(raw)
    return Model(lexicon, trees, curve, float(share))


def toxicity_scores(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    Labels are learned only from rows whose crc32(doc_id) modulo 4 is not 2; ``held_out`` marks the
    others. NULL and empty texts get the score of a text without words. A NULL doc_id is not held out
    and never learned from. Only doc_id and text are read. If a class is missing, every score is the
    share of label 1. An empty table gives an empty result.
    """
    model = fit(documents, labels, label, fold("doc_id", 4) != 2)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "text",
    )
    return model.scored(rows).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
