import math
import random
import re
import string
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from support import SMALL

from regiostat.llm.common import fold
from regiostat.llm.toxicity import (
    BEGINNINGS,
    FEATURES,
    LEAST_DOCUMENTS,
    LEXICON_PARTS,
    NEAR,
    SECOND_PERSON,
    STRONG,
    TREE_PARTS,
    WEAK,
    Extractor,
    entries,
    fit,
    toxicity_scores,
)


def test_features_of_a_text():
    extract = Extractor({"idiot": 2, "foo*": 1})
    found = dict(zip(FEATURES, extract("You IDIOT, food is b4d!! 12"), strict=True))
    assert found["strong_density"] == 1 / 6 and found["weak_density"] == 1 / 6
    assert found["near_second_person"] == 1 and found["second_person_density"] == 1 / 6
    assert found["capitals"] == 6 / 16 and found["shouted_words"] == 1 / 6
    assert found["obfuscated"] == 1 / 6 and found["exclamations"] == 2 / 27
    assert dict(zip(FEATURES, extract(None), strict=True)) == dict.fromkeys(FEATURES, 0.0)
    assert entries("idiots") == ["idiots", "idi*", "idio*", "idiot*", "idiots*"]


def test_distance_to_second_person_words():
    extract = Extractor({"idiot": 2})
    near = FEATURES.index("near_second_person")
    assert extract("you a b c d e idiot")[near] == 1
    assert extract("you a b c d e f idiot")[near] == 0


def corpus(spark, documents):
    draw = np.random.default_rng(8)
    rows, labels = [], []
    for k in range(900):
        words = [f"{w}" for w in draw.choice(["tree", "house", "river", "you", "cloud", "stone"], 25)]
        toxic = k % 5 == 0
        if toxic:
            for at in draw.integers(0, 25, 3):
                words[at] = str(draw.choice(["moronic", "scumbag", "moron"]))
        rows.append((k, " ".join(words), "en", "a"))
        labels.append((k, None, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None), (6, 1, 9)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(spark, documents, awkward):
    rows, labels = corpus(spark, documents)
    found = toxicity_scores(rows.union(awkward.filter("doc_id > 3 OR doc_id IS NULL")), labels).collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 900 + awkward.count() - 4 and 120 < len(held) < 330
    assert all(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held if r["doc_id"] > 8)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)


def test_empty_tables_and_a_missing_class(spark, none, awkward):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity_scores(none, empty).collect() == []
    assert {r["score"] for r in toxicity_scores(awkward, empty).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    found = toxicity_scores(awkward, one).collect()
    assert len(found) == awkward.count() and all(0 < r["score"] < 1 for r in found)


# --- against plain versions ---------------------------------------------------------------------


def plain_features(lexicon, text):
    """The features by loops over characters and pairs of words."""
    text = text or ""
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        else:
            words += [word] if word else []
            word = ""
    tier = [max([lexicon.get(w, 0), *(lexicon.get(w[:n] + "*", 0) for n in BEGINNINGS if n <= len(w))]) for w in words]
    n, size = max(1, len(words)), max(1, len(text.encode()))
    strong = [k for k, t in enumerate(tier) if t == 2]
    second = [k for k, w in enumerate(words) if w in SECOND_PERSON]
    near = sum(any(abs(k - s) <= NEAR for s in second) for k in strong)
    capitals, small = (sum(a <= c <= z for c in text) for a, z in ("AZ", "az"))
    count = lambda chars: sum(c in chars for c in text)
    return [
        len(strong) / n, tier.count(1) / n, math.log1p(len(strong)), near / max(1, len(strong)), len(second) / n,
        capitals / max(1, capitals + small), len(re.findall(r"\b[A-Z]{3,}\b", text)) / n,
        count(string.punctuation) / size, count("!") / size, count("#$%&*|") / size, count(string.digits) / size,
        len(re.findall(r"[^\W\d_][*@$#!|0-9]+[^\W\d_]", text)) / n, math.log1p(len(words)), sum(map(len, words)) / n,
    ]


def test_features_equal_plain_loops(spark):
    draw = random.Random(2)
    lexicon = {"moron": 2, "scum*": 2, "fool*": 1, "tree": 1}
    parts = ["you", "MORON", "scumbag", "foolish", "tree", "ÉTÉ", "du", "b4d", "ok!!", "a|b", "12", "\n", "日本", "STOP", "it's", "x_y"]
    extract = Extractor(lexicon)
    texts = [" ".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(300)]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(60).collect()]
    for text in [*texts, "", None]:
        assert np.allclose(extract(text), plain_features(lexicon, text), rtol=0, atol=1e-12), text


def walked(debug, weights, x):
    """Sum of the trees at x, by reading the printed trees."""
    total, tree = 0.0, -1
    skip = None
    done = False
    for line in debug.splitlines()[1:]:
        depth, line = len(line) - len(line.lstrip()), line.strip()
        if line.startswith("Tree "):
            tree, skip, done = tree + 1, None, False
        elif done or (skip is not None and depth > skip):
            continue
        elif found := re.match(r"(?:If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)", line):
            value, bound = x[int(found[1])], float(found[3])
            skip = None if (value <= bound) == (found[2] == "<=") else depth
        elif line.startswith("Predict: "):
            total += weights[tree] * float(line.split()[1])
            done = True
    return total


def pooled(points):
    """Isotonic curve through (x, y) points by pooling adjacent violators."""
    blocks = []
    for x in sorted({p[0] for p in points}):
        own = [y for a, y in points if a == x]
        blocks.append([sum(own), len(own), x, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, n, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n, blocks[-1][2], last]
    xs = [x for b in blocks for x in (b[2], b[3])]
    ys = [b[0] / b[1] for b in blocks for _ in range(2)]
    return lambda x: float(np.interp(x, xs, ys))


def test_lexicon_trees_and_curve_equal_plain_versions(spark, documents):
    rows, labels = corpus(spark, documents)
    # Some labels are wrong, so that the curve has violators to pool.
    labels = labels.withColumn("toxic", F.when(F.col("doc_id") % 17 == 3, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    model = fit(rows, labels, "toxic", fold("doc_id", 4) != 2)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(10)).alias("part")
    known = labels.filter((fold("doc_id", 4) != 2) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic", part)
    sample = [(r["text"], r["toxic"], r["part"]) for r in rows.join(known, "doc_id").collect()]

    documents_with, sizes = {0: Counter(), 1: Counter()}, Counter()
    for text, label, p in sample:
        if p < LEXICON_PARTS:
            sizes[label] += 1
            documents_with[label].update({e for w in text.split() for e in entries(w)})
    wanted = {}
    for entry, toxic in documents_with[1].items():
        odds = (toxic + 0.5) / (sizes[1] + 1) / ((documents_with[0][entry] + 0.5) / (sizes[0] + 1))
        if toxic >= LEAST_DOCUMENTS and math.log(odds) >= WEAK:
            wanted[entry] = 2 if math.log(odds) >= STRONG else 1
    assert model.lexicon == wanted and len(wanted) > 5

    extract = Extractor(model.lexicon)
    fitted = [(extract(t), y) for t, y, p in sample if LEXICON_PARTS <= p < LEXICON_PARTS + TREE_PARTS]
    x, y = np.array([f for f, _ in fitted]), np.array([2 * v - 1 for _, v in fitted], float)

    def gain(feature, bound):
        low = x[:, feature] <= bound
        sides = [y[low], y[~low]]
        return y.var() * len(y) - sum(s.var() * len(s) for s in sides if len(s))

    best = max(gain(f, v) for f in range(x.shape[1]) for v in np.unique(x[:, f])[:-1])
    root = re.search(r"If \(feature (\d+) <= ([-\d.eE]+)\)", model.trees.toDebugString)
    assert gain(int(root[1]), float(root[2])) >= 0.99 * best

    debug, weights = model.trees.toDebugString, model.trees.treeWeights
    raw = lambda text: 1 / (1 + math.exp(-2 * walked(debug, weights, extract(text))))
    curve = pooled([(raw(t), v) for t, v, p in sample if p >= LEXICON_PARTS + TREE_PARTS])
    for r in model.scored(rows.select("doc_id", "text").limit(200)).collect():
        assert abs(r["score"] - curve(raw(r["text"]))) < 1e-6
