"""Sketches against plain Python hashing, pairs of neighbours with ties, estimates against true containment."""

import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F
from support import SMALL

from regiostat.llm import fingerprints as P
from regiostat.llm import ordering

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def chain(words):
    """The engine's hash of several values: each is hashed with the hash so far as its seed."""
    seed = 42
    for w in words:
        seed = xxhash.xxh64(w.encode(), seed=seed).intdigest()
    return seed


def shingles(text, words=5):
    listed = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    if not listed:
        return set(), chain([])
    if len(listed) < words:
        return {chain(listed)}, chain(listed)
    return {chain(listed[i : i + words]) for i in range(len(listed) - words + 1)}, chain(listed)


def sketch(text, scale=4):
    every, whole = shingles(text)
    return sorted(h for h in every if h < (1 << 64) // scale), whole


def shown(text):
    kept, whole = sketch(text)
    return f"{whole:x}:" + ",".join(f"{h:x}" for h in kept)


def near(a, b):
    (x, p), (y, q) = sketch(a), sketch(b)
    if p == q:
        return 1.0
    least = min(len(x), len(y))
    return len(set(x) & set(y)) / least if least else 0.0


def plain(rows):
    signed = lambda t: (h := xxhash.xxh64((t or "").encode(), seed=42).intdigest()) - (h >> 63 << 64)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])), reverse=True)
    out = []
    for i, (doc, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc, len(text), sha, shown(text), shown(edited), near(text, edited), near(text, following)))
    return sorted(out, key=str)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_awkward_rows_and_an_empty_table(awkward, none):
    assert got(P.fingerprints(awkward)) == plain([tuple(r) for r in awkward.collect()])
    assert got(P.fingerprints(none)) == []


def test_a_single_document_is_its_own_next_one(documents):
    one = documents([(5, "some Words of a text that has more than a few", "en", "a")])
    assert got(P.fingerprints(one)) == plain([tuple(r) for r in one.collect()])
    assert P.fingerprints(one).first()["near_next"] == 1.0


@pytest.mark.parametrize(("rows", "ends"), [(3, 2), (16, 3), (1, 128)])
def test_neighbours_across_blocks_of_any_size(documents, monkeypatch, rows, ends):
    monkeypatch.setattr(ordering, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ordering, "ENDS", ends)
    rng = random.Random(7)
    words = ["a", "B", "cc", "ü", "x1"]
    made = [
        (rng.choice([None, k, k // 3, 50]), " ".join(rng.choices(words, k=rng.randint(0, 30))), "en", "s")
        for k in range(200)
    ]
    made += made[:20]
    table = documents(made)
    assert got(P.fingerprints(table)) == plain([tuple(r) for r in table.collect()])


def test_the_given_table(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert got(P.fingerprints(table)) == plain([tuple(r)[:2] for r in table.select("doc_id", "text").collect()])


def test_equal_texts_have_equal_fingerprints_and_others_differ(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    prints = P.fingerprints(table).join(table.select("doc_id", "text"), "doc_id")
    each = prints.groupBy("text").agg(F.count_distinct("fingerprint").alias("n"))
    assert each.filter("n <> 1").isEmpty()
    assert prints.select("fingerprint").distinct().count() == table.select("text").distinct().count()


def test_estimates_are_near_the_true_containment(documents):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    made = []
    for k in range(30):
        large = [word() for _ in range(4000)]
        small = large[: 40 * k] + [word() for _ in range(1200 - 40 * k)]
        made += [(2 * k + 1, " ".join(small), "en", "a"), (2 * k, " ".join(large), "en", "a")]
    texts = {r[0]: r[1] for r in made}
    for r in P.fingerprints(documents(made)).filter("doc_id % 2 = 1").collect():
        (x, _), (y, _) = shingles(texts[r["doc_id"]]), shingles(texts[r["doc_id"] - 1])
        assert abs(r["near_next"] - len(x & y) / min(len(x), len(y))) < 0.12


def test_sketches_merge(documents):
    docs = documents([(1, "a b c d e f g h i j", "en", "x"), (2, "f g h i j k l m n o", "en", "x"), (3, "q r s t u v", "en", "y")])
    single = P.with_sketch(docs, "text", "t", scale=2)
    merged = {r["source"]: r["t_sketch"] for r in P.merged(single, "t_sketch", "source").collect()}
    for source in ("x", "y"):
        parts = [set(r["t_sketch"]) for r in single.filter(F.col("source") == source).collect()]
        assert merged.get(source, []) == sorted(set().union(*parts))
