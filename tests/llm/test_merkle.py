"""Proofs against a tree built in plain Python, with awkward rows; the SQL on the given table."""

import hashlib
import random
import zlib

import pytest
from support import SMALL

from contract.compare import connect, difference
from regiostat.llm.merkle import checked_manifest, height, manifest
from regiostat.llm.oracle import merkle_sql
from regiostat.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place string, n string, hash string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return digest("".join(field(v) for v in (row[0], row[3], row[2], row[4], text)))


def tree(hashes):
    """Top and (left, right) siblings of every hash."""
    paths, row = [[] for _ in hashes], hashes
    places = list(range(len(hashes)))
    while len(row) > 1:
        for i, p in enumerate(places):
            start = p - p % 16
            paths[i].append(("".join(row[start:p]), "".join(row[p + 1 : start + 16])))
            places[i] = p // 16
        row = [digest("".join(row[i : i + 16])) for i in range(0, len(row), 16)]
    return row[0], paths


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows):
    if not rows:
        return []
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    tops, found = [], []
    for name in names:
        own = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        top, paths = tree([leaf(r, r[1]) for r in own])
        tops.append(top)
        found.append(list(zip(own, paths, strict=True)))
    root, upper = tree(tops)
    out = []
    for top, rest, members in zip(tops, upper, found, strict=True):
        for row, path in members:
            steps = path + rest
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            h = leaf(row, lowered(row[1]) if hit else row[1])
            for left, right in steps:
                h = digest(left + h + right)
            proof = digest("".join(left + right for left, right in steps))
            out.append((row[0], leaf(row, row[1]), top, root, proof, h, h == root))
    return sorted(out, key=str)


def some_rows(sizes, seed=1):
    rng = random.Random(seed)
    made = []
    for source, n in sizes:
        for _ in range(n):
            doc = None if rng.random() < 0.05 else len(made)
            text = rng.choice(["Ab c", "Ünï X", None, "", "lower"])
            made.append((doc, text, rng.choice(["en", None]), source, rng.choice([None, 7]), *"abcd"))
    rng.shuffle(made)
    return made


MANY = [("a", 300), ("b", 1), (None, 16), ("é", 17), ("z", 4097)] + [(f"s{k}", k % 3 + 1) for k in range(300)]


@pytest.mark.parametrize("sizes", [[], [("a", 1)], [(None, 1), ("a", 17)], MANY])
def test_every_proof_is_that_of_a_plain_tree(spark, sizes):
    made = some_rows(sizes)
    got = checked_manifest(spark.createDataFrame(made, SCHEMA))
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(made)


def test_repeated_rows_and_very_long_texts(spark):
    long = "Long text " * 200_000
    made = [(k % 4, long if k % 2 else "x", None, "a", None, *"abcd") for k in range(40)]
    got = checked_manifest(spark.createDataFrame(made, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(made)


def test_a_changed_text_does_not_verify_and_a_proof_has_the_height_of_the_tree(spark):
    rows = checked_manifest(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    hit = {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert {r["doc_id"] for r in rows if not r["verified"]} == hit
    assert len({r["root"] for r in rows}) == 1
    made = [(k, "t", None, "a", None, *"abcd") for k in range(257)]
    steps = manifest(spark.createDataFrame(made, SCHEMA)).selectExpr("size(steps) AS n").distinct().collect()
    assert [r["n"] for r in steps] == [3] == [height(257)]


def test_the_sql_gives_the_same(spark):
    assert difference(op11_merkle_manifest(spark, SMALL), connect(SMALL), merkle_sql()) is None
