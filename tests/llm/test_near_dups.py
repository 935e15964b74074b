import random
import re

import pytest

from regiostat.llm.near_dups import (
    components,
    half_keys_for,
    near_duplicates,
    one_of_each,
    open_tables,
)


def shingles(text, words):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
    if 0 < len(lower) < words:
        return {tuple(lower)}
    return {tuple(lower[k : k + words]) for k in range(len(lower) - words + 1)}


def brute_force(rows, words, percent):
    """doc_id -> (set size, component) by all pairs."""
    sets = {i: shingles(t, words) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    label[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.fixture(scope="module")
def corpus():
    """Chains of edits, groups around a missing original, a passage that many share."""
    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda n: [draw.choice(vocabulary) for _ in range(n)]
    rows, passage = [], text(30)
    for _ in range(6):
        base = text(draw.randint(20, 120))
        for _ in range(8):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            rows.append(" ".join(copy))
        chain = list(base)
        for k in range(6):
            chain[(k * 7) % len(chain)] = draw.choice(vocabulary)
            rows.append(" ".join(chain).upper())
    rows += [" ".join(passage + text(60)) for _ in range(25)]
    rows += [" ".join(text(40)) for _ in range(25)]
    rows += ["a b", "A B", "a b c", "", " \t", rows[0]]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words", [4, 5])
def test_equals_all_pairs(documents, corpus, words):
    found = near_duplicates(documents(corpus), words, 80).collect()
    wanted = brute_force(corpus, words, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_small_blocks_lose_no_link(documents, corpus, monkeypatch):
    monkeypatch.setattr("regiostat.llm.near_dups.BLOCK", 4)
    monkeypatch.setattr("regiostat.llm.near_dups.TABLE_BLOCK", 4)
    monkeypatch.setattr("regiostat.llm.near_dups.GROUP_ROWS", 30)
    found = near_duplicates(documents(corpus), 4, 60).collect()
    wanted = brute_force(corpus, 4, 60)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == wanted


def test_awkward_rows(awkward):
    found = sorted(map(tuple, near_duplicates(awkward, 4, 80).collect()), key=str)
    by_id = {}
    for row in found:
        by_id.setdefault(row[0], []).append(row[1:])
    assert by_id[0] == [(5, 0, True)] and by_id[1] == [(5, 0, False)]
    assert by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)] and by_id[5] == [(0, 5, True)]
    assert by_id[4] == [(6, 4, True)] * 2
    assert by_id[7] == [(1, 7, True), (3, 7, True)]
    assert by_id[None] == [(None, None, True)] * 2
    assert len(found) == awkward.count()


def test_one_of_each_keeps_all_columns(awkward):
    kept = one_of_each(awkward, 4)
    assert kept.columns == awkward.columns
    assert kept.count() == awkward.count() - 1
    assert kept.filter("doc_id = 1").count() == 0


def test_ids_that_repeat_with_other_texts_connect(documents):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = documents([(1, a), (5, a), (5, b), (3, b), (9, "x y z x y z")])
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(rows, 4).collect()}
    assert found == {1: 1, 5: 1, 3: 1, 9: 9}


def test_empty_table(none):
    assert near_duplicates(none).collect() == []


def test_components_of_long_chains(spark):
    pairs = [(k, k + 1) for k in range(1, 60)] + [(100, 200), (200, 150)]
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {
        **dict.fromkeys(range(1, 61), 1),
        100: 100,
        150: 100,
        200: 100,
    }


def test_half_keys_follow_the_least_similarity(documents):
    assert (half_keys_for(80), half_keys_for(60), half_keys_for(50)) == (12, 28, 43)
    assert half_keys_for(100) == 1
    with pytest.raises(ValueError, match="50 to 100"):
        near_duplicates(documents([]), percent=49)


def test_links_at_half_are_found(documents):
    draw = random.Random(8)
    rows = []
    for k in range(0, 400, 2):
        words = [f"w{draw.randrange(10**9)}" for _ in range(43)]
        # 40 shingles, the last 13 or fewer of them in one text only: similarity 27 / 53 and above.
        kept = draw.randint(30, 32)
        rows.append((k, " ".join(words)))
        rows.append((k + 1, " ".join(words[:kept] + [f"v{draw.randrange(10**9)}" for _ in range(43 - kept)])))
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(documents(rows), 4, 50).collect()}
    assert found == {i: c for i, (_, c) in brute_force(rows, 4, 50).items()}
    assert len(set(found.values())) == 200


def test_tables_with_the_same_strangers_are_put_together(spark):
    """Classes 1 to 20 have pivot 1, 50 and 51 their own; 50 meets them in ten tables, 51 in one more."""
    keyed = [(n, key) for key in range(10) for n in (*range(1, 21), 50)]
    keyed += [(n, 10) for n in (1, 2, 51)] + [(n, 11) for n in range(1, 21)]
    homes = [(n, 1) for n in range(1, 21)] + [(50, 50), (51, 51)]
    found = open_tables(
        spark.createDataFrame(keyed, "node long, key long"),
        spark.createDataFrame(homes, "node long, home long"),
        spark.createDataFrame([(n, 1) for n in range(1, 11)], "node long, component long"),
    ).collect()
    crowds = {}
    for r in found:
        crowds.setdefault(r["crowd"], []).append(r["node"])
    assert sorted(map(sorted, crowds.values())) == [[1, 2, *range(3, 21), 50], [1, 2, 51]]
