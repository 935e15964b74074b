import random

import numpy as np
import pytest

from regiostat.llm.decontaminate import (
    align,
    build_index,
    find,
    leaks,
    normalised,
    places,
    without_leaks,
)

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda sigma omega".split()


def words(draw, n):
    return " ".join(draw.choice(WORDS) + str(draw.randint(0, 99)) for _ in range(n))


def edit_distance_inside(item, text):
    """Least edits that turn ``item`` into some stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, char in enumerate(item, 1):
        before, row = row, [i]
        for j, other in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (char != other)))
    return min(row)


def edited(draw, text, edits):
    chars = list(text)
    for _ in range(edits):
        k, kind = draw.randrange(1, len(chars) - 1), draw.random()
        if kind < 0.34:
            chars[k] = "#"
        elif kind < 0.67:
            chars.insert(k, "+")
        else:
            del chars[k]
    return "".join(chars)


def test_finds_what_brute_force_finds():
    draw = random.Random(8)
    items = [(k, words(draw, draw.randint(5, 25))) for k in range(12)]
    index = build_index(items)
    plain = [normalised(t) for _, t in items]
    texts = []
    for k in range(60):
        inside = edited(draw, plain[k % 12], draw.randint(0, int(len(plain[k % 12]) * 0.13)))
        texts.append(normalised(f"{words(draw, 12)} {inside} {words(draw, 9)}"))
    texts += [normalised(words(draw, 60)) for _ in range(20)] + ["", "x"]
    got = {(k, item): distance for k, item, _, _, distance in find(index, texts)}
    wanted = {}
    for k, text in enumerate(texts):
        for item, plain_item in enumerate(plain):
            least = edit_distance_inside(plain_item, text)
            if least <= index.edits[item]:
                wanted[k, item] = least
    assert got == wanted


def least_edits_inside(item, text):
    """``edit_distance_inside`` for long texts, a row at a time."""
    text = np.array(list(text))
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, int)
    for i, char in enumerate(item, 1):
        new = np.minimum(row + 1, np.append(i, row[:-1] + (text != char)))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


@pytest.mark.parametrize("length, edits", [(1000, 95), (3000, 280), (5000, 400)])
@pytest.mark.parametrize("insert", [True, False])
def test_long_items_with_edits_of_one_kind(length, edits, insert):
    draw = random.Random(length + insert)
    item = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(length))
    chars = list(item)
    # Evenly spread: the q-grams that are left lie on all diagonals in between.
    for k in range(edits, 0, -1):
        at = k * length // (edits + 1)
        chars[at:at] = ["+"] if insert else []
        chars[at : at + 1] = chars[at : at + 1] if insert else []
    text = f"{words(draw, 30)} {''.join(chars)} {words(draw, 30)}"
    index = build_index([(1, item)])
    least = least_edits_inside(item, text)
    assert 0 < least <= index.edits[0]
    assert [(k, i, distance) for k, i, _, _, distance in find(index, [text])] == [(0, 0, least)]


def test_matches_across_windows(monkeypatch):
    monkeypatch.setattr("regiostat.llm.decontaminate.WINDOW", 64)
    draw = random.Random(2)
    item = words(draw, 20)
    index = build_index([(1, item)])
    text = normalised(" ".join([words(draw, 300), item, words(draw, 211), item, words(draw, 5)]))
    found = list(find(index, [text]))
    assert [text[a:b] for _, _, a, b, _ in found] == [item, item]


def test_alignment_is_exact():
    codes = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    assert align(codes("abcdefgh"), codes("xxabcdXfghxx"), 2, 2, 3)[:2] == (1, 2)
    assert align(codes("abcdefgh"), codes("zzzzzzzzzzzz"), 0, 3, 2) is None


def test_places_point_into_the_original():
    text = "  Über\t\nALLES  x "
    at = places(text)
    plain = normalised(text)
    assert plain == "über alles x" and len(at) == len(plain) + 1
    assert [text[k].lower() for k, c in zip(at, plain, strict=False) if c != " "] == [
        c for c in plain if c != " "
    ]


@pytest.fixture
def benchmark(spark):
    rows = [
        (1, "One two three four FIVE six seven eight nine ten"),
        (2, "one two three"),
        (None, "Lorem ipsum dolor sit amet consectetur lorem"),
        (3, None),
        (1, "One two three four FIVE six seven eight nine ten"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_awkward_rows(awkward, documents, benchmark):
    more = documents([(20, "say: one two  three four five\nsix seven eight nine ten, done")])
    found = leaks(awkward.union(more), benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found if r["item_id"]) == [(20, 1), (20, 1)]
    assert {r["doc_id"] for r in found if r["item_id"] is None} == {4}
    row = next(r for r in found if r["item_id"] == 1)
    assert (row["start_char"], row["end_char"], row["distance"]) == (5, 54, 0)
    kept = without_leaks(awkward.union(more), benchmark)
    assert kept.columns == awkward.columns
    assert kept.count() == awkward.count() - 2


def test_benchmark_in_blocks(documents, benchmark, monkeypatch):
    monkeypatch.setattr("regiostat.llm.decontaminate.BLOCK_CHARS", 40)
    more = documents([(20, "one two three four five six seven eight nine ten"), (21, "none")])
    assert [r["doc_id"] for r in leaks(more, benchmark).collect()] == [20, 20]
    assert [r["doc_id"] for r in without_leaks(more, benchmark).collect()] == [21]


def test_empty_tables(none, awkward, benchmark):
    assert leaks(none, benchmark).collect() == []
    assert leaks(awkward, benchmark.limit(0)).collect() == []
    assert without_leaks(awkward, benchmark.limit(0)).count() == awkward.count()


def test_short_items_of_other_scripts(documents, spark):
    items = ["中国的首都是哪一座城市请回答", "日本の首都はどこですか", "대한민국의 수도는 어디인가", "a short item"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents([(k, f"before {item} after") for k, item in enumerate(items)])
    found = leaks(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [(0, 0, 0), (1, 1, 0), (2, 2, 0)]
    assert [r["doc_id"] for r in without_leaks(docs, benchmark).collect()] == [3]


def test_copies_in_close_succession():
    item = "one two three four five six se"
    text = f"{item} {item.replace('three', 'thxee')}, {item} and then some other words"
    found = list(find(build_index([(1, item)]), [text]))
    assert [(start, distance) for _, _, start, _, distance in found] == [(0, 0), (31, 1), (63, 0)]
    assert [text[start:end] for _, _, start, end, _ in found][::2] == [item, item]
