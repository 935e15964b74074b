import itertools

import numpy as np
from pyspark.sql import functions as F

from regiostat.llm.language_id import (
    NO_LETTER,
    WINDOW_WORDS,
    encoded,
    fit,
    label_texts,
    marginals,
    pair_totals,
    predicted_languages,
    surroundings,
    train,
    transfers,
    word_labels,
    words_in_parts,
)

ENGLISH = "the house and tree with river that stone from cloud have been".split()
GERMAN = "das haus und der baum mit fluss dass stein von wolke gewesen".split()


def by_enumeration(scores, transitions):
    n, labels = scores.shape
    single, pairs, total = np.zeros((n, labels)), np.zeros((labels, labels)), 0.0
    for path in itertools.product(range(labels), repeat=n):
        weight = np.exp(
            sum(scores[t, y] for t, y in enumerate(path))
            + sum(transitions[a, b] for a, b in itertools.pairwise(path))
        )
        total += weight
        for t, y in enumerate(path):
            single[t, y] += weight
        for a, b in itertools.pairwise(path):
            pairs[a, b] += weight
    return single / total, pairs / total


def test_forward_backward_equals_enumeration():
    draw = np.random.default_rng(2)
    transitions = draw.normal(size=(3, 3))
    lengths = np.array([4, 0, 1, 6, 4])
    scores = draw.normal(size=(lengths.sum(), 3)) * 2
    ends = np.cumsum(lengths)
    wanted = [by_enumeration(scores[b - n : b], transitions)[0] for b, n in zip(ends, lengths, strict=True)]
    assert np.allclose(marginals(scores, lengths, transitions), np.concatenate(wanted))
    one, two = (by_enumeration(scores[a : a + 3], transitions) for a in (0, 3))
    both, pairs = pair_totals(scores[:6], 3, transitions)
    assert np.allclose(both, np.concatenate([one[0], two[0]]))
    assert np.allclose(pairs, one[1] + two[1])


def windows(draw):
    return [
        (lang, " ".join(draw.choice(words, WINDOW_WORDS)))
        for _ in range(200)
        for lang, words in (("en", ENGLISH), ("de", GERMAN))
    ]


def test_code_switched_words():
    model = train(windows(np.random.default_rng(6)))
    text = "the house with the tree und das haus mit der wolke that have been"
    wanted = ["en"] * 5 + ["de"] * 6 + ["en"] * 3
    found = word_labels(model, text)
    assert [w for w, _ in found] == text.split()
    assert [lang for _, lang in found] == wanted
    assert np.trace(model.transitions) > model.transitions.sum() - np.trace(model.transitions)


def test_texts_in_groups_equal_texts_alone(monkeypatch):
    model = train(windows(np.random.default_rng(6)))
    draw = np.random.default_rng(1)
    texts = [" ".join(draw.choice(GERMAN + ENGLISH, int(n))) for n in draw.integers(0, 90, 60)] + [None, "12"]
    together = label_texts(model, texts)
    monkeypatch.setattr("regiostat.llm.language_id.GROUP_BYTES", 1)
    alone = label_texts(model, texts)
    assert together[0] == alone[0] and np.allclose(together[1], alone[1])


def test_stretches_have_the_probabilities_of_the_whole():
    draw = np.random.default_rng(8)
    transitions, scores = draw.normal(size=(4, 4)) * 2, draw.normal(size=(50, 4)) * 3
    paths = np.concatenate([transfers(scores[:48], 8, transitions), transfers(scores[48:], 2, transitions)])
    enter, leave = surroundings(paths, transitions)
    found = marginals(scores, np.array([8] * 6 + [2]), transitions, enter, leave)
    assert np.allclose(found, marginals(scores, np.array([50]), transitions), atol=1e-12)


def test_long_texts_equal_short_ones(monkeypatch):
    model = train(windows(np.random.default_rng(6)))
    draw = np.random.default_rng(4)
    long = " ".join(" ".join(draw.choice(GERMAN if draw.random() < 0.6 else ENGLISH, 9)) for _ in range(2000))
    texts = ["the house", long + " 12", None, "", "das haus 3", "x" * 3000, "."]
    module = "regiostat.llm.language_id."
    monkeypatch.setattr(module + "LONG_BYTES", 1 << 30)
    whole = label_texts(model, texts)
    monkeypatch.setattr(module + "LONG_BYTES", 100)
    for part, stretch in ((1 << 19, 512), (1000, 7), (50, 512), (997, 1)):
        monkeypatch.setattr(module + "PART_BYTES", part)
        monkeypatch.setattr(module + "STRETCH", stretch)
        found = label_texts(model, texts)
        assert found[0] == whole[0] and np.allclose(found[1], whole[1], rtol=1e-9)
        places = [(a, b) for starts, ends, _ in words_in_parts(model, encoded(long)) for a, b in zip(starts, ends, strict=True)]
        assert [long[a:b] for a, b in places] == long.split()


def test_one_long_text_takes_steps_of_a_stretch(monkeypatch):
    model = train(windows(np.random.default_rng(6)))
    seen = []
    monkeypatch.setattr(
        "regiostat.llm.language_id.marginals",
        lambda scores, lengths, *rest: seen.append((len(scores), lengths.max())) or marginals(scores, lengths, *rest),
    )
    words = 300_000
    assert label_texts(model, ["the haus " * (words // 2)])[0][0] in ("de", "en")
    assert sum(n for n, _ in seen) == words
    assert max(n for n, _ in seen) < 150_000 and max(steps for _, steps in seen) == 512


def test_letters():
    assert encoded("12 !\x00") == b"" and encoded(None) == b"" and encoded("…") == b""
    assert encoded("É") == "é".encode() and encoded("日") != b""
    assert not NO_LETTER[ord("a")] and NO_LETTER[ord("1")]


def test_held_out_documents(documents, awkward):
    draw = np.random.default_rng(9)
    rows = [
        (k, " ".join(draw.choice(GERMAN if k % 2 else ENGLISH, 30)), "de" if k % 2 else "en", "a")
        for k in range(20, 420)
    ]
    rows += [(k, "the haus und that", None, "a") for k in range(500, 510)]
    table = documents(rows).union(awkward)
    found = predicted_languages(table).collect()
    assert len(found) == 410 + awkward.count()
    held = [r for r in found if r["held_out"] and 20 <= r["doc_id"] < 420]
    assert len(held) > 50 and all(r["lang_pred"] == ("de" if r["doc_id"] % 2 else "en") for r in held)
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert {2, 3, 5, 6} <= und and all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    assert all(0 <= r["score"] <= 1 for r in found)


def test_nothing_to_learn_from(none, documents):
    assert predicted_languages(none).collect() == []
    rows = documents([(1, "some text", None, "a"), (2, None, "en", "a")])
    assert [r["lang_pred"] for r in predicted_languages(rows).collect()] == ["und", "und"]
    one = fit(documents([(1, "some text", "xx", "a")]), F.lit(True))
    assert one.labels == ["xx"] and label_texts(one, ["other", "1"]) == (["xx", "und"], [1.0, 0.0])
