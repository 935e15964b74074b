import random
import re

from regiostat.llm.licenses import LEAST_DICE, TEMPLATES, license_matches


def bigram_set(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
    return set(zip(words, words[1:], strict=False))


def test_finds_planted_licences(documents):
    draw = random.Random(3)
    filler = lambda n: " ".join(draw.choice(["of", "the", "this", "work", "under", "tree"]) for _ in range(n))
    rows = []
    for k, (_, text) in enumerate(TEMPLATES):
        words = text.split()
        if len(words) > 30:
            words[draw.randrange(5, 25)] = "changed"
        rows.append((k, f"{filler(40)}.\n{' '.join(words).upper()}\n{filler(30)}"))
        rows.append((100 + k, filler(200)))
    found = {}
    for r in license_matches(documents(rows)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    texts = dict(rows)
    for k, (name, _) in enumerate(TEMPLATES):
        assert name in [r["license"] for r in found[k]], (k, name)
    assert not any(k in found for k in range(100, 100 + len(TEMPLATES)))
    for k, matches in found.items():
        for r in matches:
            part = texts[k].encode()[r["start_byte"] : r["end_byte"]].decode()
            a, b = bigram_set(part), bigram_set(TEMPLATES[r["template"]][1])
            assert abs(2 * len(a & b) / (len(a) + len(b)) - r["dice"]) < 1e-9 and r["dice"] >= LEAST_DICE


def test_no_stretch_is_missed():
    """Against all stretches of small texts."""
    from regiostat.llm.licenses import Templates, bigrams

    import numpy as np

    draw = random.Random(5)
    words = list("abcdef")
    for _ in range(60):
        texts = [" ".join(draw.choice(words) for _ in range(draw.randint(3, 8))) for _ in range(3)]
        known = Templates(texts, 0.8)
        text = " ".join(draw.choice(words) for _ in range(40))
        grams, _, _ = bigrams(text.encode())
        best = {}
        tokens = text.split()
        for t, template in enumerate(texts):
            b = bigram_set(template)
            for i in range(len(tokens)):
                for j in range(i + 1, len(tokens)):
                    a = bigram_set(" ".join(tokens[i : j + 1]))
                    dice = 2 * len(a & b) / (len(a) + len(b)) if b else 0
                    if dice >= 0.8 - 1e-12:
                        best[t] = max(best.get(t, 0), dice)
        found = known.find(grams, np.zeros(len(grams), np.int64))
        top = max(best.values(), default=None)
        assert (max((d for _, d, _, _ in found), default=None)) == top


def test_awkward_rows(awkward, documents, none):
    more = documents([(30, "Released under the MIT License."), (None, "licensed UNDER cc-by-nc 4.0")])
    found = license_matches(awkward.union(more)).collect()
    assert sorted((str(r["doc_id"]), r["license"]) for r in found) == [("30", "MIT"), ("None", "CC-BY-NC-4.0")]
    assert license_matches(none).collect() == []


def test_siblings_are_told_apart(documents):
    gnu = (
        "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published "
        "by the Free Software Foundation; either version {} of the License, or (at your option) any later version."
    )
    commons = "This work is licensed under a Creative Commons {} International License."
    cases = [
        (gnu.format("program", "Affero General Public License", "3"), ["AGPL-3.0-or-later"]),
        (gnu.format("program", "Affero General Public License", "4"), []),
        (gnu.format("library", "Lesser General Public License", "2.1"), ["LGPL-2.1-or-later"]),
        (gnu.format("library", "Library General Public License", "2"), ["LGPL-2.0-or-later"]),
        (gnu.format("program", "General Public License", "1"), ["GPL-1.0-or-later"]),
        ("The work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3 or later.", ["GPL-3.0-or-later"]),
        ("This work is licensed under the GNU General Public License, version 4.", []),
        (commons.format("Attribution-ShareAlike 4.0"), ["CC-BY-SA-4.0"]),
        (commons.format("Attribution-NoDerivatives 4.0"), ["CC-BY-ND-4.0"]),
        (commons.format("Attribution-NonCommercial-ShareAlike 4.0"), ["CC-BY-NC-SA-4.0"]),
        (commons.format("Attribution-ShareAlike 5.0"), []),
        ("This file is licensed under a Creative Commons Attribution-NoDerivs 2.5 Generic License.", ["CC-BY-ND-2.5"]),
    ]
    rows = [(k, f"Some words before. {text}\nAnd more words after it.") for k, (text, _) in enumerate(cases)]
    found = {k: [] for k in range(len(cases))}
    for r in license_matches(documents(rows)).collect():
        found[r["doc_id"]].append(r["license"])
    assert found == {k: names for k, (_, names) in enumerate(cases)}


def test_a_whole_text_is_one_match(documents):
    texts = {name: text for name, text in TEMPLATES if len(text) > 1400}
    assert {"GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.1", "LGPL-3.0", "BSD-3-Clause", "CC0-1.0", "Apache-2.0"} <= set(texts)
    rows = [(k, f"Title. {text.replace('copyright', 'copy right', 3)} End.") for k, text in enumerate(texts.values())]
    found = license_matches(documents(rows)).collect()
    assert sorted((r["doc_id"], r["license"]) for r in found) == list(enumerate(texts))
