import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regiostat.llm.token_counts import WordCounts, spliced_count, token_counts, tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    plain = Tokenizer.from_file(PATH)
    return lambda text: len(plain.encode(text, add_special_tokens=False))


def random_text(draw, pieces, length):
    return "".join(draw.choice(pieces) for _ in range(draw.randint(0, length)))


@pytest.mark.parametrize(
    "pieces",
    [
        ["a", "b", " ", "'"],
        ["a", "  ", "\n", "\t", " "],
        ["'l", "re", "'ve", " ", "ds"],
        ["<|endoftext|>", "<|endof", "text|>", " ", "x"],
        ["é", " 1", "2 ", "ñ.", "中", "\xa0", " ", "\x1c"],
        ["x"],
    ],
)
def test_splicing_equals_one_piece(library, pieces):
    draw = random.Random(repr(pieces))
    tok = tokenizer(PATH)
    for _ in range(40):
        text = random_text(draw, pieces, 1200)
        for chunk, overlap in ((128, 70), (256, 100), (200, 80)):
            assert spliced_count(tok, text, chunk, overlap) == library(text)


def test_long_words_widen_the_overlap(library):
    text = "z" * 5000 + " word" + " " * 3000 + "y" * 2500
    assert spliced_count(tokenizer(PATH), text, 256, 100) == library(text)


def test_word_counts_equal_the_library(library):
    draw = random.Random(5)
    pieces = ["'", " ", "  ", "\n", "a", "é", "x²", "12", "-", "re", "'ll", "\xa0", "中", "<|", "\x1c", "Ǝ"]
    texts = [random_text(draw, pieces, 30) for _ in range(2000)] + ["<|endoftext|>", ""]
    assert WordCounts(tokenizer(PATH))(texts) == [library(t) for t in texts]


def test_awkward_rows(awkward, library):
    found = [tuple(r) for r in token_counts(awkward, PATH).collect()]
    wanted = []
    for row in awkward.collect():
        text = row["text"] or ""
        wanted.append((row["doc_id"], len(text.encode()), library(text), library(text) > 1024))
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_empty_table(none):
    assert token_counts(none, PATH).collect() == []
