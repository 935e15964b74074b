"""Token counts of whole texts; huge ones in overlapping chunks that are spliced where both agree.

A byte-level tokenizer first cuts a text into words from left to right and never looks back, so
once two encodings of overlapping chunks start a word at the same place, they agree from there on.
A word end of the left chunk is proven when it lies further from the chunk's end than the rules
look ahead. The first such place that is also a word end of the right chunk is the splice. Where an
overlap holds none (a word longer than the overlap), both the overlap and the chunk are widened, at
worst to the rest of the text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, processors

from regiostat.llm.common import byte_size

#: Characters in a chunk, and in the part that it shares with the next one.
CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 9
#: Characters that the rules of word ends and special strings look ahead, generously.
LOOK_AHEAD = 64
#: Texts encoded in one call hold about so many characters.
BATCH_CHARS = 1 << 18

#: Words whose counts a Python worker keeps; beyond that it starts anew.
WORDS_KEPT = 500_000

# The word rule of byte-level vocabularies, for U+0020-U+024F without controls.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGITS = "0-9²³¹¼-¾"
BLANKS = r"\t-\r "
WORDS = re.compile(
    f" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+"
    f"|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
NOT_LATIN = re.compile(f"[^{BLANKS}-~¡-ɏ]")

_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a vocabulary file, once per Python worker, with exact offsets."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        loaded.post_processor = processors.ByteLevel(trim_offsets=False)
        _loaded[path] = loaded
    return _loaded[path]


def word_ends(encoding, base: int, low: int, high: int) -> dict[int, int]:
    """Word ends from ``low`` to ``high`` -> tokens up to there; ``base`` is the chunk's place."""
    words, offsets = encoding.word_ids, encoding.offsets
    last = len(words) - 1
    return {
        base + offsets[k][1]: k + 1
        for k in range(len(words))
        if low <= base + offsets[k][1] <= high and (k == last or words[k] != words[k + 1])
    }


def spliced_count(
    tok: Tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> int:
    """Number of tokens of one text, chunk by chunk; equal to encoding it in one piece."""

    def encoded(begin: int, size: int):
        return tok.encode(text[begin : begin + size], add_special_tokens=False)

    # The left chunk is text[begin:end]; it counts from the proven word end ``start`` on, and has
    # ``before`` tokens in front of that.
    total, start, begin, before, size, shared = 0, 0, 0, 0, chunk, overlap
    left, end = encoded(0, size), min(size, len(text))
    while end < len(text):
        low = max(start, end - shared)
        if low == start:
            # The overlap is the whole chunk and holds no common word end: a longer chunk from here.
            size *= 2
            begin, before, end, shared = start, 0, min(start + size, len(text)), overlap
            left = encoded(start, size)
            continue
        length = max(chunk, 2 * shared)
        right = encoded(low, length)
        proven = word_ends(left, begin, low, end - LOOK_AHEAD)
        common = {low: 0} | word_ends(right, low, low, end)
        splice = min((p for p in proven if p in common), default=None)
        if splice is None:
            shared *= 4
            continue
        total += proven[splice] - before
        start, begin, before, size, shared = splice, low, common[splice], length, overlap
        left, end = right, min(low + length, len(text))
    return total + len(left) - before


class WordCounts:
    """Token counts of short texts, word by word, with the counts of words seen before kept.

    The tokenizer encodes every word by itself, so a text has as many tokens as its words. The
    word rule is written out here for Latin text only; any other text goes to the library whole.
    """

    def __init__(self, tok: Tokenizer):
        self.tok = tok
        self.seen: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        whole = [k for k, text in enumerate(texts) if NOT_LATIN.search(text) or "<|" in text]
        done = dict(zip(whole, self._encoded([texts[k] for k in whole]), strict=True))
        words = {k: WORDS.findall(text) for k, text in enumerate(texts) if k not in done}
        if len(self.seen) > WORDS_KEPT:
            self.seen.clear()
        new = list(set().union(*words.values()) - self.seen.keys())
        self.seen.update(zip(new, self._encoded(new), strict=True))
        get = self.seen.__getitem__
        return [done[k] if k in done else sum(map(get, words[k])) for k in range(len(texts))]

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


def counts(tok: Tokenizer, short: WordCounts, texts: list[str]) -> Iterator[int]:
    """Tokens of each text, in order: short ones in batches, long ones by splicing."""
    batch: list[str] = []
    total = 0
    for text in texts:
        if len(text) <= CHUNK_CHARS:
            batch.append(text)
            total += len(text)
        if total >= BATCH_CHARS or len(text) > CHUNK_CHARS:
            yield from short(batch)
            batch, total = [], 0
        if len(text) > CHUNK_CHARS:
            yield spliced_count(tok, text)
    yield from short(batch)


def token_counts(
    documents: DataFrame, vocabulary: str, over: int = 1024, text: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``documents``.

    ``vocabulary`` is the path of a byte-level tokenizer file that every executor can open. NULL
    and empty texts have no bytes and no tokens; a NULL doc_id is returned as it is; repeated rows
    are counted one by one; other columns are not read. Special strings inside a text are one
    token each, as the library has it by default; none are added.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(vocabulary)
        short = WordCounts(tok)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch.pop("whole_text")]
            batch["n_tokens"] = list(counts(tok, short, texts))
            yield batch

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        byte_size(text).alias("n_bytes"),
        F.col(text).alias("whole_text"),
    )
    # An Arrow batch is bounded by rows; the session bounds its bytes.
    counted = rows.mapInPandas(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(over))
