"""Language of words and documents by a linear-chain conditional random field.

Every word of a text gets a label. Its features are its beginnings and ends (affixes), its byte
3-grams and, if it is in the lexicon of frequent training words, itself; the labels of neighbouring
words are tied by learned transitions. Training sequences are windows of sampled documents, half of
them spliced from two languages, so that the transitions see switches. Forward-backward gives each
word's label probabilities; a document's language has the largest sum. Long texts are cut into stretches
whose label paths are summed up in one small matrix each, so that all stretches are worked on side by side
with the probabilities of the whole text, and only a part of the text's words is held at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.llm.common import fold, staged
from regiostat.llm.word_arrays import Prefix, pieces, spans

#: Documents sampled for each language and in all, windows taken from each, words in a window.
FIT_DOCS, MOST_FIT_DOCS = 400, 20_000
WINDOWS, WINDOW_WORDS = 3, 24
#: Lexicon words occur so often in the training windows.
LEXICON_COUNT = 3
AFFIXES = (1, 2, 3, 4)
TABLE = 1 << 16
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.2, 1e-5
#: Bytes of text whose words are labelled together.
GROUP_BYTES = 1 << 22
#: Longer texts go by stretches of so many words, and so many bytes are held at a time.
LONG_BYTES, STRETCH, PART_BYTES = 1 << 16, 512, 1 << 19
UNKNOWN = "und"

WORD = re.compile(r"[^\W\d_]+")

#: True for bytes that are no part of a word: ASCII other than letters.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def encoded(text: str | None) -> bytes:
    """Lower-case UTF-8 of a text; empty if it has no letter."""
    if not isinstance(text, str):
        return b""
    data = text.lower().encode("utf-8", "replace")
    return data if ASCII_LETTER.search(data) or any(map(str.isalpha, text)) else b""


ASCII_LETTER = re.compile(rb"[a-z]")


@dataclass
class Words:
    """Feature places of the words of some texts: one row of affix and lexicon places for each word,
    and the 3-gram places of all bytes with the range that belongs to each word."""

    tables: np.ndarray
    grams: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def features(data: np.ndarray, lexicon: np.ndarray) -> Words:
    """Features of all words in ``data``, which must not be longer than a few MB."""
    starts, ends = spans(data, NO_LETTER)
    hashes = Prefix(data)
    tables = np.zeros((len(starts), 2 * len(AFFIXES) + 1), np.int32)
    for k, n in enumerate(AFFIXES):
        head, tail = np.minimum(starts + n, ends), np.maximum(ends - n, starts)
        tables[:, 2 * k] = hashes.of(starts, head) >> np.uint64(48)
        tables[:, 2 * k + 1] = hashes.of(tail, ends) >> np.uint64(48)
    whole = hashes.of(starts, ends)
    at = np.searchsorted(lexicon, whole)
    known = at < len(lexicon)
    known[known] = lexicon[at[known]] == whole[known]
    tables[:, -1] = np.where(known, at + 1, 0)
    size = max(0, len(data) - 2)
    grams = np.zeros(len(data), np.uint32)
    key = data[:size].astype(np.uint32)
    key = (key << np.uint32(16)) | (data[1 : size + 1].astype(np.uint32) << np.uint32(8)) | data[2:]
    grams[:size] = (key * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return Words(tables, grams.astype(np.int32), starts, ends)


@dataclass
class Model:
    """Weights of affixes (one table for each kind), lexicon words, 3-grams and transitions."""

    labels: list[str]
    lexicon: np.ndarray
    affix: np.ndarray
    words: np.ndarray
    grams: np.ndarray
    transitions: np.ndarray

    @classmethod
    def empty(cls, labels: list[str], lexicon: np.ndarray) -> Model:
        n = len(labels)
        return cls(
            labels, lexicon, np.zeros((2 * len(AFFIXES), TABLE, n), np.float32),
            np.zeros((len(lexicon) + 1, n), np.float32), np.zeros((TABLE, n), np.float32), np.zeros((n, n)),
        )

    def emissions(self, words: Words) -> np.ndarray:
        """Score of each label for each word. A word's 3-grams are those that start inside it and end
        before it is over, or at the separator behind it."""
        found = self.words[words.tables[:, -1]].astype(np.float64)
        for k in range(2 * len(AFFIXES)):
            found += self.affix[k, words.tables[:, k]]
        sums = np.zeros((len(words.grams) + 1, len(self.labels)))
        np.cumsum(self.grams[words.grams], axis=0, dtype=np.float64, out=sums[1:])
        return found + sums[_gram_ends(words)] - sums[words.starts]


def _gram_ends(words: Words) -> np.ndarray:
    return np.maximum(words.starts, words.ends - 1)


def marginals(
    scores: np.ndarray,
    lengths: np.ndarray,
    transitions: np.ndarray,
    enter: np.ndarray | None = None,
    leave: np.ndarray | None = None,
) -> np.ndarray:
    """Label probabilities of every word by forward-backward over many sequences at once.

    Sequences stand one after another in ``scores``. Step t works on the t-th words of all sequences
    that are long enough, the longest first. ``enter`` and ``leave`` weigh the labels of the first and the
    last word of each sequence by what stands before and after it.
    """
    full = np.flatnonzero(lengths)
    order = full[np.argsort(-lengths[full], kind="stable")]
    sizes = lengths[order]
    rank = np.zeros(len(lengths), np.int64)
    rank[order] = np.arange(len(order))
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, steps + 1), side="right")
    offset = np.concatenate([[0], np.cumsum(active)])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    packed = offset[np.arange(len(scores)) - begin[owner]] + rank[owner]
    local = np.empty_like(scores)
    local[packed] = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    begun = np.ones((len(order), scores.shape[1])) if enter is None else enter[order]
    forward = np.empty_like(local)
    for t in range(steps):
        a, b = offset[t], offset[t + 1]
        here = begun * local[a:b] if t == 0 else (forward[offset[t - 1] : offset[t - 1] + b - a] @ step) * local[a:b]
        forward[a:b] = here / here.sum(axis=1, keepdims=True)
    backward = np.ones_like(local)
    if leave is not None and len(order):
        backward[offset[sizes - 1] + np.arange(len(order))] = leave[order]
    for t in range(steps - 2, -1, -1):
        a, n = offset[t], active[t + 1]
        later = slice(offset[t + 1], offset[t + 2])
        here = (local[later] * backward[later]) @ step.T
        backward[a : a + n] = here / here.sum(axis=1, keepdims=True)
    both = forward * backward
    both /= both.sum(axis=1, keepdims=True)
    return both[packed]


def transfers(scores: np.ndarray, length: int, transitions: np.ndarray) -> np.ndarray:
    """Weights of all label paths of stretches of ``length`` words, from each first to each last label.

    One matrix for each stretch, right up to a factor.
    """
    n = scores.shape[1]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(-1, length, n)
    step = np.exp(transitions - transitions.max())
    paths = local[:, 0, :, None] * np.eye(n)
    for t in range(1, length):
        paths = (paths.reshape(-1, n) @ step).reshape(-1, n, n) * local[:, t, None, :]
        paths /= paths.sum(axis=(1, 2), keepdims=True)
    return paths


def surroundings(paths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What stands before and after each of the stretches of one text, as ``marginals`` takes it."""
    step = np.exp(transitions - transitions.max())
    enter, leave = np.ones(paths.shape[:2]), np.ones(paths.shape[:2])
    for k in range(1, len(paths)):
        row = enter[k - 1] @ paths[k - 1] @ step
        enter[k] = row / row.sum()
    for k in range(len(paths) - 2, -1, -1):
        column = step @ (paths[k + 1] @ leave[k + 1])
        leave[k] = column / column.sum()
    return enter, leave


def pair_totals(
    scores: np.ndarray, length: int, transitions: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and expected label pairs, of sequences that all have ``length`` words."""
    n = scores.shape[1]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(-1, length, n)
    step = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(local), np.ones_like(local)
    forward[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, length):
        here = (forward[:, t - 1] @ step) * local[:, t]
        forward[:, t] = here / here.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        here = (local[:, t + 1] * backward[:, t + 1]) @ step.T
        backward[:, t] = here / here.sum(axis=1, keepdims=True)
    both = forward * backward
    both /= both.sum(axis=2, keepdims=True)
    pairs = np.einsum("bti,btj->btij", forward[:, :-1], local[:, 1:] * backward[:, 1:]) * step
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return both.reshape(-1, n), pairs.sum(axis=(0, 1))


def train(windows: list[tuple[str, str]]) -> Model | None:
    """A model from (language, window of ``WINDOW_WORDS`` words) rows in a fixed order."""
    labels = sorted({lang for lang, _ in windows})
    if not labels:
        return None
    draw = np.random.default_rng(5)
    number = {lang: k for k, lang in enumerate(labels)}
    texts, truth = [], []
    for lang, text in windows:
        words = text.split(" ")
        tags = [number[lang]] * WINDOW_WORDS
        if draw.random() < 0.5:
            cut = int(draw.integers(1, WINDOW_WORDS))
            other, more = windows[int(draw.integers(len(windows)))]
            words = words[:cut] + more.split(" ")[cut:]
            tags = tags[:cut] + [number[other]] * (WINDOW_WORDS - cut)
        texts.append(words)
        truth.append(tags)
    tags = np.array(truth)
    counts = pd.Series([w for words in texts for w in words]).value_counts()
    frequent = " ".join(sorted(counts[counts >= LEXICON_COUNT].index)).encode()
    data = np.frombuffer(frequent, np.uint8)
    lexicon = np.unique(Prefix(data).of(*spans(data, NO_LETTER)))
    model = Model.empty(labels, lexicon)
    squares = [np.full_like(x, 1e-6, dtype=np.float64) for x in _weights(model)]
    n = len(labels)
    batches = [slice(k, k + BATCH) for k in range(0, len(texts), BATCH)]
    found = [
        features(np.frombuffer(" ".join(" ".join(t) for t in texts[b]).encode() + b" ", np.uint8), lexicon)
        for b in batches
    ]
    for _ in range(EPOCHS):
        for k in draw.permutation(len(batches)):
            words, wanted = found[k], tags[batches[k]]
            both, pairs = pair_totals(model.emissions(words), WINDOW_WORDS, model.transitions)
            error = -both
            error[np.arange(len(both)), wanted.ravel()] += 1
            seen = np.zeros((n, n))
            np.add.at(seen, (wanted[:, :-1].ravel(), wanted[:, 1:].ravel()), 1)
            steps = _gradients(model, words, error)
            steps.append(seen - pairs)
            for weight, square, step in zip(_weights(model), squares, steps, strict=True):
                step -= DECAY * weight
                square += step * step
                weight += (RATE * step / np.sqrt(square)).astype(weight.dtype)
    return model


def _weights(model: Model) -> list[np.ndarray]:
    return [model.affix, model.words, model.grams, model.transitions]


def _gradients(model: Model, words: Words, error: np.ndarray) -> list[np.ndarray]:
    n = error.shape[1]
    lengths = _gram_ends(words) - words.starts
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    grams = words.grams[words.starts[owner] + inside]
    affix, lexical, gram = (np.zeros(x.shape) for x in (model.affix, model.words, model.grams))
    for label in range(n):
        for k in range(2 * len(AFFIXES)):
            affix[k, :, label] = np.bincount(words.tables[:, k], error[:, label], TABLE)
        lexical[:, label] = np.bincount(words.tables[:, -1], error[:, label], len(lexical))
        gram[:, label] = np.bincount(grams, error[owner, label], TABLE)
    return [affix, lexical, gram]


def fit(documents: DataFrame, learnable: Column, text: str = "text", lang: str = "lang") -> Model | None:
    """Learns from windows of the ``FIT_DOCS`` documents of each language with the smallest hash.

    At most ``MOST_FIT_DOCS`` documents are used, the first of every language before the second. Repeated rows count once.
    """
    tie = F.xxhash64("doc_id", text)
    usable = documents.filter(learnable & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    usable = staged(usable.select("doc_id", F.col(lang).alias("lang"), tie.alias("tie")).distinct(), "language-ids")
    # A common language is cut to its smallest hashes before its rows meet: with four times as many as are
    # wanted on average, fewer than are wanted never remain.
    # Written, so that Spark knows how small it is and does not deal the documents by language to join it.
    sizes = staged(usable.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    part = 4.0 * FIT_DOCS / F.col("n")
    bound = F.when(part < 1, (part * 2.0**64 - 2.0**63).cast("long"))
    by_hash = Window.partitionBy("lang").orderBy("tie", "doc_id")
    sample = (
        usable.join(sizes.select("lang", bound.alias("bound")), "lang")
        .filter("bound IS NULL OR tie <= bound")
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= FIT_DOCS)
        .orderBy("place", "lang")
        .limit(MOST_FIT_DOCS)
    )
    sample = staged(sample.select("doc_id", "tie"), "language-sample")
    chosen = documents.filter(learnable & F.col(lang).isNotNull()).withColumn("tie", tie)
    chosen = chosen.join(F.broadcast(sample.distinct()), ["doc_id", "tie"], "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for whole, language, key in zip(batch["text"], batch["lang"], batch["tie"], strict=True):
                lower = whole.lower()
                words = sum(1 for _ in WORD.finditer(lower))
                for k in range(WINDOWS if words else 0):
                    room = max(1, words - WINDOW_WORDS + 1)
                    start = (int(key) * (2 * k + 1) >> 7) % room
                    window = [m[0] for m in islice(WORD.finditer(lower), start, start + WINDOW_WORDS)]
                    window = (window * WINDOW_WORDS)[:WINDOW_WORDS]
                    out.append((language, " ".join(window), key, k))
            yield pd.DataFrame(out, columns=["lang", "text", "tie", "k"]).astype(
                {"lang": object, "text": object, "tie": "int64", "k": "int64"}
            )

    rows = chosen.select(F.col(text).alias("text"), F.col(lang).alias("lang"), "tie")
    found = rows.mapInPandas(run, "lang string, text string, tie long, k long")
    windows = staged(found, "language-windows").orderBy("tie", "k", "text").collect()
    return train([(r["lang"], r["text"]) for r in windows])


def _word_scores(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Label scores of all words, and the number of words of each text."""
    scores, counts = [], np.zeros(len(texts), np.int64)
    run: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        run.append(k)
        size += len(text) + 1
        if size < 1 << 19 and k + 1 < len(texts):
            continue
        data = np.frombuffer(b"\n".join(texts[i] for i in run) + b"\n", np.uint8)
        begins = np.cumsum([0, *(len(texts[i]) + 1 for i in run)])
        for a, b in pieces(data, NO_LETTER):
            words = features(data[a:b], model.lexicon)
            scores.append(model.emissions(words))
            owner = np.searchsorted(begins, words.starts + a, side="right") - 1
            counts[run[0] : run[-1] + 1] += np.bincount(owner, minlength=len(run))[: len(run)]
        run, size = [], 0
    return np.concatenate(scores), counts


def words_in_parts(model: Model, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, ends, label probabilities) of the words of one text, a part of it at a time.

    The first pass over the parts makes the matrices of their stretches, the second the probabilities, which
    are those of forward-backward over the whole text. Memory follows a part, and a matrix a stretch.
    """
    data = np.frombuffer(text + b"\n", np.uint8)
    parts = pieces(data, NO_LETTER, PART_BYTES)
    paths = []
    for a, b in parts:
        scores = model.emissions(features(data[a : b + 1], model.lexicon))
        whole = len(scores) // STRETCH * STRETCH
        paths.append(transfers(scores[:whole], STRETCH, model.transitions))
        if whole < len(scores):
            paths.append(transfers(scores[whole:], len(scores) - whole, model.transitions))
    enter, leave = surroundings(np.concatenate(paths), model.transitions)
    first = 0
    for a, b in parts:
        words = features(data[a : b + 1], model.lexicon)
        count = len(words.starts)
        lengths = np.diff(np.append(np.arange(0, count, STRETCH), count))
        these = slice(first, first + len(lengths))
        found = marginals(model.emissions(words), lengths, model.transitions, enter[these], leave[these])
        yield words.starts + a, words.ends + a, found
        first += len(lengths)


def _label_totals(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the label probabilities of the words of each text, and its number of words."""
    scores, counts = _word_scores(model, texts)
    found = marginals(scores, counts, model.transitions)
    sums = np.zeros((len(found) + 1, found.shape[1]))
    np.cumsum(found, axis=0, out=sums[1:])
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts], counts


def _long_totals(model: Model, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``_label_totals`` of one long text."""
    totals, count = np.zeros((1, len(model.labels))), 0
    for starts, _, found in words_in_parts(model, text):
        totals += found.sum(axis=0)
        count += len(starts)
    return totals, np.array([count])


def label_texts(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text; the score is the language's share of the word labels."""
    languages, shares = [], []
    data = [encoded(t) for t in texts]
    first = 0
    while first < len(data):
        last, size = first + 1, len(data[first])
        if size > LONG_BYTES:
            totals, counts = _long_totals(model, data[first])
        else:
            while last < len(data) and len(data[last]) <= LONG_BYTES and size < GROUP_BYTES:
                size += len(data[last])
                last += 1
            totals, counts = _label_totals(model, data[first:last])
        for k, n in enumerate(counts):
            if n:
                best = int(totals[k].argmax())
                languages.append(model.labels[best])
                shares.append(float(min(1.0, totals[k][best] / n)))
            else:
                languages.append(UNKNOWN)
                shares.append(0.0)
        first = last
    return languages, shares


def word_labels(model: Model, text: str) -> list[tuple[str, str]]:
    """(word, language) of every word of one text, for code-switched text."""
    data = encoded(text)
    return [
        (data[a:b].decode("utf-8", "replace"), model.labels[k])
        for starts, ends, found in words_in_parts(model, data)
        for a, b, k in zip(starts, ends, found.argmax(axis=1), strict=True)
    ]


def predicted_languages(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``documents``.

    Languages are learned only from rows whose crc32(doc_id) modulo 4 is not 2 and whose lang is not
    NULL; ``held_out`` marks the rows with remainder 2. A NULL text, or one without a letter, is ``und``
    with score 0, and so is every text if there is nothing to learn from. A NULL doc_id is not held out
    and never learned from. Other columns are not read. An empty table gives an empty result.
    """
    model = fit(documents, fold("doc_id", 4) != 2)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for column in columns:
            texts = column.tolist()
            if known is None:
                languages, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
            else:
                languages, shares = label_texts(known, texts)
            yield pd.DataFrame({"lang": pd.Series(languages, dtype=object), "score": shares})

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        predict(F.col("text")).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))
