"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts and benchmark items are compared in lower case with single spaces. An item of m characters is
found where at most e = ``RATE`` * m edits turn it into a stretch of the text. Such a stretch shares
at least m - q + 1 - q * e of the item's q-grams, on diagonals (place in the text minus place in the
item) that differ by at most e. Diagonals are dealt to bands that overlap by e and are at least e apart,
wider for longer items, so one band holds them all. Bands with enough shared q-grams are verified by an alignment inside the band.

The benchmark goes to the tasks in blocks of a fixed number of characters, one scan of the documents
for each block; an ordinary benchmark is one block.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.llm.word_arrays import constants, mix

Q = 8
RATE = 0.1
#: Items (normalised) of fewer UTF-8 bytes, or of fewer than ``Q`` characters, are no passages and match
#: nothing. Bytes, since a few Chinese, Japanese or Korean characters are a whole question.
LEAST_BYTES = 24
#: Diagonals by which neighbouring bands are apart, as a power of two; more for items with more edits.
BAND_BITS = 6
#: Characters of text looked at together, and of the benchmark in a block.
WINDOW = 1 << 17
BLOCK_CHARS = 1 << 22
TABLE_BITS = 22

MATCHES = "doc_id long, item_id long, start_char long, end_char long, distance int, item_chars int"


def normalised(text: str) -> str:
    """Lower case, every run of white space one space."""
    return " ".join(text.lower().split()).replace("\0", " ")


def places(text: str) -> list[int]:
    """Original position of each character of the normalised text, and the end."""
    found: list[int] = []
    blank = True
    for k, char in enumerate(text):
        if char.isspace():
            if not blank:
                found.append(k)
            blank = True
        else:
            found += [k] * len(char.lower())
            blank = False
    if blank and found:
        found.pop()
    return [*found, found[-1] + 1 if found else 0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _is_passage(text: str) -> bool:
    return len(text) >= Q and len(text.encode("utf-8", "replace")) >= LEAST_BYTES


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    size = max(0, len(codes) - Q + 1)
    found = np.zeros(size, np.uint64)
    for k, factor in enumerate(constants(31, Q)):
        found += codes[k : k + size] * factor
    return mix(found)


@dataclass
class Index:
    """Items of a block with the places of their q-grams."""

    ids: list[int | None]
    codes: list[np.ndarray]
    edits: np.ndarray
    #: Power of two by which an item's bands are apart, at least its edits.
    bits: np.ndarray
    needed: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    items: np.ndarray
    at: np.ndarray
    table: np.ndarray
    #: Characters that a match and its band can span.
    reach: int


def build_index(rows: list[tuple[int | None, str]], rate: float = RATE) -> Index:
    kept = [(i, _codes(t)) for i, t in ((i, normalised(t)) for i, t in rows) if _is_passage(t)]
    codes = [c for _, c in kept]
    lengths = np.array([len(c) for c in codes], dtype=np.int64)
    edits = np.minimum((lengths * rate).astype(np.int64), (lengths - Q) // Q)
    bits = np.array([max(BAND_BITS, int(e - 1).bit_length()) for e in edits], dtype=np.int64)
    hashes = [_gram_hashes(c) for c in codes]
    flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    items = np.repeat(np.arange(len(codes)), [len(h) for h in hashes])
    at = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[grams & np.uint64((1 << TABLE_BITS) - 1)] = True
    return Index(
        [i for i, _ in kept], codes, edits, bits, lengths - Q + 1 - Q * edits,
        grams, np.append(first, len(flat)), items[order], at[order], table,
        int(max(lengths, default=0) * 1.4) + (4 << BAND_BITS),
    )


def candidate_bands(index: Index, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, lowest diagonal, highest diagonal) where the item shares enough q-grams.

    Bands are counted first. Inside a band that has enough, the count must also be reached by distinct
    places of the item on diagonals at most ``edits`` apart; the returned range spans all such diagonals.
    """
    hashes = _gram_hashes(codes)
    place = np.flatnonzero(index.table[hashes & np.uint64((1 << TABLE_BITS) - 1)])
    gram = np.searchsorted(index.grams, hashes[place])
    same = gram < len(index.grams)
    same[same] = index.grams[gram[same]] == hashes[place[same]]
    place, gram = place[same], gram[same]
    count = index.first[gram + 1] - index.first[gram]
    which = np.repeat(np.arange(len(gram)), count)
    posting = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + index.first[gram][which]
    item, at = index.items[posting].astype(np.int64), index.at[posting]
    diagonal = place[which] - at
    bits = index.bits[item]
    band = diagonal >> bits
    overlap = (diagonal & ((1 << bits) - 1)) < index.edits[item]
    base = (item << 32) + (1 << 31)
    key = np.concatenate([base + band, base[overlap] + band[overlap] - 1])
    source = np.concatenate([np.arange(len(item)), np.flatnonzero(overlap)])
    order = np.argsort(key, kind="stable")
    key, first, shared = np.unique(key[order], return_index=True, return_counts=True)
    found = set()
    for k in np.flatnonzero(shared >= index.needed[key >> 32]):
        which_item = int(key[k] >> 32)
        pairs = source[order[first[k] : first[k] + shared[k]]]
        near = _dense_diagonals(
            diagonal[pairs], at[pairs], int(index.edits[which_item]), int(index.needed[which_item])
        )
        if near:
            found.add((which_item, *near))
    return sorted(found)


def _dense_diagonals(
    diagonal: np.ndarray, at: np.ndarray, edits: int, needed: int
) -> tuple[int, int] | None:
    """Range of the diagonals that lie in a stretch of ``edits`` + 1 with ``needed`` places."""
    if len(set(at.tolist())) < needed:
        return None
    order = np.argsort(diagonal, kind="stable")
    diagonal, at = diagonal[order], at[order].tolist()
    # Of equal diagonals the first has the most places after it.
    lows, first = np.unique(diagonal, return_index=True)
    last = np.searchsorted(diagonal, lows + edits, side="right")
    held: Counter[int] = Counter()
    dense, a, b = [], 0, 0
    for k, (start, end) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
        held.update(at[b:end])
        for place in at[a:start]:
            held[place] -= 1
            if not held[place]:
                del held[place]
        a, b = start, end
        if len(held) >= needed:
            dense.append(k)
    if not dense:
        return None
    return int(lows[dense[0]]), int(diagonal[last[dense[-1]] - 1])


def align(item: np.ndarray, codes: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the best place of ``item``; see ``alignments``."""
    return next(iter(alignments(item, codes, low, high, edits)), None)


def alignments(
    item: np.ndarray, codes: np.ndarray, low: int, high: int, edits: int
) -> list[tuple[int, int, int]]:
    """(distance, start, end) of the places of ``item`` on diagonals ``low`` to ``high``, best first;
    of overlapping ones the best.

    Cell k of a row stands for diagonal low - edits + k. Cost and start are one number, cost first, so
    that the smallest is the cheapest and then the earliest. Places outside the text hold a character
    that equals none; to align with one costs as much as to drop the item's character. No place takes
    more than ``edits`` edits.
    """
    first = low - edits
    width = high - first + edits + 1
    unit, shift = 1 << 40, 1 << 32
    around = np.full(width + len(item) + 1, 0xFFFFFFFF, np.uint32)
    a, b = max(0, first), min(len(codes), first + len(around))
    if b > a:
        around[a - first : b - first] = codes[a:b]
    steps = np.arange(width, dtype=np.int64) * unit
    row = first + np.arange(width, dtype=np.int64) + shift
    for r, char in enumerate(item):
        swapped = row + (around[r : r + width] != char) * unit
        np.minimum(swapped[:-1], row[1:] + unit, out=swapped[:-1])
        swapped -= steps
        row = np.minimum.accumulate(swapped) + steps
        if not r & 31 and row.min() >= (edits + 1) * unit:
            return []
    near = np.flatnonzero(row < (edits + 1) * unit)
    found = []
    for cell in near[np.argsort(row[near], kind="stable")].tolist():
        cost, start = divmod(int(row[cell]), unit)
        end = min(first + cell + len(item), len(codes))
        found.append((cost, min(max(0, start - shift), end), end))
    return _apart(found)


def _apart(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The matches (distance, start, end) that overlap no earlier one."""
    kept: list[tuple[int, int, int]] = []
    # Kept ones in the order of their starts, which is that of their ends.
    starts: list[int] = []
    ends: list[int] = []
    for match in matches:
        k = bisect_left(starts, match[2])
        if k and ends[k - 1] > match[1]:
            continue
        kept.append(match)
        k = bisect_left(starts, match[1])
        starts.insert(k, match[1])
        ends.insert(k, match[2])
    return kept


def find(index: Index, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, distance) of every match in normalised texts; overlapping matches
    of one item in one text are one, the closest."""
    if not index.codes:
        return
    best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    step = max(WINDOW, 2 * index.reach)
    pieces = [
        (k, a, text[a : a + step])
        for k, text in enumerate(texts)
        for a in range(0, max(1, len(text) - index.reach + 1), step - index.reach)
    ]
    waiting = deque(pieces)
    while waiting:
        taken, size = [], 0
        while waiting and size < step:
            taken.append(waiting.popleft())
            size += len(taken[-1][2]) + 1
        codes = _codes("\0".join(p[2] for p in taken))
        begins = np.cumsum([0, *(len(p[2]) + 1 for p in taken)])
        for item, low, high in candidate_bands(index, codes):
            edits, length = int(index.edits[item]), len(index.codes[item])
            # A band may touch the end of one text and the start of the next.
            from_, to = np.searchsorted(begins, [max(0, low), high + length], side="right")
            for n in range(max(1, from_), min(len(taken), to) + 1):
                k, offset, piece = taken[n - 1]
                start = int(begins[n - 1])
                for distance, a, b in alignments(
                    index.codes[item], codes[start : start + len(piece)], low - start, high - start, edits
                ):
                    best.setdefault((k, item), []).append((distance, a + offset, b + offset))
    for (k, item), matches in sorted(best.items()):
        for distance, start, end in sorted(_apart(sorted(matches)), key=lambda m: m[1]):
            yield k, item, start, end, distance


def _blocks(benchmark: DataFrame) -> Iterator[list[Row]]:
    """The items in blocks of about ``BLOCK_CHARS`` characters, one at a time."""
    # Lower case can have up to three times the bytes of a text; the index looks at the normalised one.
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(
        F.octet_length("text") * 3 >= LEAST_BYTES
    )
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_CHARS))
    for k in range(blocks):
        yield rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy(
            "item_id", "text"
        ).collect()


def _shared(documents: DataFrame, rows: list[Row], rate: float) -> Broadcast:
    return documents.sparkSession.sparkContext.broadcast(
        (uuid.uuid4().hex, [tuple(r) for r in rows], rate)
    )


#: The index a Python worker built last, by the name of its block.
_built: dict[str, Index] = {}


def index_of(shared: Broadcast) -> Index:
    """The index of a block, built once per Python worker."""
    name, rows, rate = shared.value
    if name not in _built:
        _built.clear()
        _built[name] = build_index(rows, rate)
    return _built[name]


def leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, start_char, end_char, distance, item_chars) of every leaked item.

    Places are in the original text. Documents without a leak have no row. NULL and empty texts, and
    items that are NULL or shorter than ``LEAST_BYTES`` or ``Q``, match nothing; NULL ids are returned as they
    are; equal items and repeated rows are found one by one. Other columns are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).filter(
        "text IS NOT NULL"
    )
    found = documents.sparkSession.createDataFrame([], MATCHES)
    for block in _blocks(benchmark):
        shared = _shared(documents, block, rate)

        def run(
            batches: Iterator[pd.DataFrame], shared: Broadcast = shared
        ) -> Iterator[pd.DataFrame]:
            known = index_of(shared)
            for batch in batches:
                texts, ids = batch["text"].tolist(), batch["doc_id"].tolist()
                out, last, at = [], -1, []
                for k, item, start, end, distance in find(known, [normalised(t) for t in texts]):
                    if k != last:
                        last, at = k, places(texts[k])
                    span = (at[start], at[end - 1] + 1) if end > start else (at[start], at[start])
                    out.append((ids[k], known.ids[item], *span, distance, len(known.codes[item])))
                yield pd.DataFrame(out, columns=MATCH_COLUMNS).astype({"doc_id": "Int64", "item_id": "Int64"})

        found = found.union(rows.mapInPandas(run, MATCHES))
    return found


MATCH_COLUMNS = [c.split()[0] for c in MATCHES.split(", ")]


def _leaky(shared: Broadcast) -> Column:
    @F.pandas_udf(T.BooleanType())
    def leaky(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = index_of(shared)
        for column in columns:
            texts = [normalised(t) if isinstance(t, str) else "" for t in column]
            hit = np.zeros(len(texts), bool)
            hit[[k for k, *_ in find(known, texts)]] = True
            yield pd.Series(hit)

    return leaky(F.col("text"))


def without_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``documents`` that hold no item, with all their columns, whatever their names.

    NULL and empty texts hold no item and stay. Ids play no part, and repeated rows stay or go together. An empty table
    stays empty; with an empty benchmark nothing goes.
    """
    for block in _blocks(benchmark):
        documents = documents.filter(~_leaky(_shared(documents, block, rate)))
    return documents
