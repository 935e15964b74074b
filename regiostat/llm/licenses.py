"""Licence scan: normalised text against licence templates by Dice coefficient over word bigrams.

Words are runs of letters and digits in lower case. A stretch of a document matches a template if
twice the number of shared distinct bigrams is at least ``LEAST_DICE`` of the sum of both numbers of
distinct bigrams. That bounds a stretch's size by the template's from both sides, and tells how many of
a template's bigrams a document must hold at least; templates with fewer are pruned at once, first by
their rarest bigrams, then by all.

Siblings differ in few words. So the marks of a notice (version, Lesser, Affero, ShareAlike ...) must be those
of the stretch; at the head of a whole text no mark may stand that the template's head has not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import slices
from regiostat.llm.license_templates import LINES, TEMPLATES
from regiostat.llm.word_arrays import constants, mix, word_hashes

LEAST_DICE = 0.8
TABLE_BITS = 18

MATCHES = "doc_id long, license string, template int, dice double, start_byte long, end_byte long"

ALL_TEMPLATES = [*TEMPLATES, *LINES]

#: True for bytes that separate words: ASCII other than letters and digits.
SEPARATORS = np.ones(256, bool)
SEPARATORS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

#: Templates of so many bigrams are whole texts: they go before the notices inside them.
WHOLE_TEXT = 130
#: Bigrams between a whole text and a line that is a part of it.
NEAR = 64
#: Bytes at the head of a whole text's stretch and of its template that are searched for marks.
STRETCH_HEAD, TEMPLATE_HEAD = 200, 2400
MARK = re.compile(
    rb"\b(?:lesser|library(?= general)|affero|zero|later(?= version)|(?<=or )later|endorse|sharealike|sa|noncommercial|nc"
    rb"|noderivatives|noderivs|nd)\b"
)
VERSION = re.compile(
    rb"\b(?:version|v|licen[sc]es?|by|sa|nc|nd|attribution|sharealike|noncommercial|noderivatives|noderivs|cc0|zero"
    rb"|bsd|[al]?gpl|mpl)[\s\W]*v?(\d(?:\.\d+)?)(?!\d)"
)
SAME_MARK = {b"sharealike": b"sa", b"noncommercial": b"nc", b"noderivatives": b"nd", b"noderivs": b"nd"}
#: What may follow a notice and make it another one: later versions, the third clause of BSD.
AFTER = re.compile(rb"[^.;]{0,40}?\bor\b[^.;]{0,30}?\blater\b|[\s\S]{0,200}?\bto endorse or promote\b")


def marks(data: bytes) -> frozenset[bytes]:
    """Words and versions of a licence text that tell it from its siblings."""
    data = b" ".join(data.lower().split())
    words = (SAME_MARK.get(w, w) for w in MARK.findall(data))
    return frozenset([*words, *(v.removesuffix(b".0") for v in VERSION.findall(data))])


def bigrams(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each pair of neighbouring words, with the start of the first and the end of the second."""
    starts, ends, hashes = word_hashes(np.frombuffer(data.lower(), np.uint8), SEPARATORS)
    one, two = constants(41, 2)
    return mix(hashes[:-1] * one + hashes[1:] * two), starts[:-1], ends[1:]


class Templates:
    """Distinct bigrams of all templates, with the templates that hold each of the rare ones."""

    def __init__(self, texts: list[str], least: float):
        data = [t.encode() for t in texts]
        self.sets = [np.unique(bigrams(t)[0]) for t in data]
        self.least = least
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.marks = [
            marks(t[:TEMPLATE_HEAD] if size >= WHOLE_TEXT else t) for t, size in zip(data, self.sizes, strict=True)
        ]
        self.needed = np.ceil(least / (2 - least) * self.sizes - 1e-9).astype(np.int64)
        # Of the bigrams other than any needed - k ones, a match holds k at least.
        self.rare_needed = np.maximum(1, self.needed // 4)
        every, held = np.unique(np.concatenate([*self.sets, np.zeros(0, np.uint64)]), return_counts=True)
        rare = [
            s[np.argsort(held[np.searchsorted(every, s)], kind="stable")][: max(0, size - needed + least_rare)]
            for s, size, needed, least_rare in zip(
                self.sets, self.sizes, self.needed, self.rare_needed, strict=True
            )
        ]
        flat = np.concatenate([*rare, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(rare)), [len(r) for r in rare])
        order = np.argsort(flat, kind="stable")
        self.grams, first = np.unique(flat[order], return_index=True)
        self.first, self.owner = np.append(first, len(flat)), owner[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.grams & np.uint64((1 << TABLE_BITS) - 1)] = True

    def find(
        self, grams: np.ndarray, text: np.ndarray, agrees: Callable[[int, int, int], bool] | None = None
    ) -> list[tuple[int, float, int, int]]:
        """(template, dice, first bigram, last bigram) of the best stretches, no two overlapping.

        ``text`` numbers the text that each bigram stands in, in order. ``agrees`` may refuse a stretch, and
        with it those of the same template that overlap it.
        """
        place = np.flatnonzero(self.table[grams & np.uint64((1 << TABLE_BITS) - 1)])
        which = np.searchsorted(self.grams, grams[place])
        same = which < len(self.grams)
        same[same] = self.grams[which[same]] == grams[place[same]]
        place, which = place[same], which[same]
        count = self.first[which + 1] - self.first[which]
        row = np.repeat(np.arange(len(which)), count)
        owner = self.owner[
            np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.first[which][row]
        ]
        templates = max(1, len(self.sizes))
        key, held = np.unique(text[place[row]] * templates + owner, return_counts=True)
        found = []
        for k in key[held >= self.rare_needed[key % templates]].tolist():
            number, template = divmod(k, templates)
            a, b = np.searchsorted(text, [number, number + 1])
            found += [
                (template, dice, int(a) + start, int(a) + end)
                for dice, start, end in self._stretches(template, grams[a:b])
            ]
        whole = self.sizes >= WHOLE_TEXT
        kept: list[tuple[int, float, int, int]] = []
        refused: dict[int, list[tuple[int, int]]] = {}
        for match in sorted(found, key=lambda m: (not whole[m[0]], -m[1], -self.sizes[m[0]], m[0], m[2])):
            template, _, start, end = match
            if any(end >= a and start <= b for _, _, a, b in kept):
                continue
            if any(end >= a and start <= b for a, b in refused.get(template, [])):
                continue
            if not whole[template] and any(
                whole[t] and self._part(t, start, end, a, b, grams, text) for t, _, a, b in kept
            ):
                continue
            wide = self._widened(template, start, end, grams, text)
            if not any(wide[1] >= a and wide[0] <= b for _, _, a, b in kept):
                start, end = wide
            if agrees is None or agrees(template, start, end):
                kept.append((template, match[1], start, end))
            else:
                refused.setdefault(template, []).append((start, end))
        return sorted(kept, key=lambda m: m[2])

    def _widened(
        self, template: int, start: int, end: int, grams: np.ndarray, text: np.ndarray
    ) -> tuple[int, int]:
        """The stretch with the bigrams beside it that it and the template hold already."""
        held = set(np.intersect1d(grams[start : end + 1], self.sets[template]).tolist())
        while start and text[start - 1] == text[start] and int(grams[start - 1]) in held:
            start -= 1
        while end + 1 < len(grams) and text[end + 1] == text[end] and int(grams[end + 1]) in held:
            end += 1
        return start, end

    def _part(
        self, whole: int, start: int, end: int, a: int, b: int, grams: np.ndarray, text: np.ndarray
    ) -> bool:
        """Whether a notice is a title or last line that changed words cut off a whole text's stretch a to b."""
        near = text[start] == text[a] and max(a - end, start - b) <= NEAR
        return bool(near and np.isin(grams[start : end + 1], self.sets[whole]).all())

    def agree(self, template: int, data: bytes, start: int, end: int) -> bool:
        """Whether the marks of a stretch of ``data`` are those of the template."""
        if self.sizes[template] >= WHOLE_TEXT:
            return marks(data[start : min(end, start + STRETCH_HEAD)]) <= self.marks[template]
        if marks(data[start:end]) != self.marks[template]:
            return False
        wanted = self.marks[template] & {b"later", b"endorse"}
        return bool(wanted) or not AFTER.match(b" ".join(data[end : end + 400].lower().split()))

    def _stretches(self, template: int, grams: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(dice, first, last) of the best stretch from each bigram of one text that the template holds."""
        size, needed = int(self.sizes[template]), int(self.needed[template])
        known = self.sets[template]
        at = np.minimum(np.searchsorted(known, grams), size - 1)
        shared = known[at] == grams
        hits = np.flatnonzero(shared)
        if len(np.unique(grams[hits])) < max(1, needed):
            return
        order = np.argsort(grams, kind="stable")
        same = grams[order][1:] == grams[order][:-1]
        before = np.full(len(grams), -1)
        before[order[1:][same]] = order[:-1][same]
        after = np.full(len(grams), len(grams))
        after[order[:-1][same]] = order[1:][same]
        # Distinct bigrams of a stretch are bounded; repeated ones make it longer.
        most = int(size * (2 - self.least) / self.least + 1e-9)
        for start in hits[: len(hits) - max(1, needed) + 1].tolist():
            # From the same bigram further on, a stretch that holds it again is closer.
            stop, length = int(after[start]), 2 * most
            while True:
                part = slice(start, min(stop, start + length))
                new = before[part] < start
                seen = np.cumsum(new)
                if part.stop == stop or seen[-1] > most:
                    break
                length *= 2
            dice = 2 * np.cumsum(new & shared[part]) / (size + seen)
            dice[(seen > most) | ~shared[part]] = 0
            last = int(np.argmax(dice))
            if dice[last] >= self.least - 1e-12:
                yield float(dice[last]), start, start + last


def license_matches(
    documents: DataFrame, templates: list[tuple[str, str]] = ALL_TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """(doc_id, license, template, dice, start_byte, end_byte) of every licence text found.

    ``template`` is the position in ``templates``, a list of (licence, text) that the caller bounds;
    bytes are those of the UTF-8 text. Documents without a licence have no row; NULL and empty texts have
    none; a NULL doc_id is returned as it is; repeated rows are scanned one by one. Of overlapping stretches
    those of whole texts count first, then the closest, then the longer and the earlier template. Other columns are not read.
    """
    names = [name for name, _ in templates]
    shared = documents.sparkSession.sparkContext.broadcast([text for _, text in templates])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Templates(shared.value, least)
        for batch in batches:
            ids = batch["doc_id"].tolist()
            out = []
            for first, texts in slices(batch["text"]):
                # A word that no template holds keeps bigrams of different texts apart.
                joined = b" \xc2\xa0\xc2\xa0 ".join(texts)
                grams, starts, ends = bigrams(joined)
                begins = np.cumsum([0, *(len(t) + 6 for t in texts[:-1])])
                text = np.searchsorted(begins, starts, side="right") - 1

                def agrees(
                    template: int, a: int, b: int, starts=starts, ends=ends, text=text, begins=begins, texts=texts
                ) -> bool:
                    k = int(text[a])
                    return known.agree(template, texts[k], int(starts[a] - begins[k]), int(ends[b] - begins[k]))

                for template, dice, a, b in known.find(grams, text, agrees):
                    k = int(text[a])
                    out.append(
                        (ids[first + k], names[template], template, dice, starts[a] - begins[k], ends[b] - begins[k])
                    )
            yield pd.DataFrame(out, columns=[c.split()[0] for c in MATCHES.split(", ")]).astype(
                {"doc_id": "Int64", "license": object}
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.filter("text IS NOT NULL").mapInPandas(run, MATCHES)
