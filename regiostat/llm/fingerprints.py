"""Fingerprints of texts: threshold-scaled sketches of word shingles.

A sketch holds every shingle hash below a fixed fraction of the hash range. Whether a hash is kept depends on
the hash alone, so sketches merge by union, and the share of a small document's sketch that is found in
a large one estimates how much of it is contained there, however unequal the two are.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.ordering import with_previous

#: Words of a shingle.
WORDS = 5
#: One shingle hash in so many is kept.
SCALE = 4
#: Bytes that part words.
SPACE = r"[\x20\x09-\x0D]+"


def with_sketch(df: DataFrame, text: str, name: str, scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """Adds ``<name>_words`` (a hash of all words) and ``<name>_sketch`` (kept hashes, ascending).

    Words are lower-cased. A text of fewer than ``words`` words has one shingle, the whole; without words, none.
    A sketch may be empty; the hash of all words then still tells texts apart.
    """
    if scale < 2 or words < 1:
        raise ValueError("scale is 2 or more, words 1 or more")
    listed = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), "")
    w = F.col("_listed")
    count = F.size(w)
    starts = F.sequence(F.lit(0), F.greatest(count - words, F.lit(0)))
    shingles = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)]))
    hashes = F.when(count == 0, F.array().cast("array<long>")).when(
        count < words, F.array(F.xxhash64(w))
    ).otherwise(shingles)
    highest = F.lit((1 << 64) // scale - 1)
    kept = F.filter(hashes, lambda h: (h >= 0) & (h <= highest))
    return (
        df.withColumn("_listed", listed)
        .withColumn(f"{name}_sketch", F.sort_array(F.array_distinct(kept)))
        .withColumn(f"{name}_words", F.xxhash64(w))
        .drop("_listed")
    )


def fingerprint(name: str) -> Column:
    """A sketch as text: hash of all words, colon, kept hashes in hex; equal texts give equal ones."""
    hashes = F.transform(f"{name}_sketch", lambda h: F.lower(F.hex(h)))
    return F.concat(F.lower(F.hex(f"{name}_words")), F.lit(":"), F.array_join(hashes, ","))


def containment(a: str, b: str) -> Column:
    """Estimated share of the smaller text's shingles that the other one has, 0 to 1.

    Texts of the same words have 1; else an empty sketch shares nothing.
    """
    left, right = F.col(f"{a}_sketch"), F.col(f"{b}_sketch")
    least = F.least(F.size(left), F.size(right))
    shared = F.size(F.array_intersect(left, right))
    return (
        F.when(F.col(f"{a}_words") == F.col(f"{b}_words"), F.lit(1.0))
        .when(least == 0, F.lit(0.0))
        .otherwise(shared / F.greatest(least, F.lit(1)))
    )


def merged(sketches: DataFrame, sketch: str, *groups: str) -> DataFrame:
    """Union of the sketches of each group: the sketch of all its texts together (groups, sketch).

    Hashes are made distinct before and after the shuffle, so a group may hold most rows.
    """
    hashes = sketches.select(*groups, F.explode(sketch).alias("_hash")).distinct()
    return hashes.groupBy(*groups).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def edited(text: str, other: str) -> Column:
    """The text with its last half, rounded down, replaced by as many first code points of the other."""
    half = F.shiftright(F.char_length(text), 1)
    return F.concat(
        F.substring(F.col(text), F.lit(1), F.char_length(text) - half),
        F.substring(F.col(other), F.lit(1), half),
    )


def fingerprints(documents: DataFrame, scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they and the next one are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next document is
    the one with the next smaller doc_id, after the smallest the largest; a single document is its own next one.

    A NULL text is empty: no shingles, its fingerprint has no hashes. A NULL doc_id comes after all others. Rows of one
    doc_id are ordered by a hash of their text, and repeated rows each give a row. Other columns take no part; an empty
    table gives no row.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    own = with_sketch(texts, "text", "own", scale, words)
    # Descending order: the next document is the one before in ascending order.
    pairs = with_previous(own, ["doc_id", "hash"], ["text", "own_words", "own_sketch"], "next_")
    both = pairs.withColumn("edited", edited("text", "next_text"))
    both = both.withColumnsRenamed({"next_own_words": "next_words", "next_own_sketch": "next_sketch"})
    return with_sketch(both, "edited", "edited", scale, words).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("edited").alias("edited_fingerprint"),
        containment("own", "edited").alias("near_edited"), containment("own", "next").alias("near_next"),
    )
