"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct word shingles. Equal sets are one *class* from the start. The
classes are sketched with two small collections of half keys, each made of ``ROWS`` minhashes; a table
key is one half key of each collection, so h squared tables cost only 2 * h * ``ROWS`` minhashes. Two
classes meet in a table if they share a half key in both collections. ``half_keys_for`` takes h from the
least similarity: 12 for 0.8, where a pair misses with probability below 2 * (1 - 0.8**2)**12 = 1e-5.

Half keys that only one class has are dropped before tables are formed; they cannot meet. Then

1. every class is compared with the smallest class of its tables, the one met most often and itself only if
   it meets no smaller one: its *pivot*. That links the usual group of copies without looking at pairs;
2. classes with one pivot that are not yet connected are compared with the others of that pivot, in
   blocks that hold the full sets; classes of the largest component are not compared with each other;
3. classes of different pivots that meet in a table but are not yet connected are found in blocks of
   tables, tables with the same strangers (``open_tables``) put together, and then compared.

So no link between different components is lost. In steps 2 and 3 a pair must also agree in a number of
``MARKS`` further minhashes (one byte of each), made only for classes that meet others; at similarity 0.8
a pair fails that with probability 2e-6. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiostat.llm.common import slices, staged
from regiostat.llm.word_arrays import constants, mix, word_hashes

ROWS = 2
#: A pair of exactly the least similarity meets in no table with at most this probability.
MOST_MISSED = 1e-5
#: Table keys of a document grow with the square of its half keys: 43 a side at this similarity.
LEAST_PERCENT = 50
#: Further minhashes of classes that meet others, and how many a similar pair shares at least: the mean
#: less 4.8 standard deviations at the least similarity (``least_agreeing``).
MARKS = 128
DEVIATIONS = 4.8
#: Classes in a block when those of one pivot, with full sets, or of one table are compared.
BLOCK = 512
TABLE_BLOCK = 4096
#: Shingles in a block that holds full sets, which bounds its memory for long texts.
BLOCK_SHINGLES = 250_000
#: Rows of such comparisons in one group of a task.
GROUP_ROWS = 4000
#: At most so many ids are broadcast to pick documents; beyond that Spark shuffles.
BROADCAST_IDS = 500_000

_MARK_FACTORS = constants(24, MARKS)
_MARK_OFFSETS = constants(25, MARKS)

SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("print1", T.LongType()),
        T.StructField("print2", T.LongType()),
        T.StructField("us", T.ArrayType(T.LongType())),
        T.StructField("vs", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("items", T.ArrayType(T.LongType())),
        T.StructField("marks", T.BinaryType()),
    ]
)


def shingle_sets(run: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts of a run, with the position of their text, in text order.

    Words are runs of other bytes than [\\x20\\x09-\\x0D], lower-cased in A-Z. A text with fewer
    words than a shingle has one hash of all its words; one without words has none.
    """
    data = np.frombuffer(b"\n".join(run).lower() + b"\n", dtype=np.uint8)
    starts, _, hashes = word_hashes(data)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    begins = np.cumsum([0, *(len(t) + 1 for t in run[:-1])])
    owner = np.searchsorted(begins, starts, side="right") - 1
    per_text = np.bincount(owner, minlength=len(run))
    factors = constants(23, words)
    whole = len(hashes) - words + 1
    if whole > 0:
        items = np.zeros(whole, np.uint64)
        for k in range(words):
            items += hashes[k : k + whole] * factors[k]
        inside = owner[:whole] == owner[words - 1 :]
        items, place = mix(items[inside]), owner[:whole][inside]
    else:
        items, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((per_text > 0) & (per_text < words))
    if len(short):
        first = np.searchsorted(owner, short)
        extra = [
            mix((hashes[a : a + n] * factors[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))[0]
            for a, n in zip(first, per_text[short], strict=True)
        ]
        items = np.concatenate([items, np.array(extra, np.uint64)])
        place = np.concatenate([place, short])
        order = np.argsort(place, kind="stable")
        items, place = items[order], place[order]
    return items, place


def distinct_sets(run: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    items, place = shingle_sets(run, words)
    cuts = np.searchsorted(place, np.arange(1, len(run)))
    return [np.unique(part) for part in np.split(items, cuts)]


def half_keys_for(percent: int) -> int:
    """Half keys of each collection that keep the probability of a miss below ``MOST_MISSED``."""
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be {LEAST_PERCENT} to 100")
    differs = 1 - (percent / 100) ** ROWS
    return next(h for h in count(1) if 2 * differs**h <= MOST_MISSED)


def half_keys(items: np.ndarray, cuts: np.ndarray, halves: int) -> np.ndarray:
    """Two collections of half keys of each non-empty set; ``cuts`` has the sets' starts."""
    numbers = 2 * halves * ROWS
    least = [
        np.minimum.reduceat((items * f + o) >> np.uint64(32), cuts)
        for f, o in zip(constants(21, numbers), constants(22, numbers), strict=True)
    ]
    keys = np.empty((len(cuts), 2 * halves), np.uint64)
    for h in range(2 * halves):
        key = np.full(len(cuts), h + 1, np.uint64)
        for r in range(ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[h * ROWS + r])
        keys[:, h] = key
    return keys.view(np.int64)


def marks_of(items: np.ndarray) -> bytes:
    """One byte of each of the ``MARKS`` further minhashes of a non-empty set."""
    least = np.full(MARKS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(items), 4096):
        part = items[a : a + 4096, None] * _MARK_FACTORS + _MARK_OFFSETS
        least = np.minimum(least, (part >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint8).tobytes()


def least_agreeing(percent: int) -> int:
    """Marks that two sets of the least similarity share almost surely."""
    mean = MARKS * percent / 100
    return max(0, int(mean - DEVIATIONS * (mean * (1 - percent / 100)) ** 0.5))


def sketches(documents: DataFrame, words: int, halves: int) -> DataFrame:
    """Set size, fingerprint and half keys of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            for first, texts in slices(batch["text"]):
                sets = distinct_sets(texts, words)
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                us: list = [None] * len(sets)
                vs: list = [None] * len(sets)
                if len(full):
                    cuts = np.cumsum([0, *sizes[full][:-1]])
                    keys = half_keys(np.concatenate([sets[k] for k in full]), cuts, halves)
                    for k, row in zip(full, keys, strict=True):
                        us[k], vs[k] = row[:halves], row[halves:]
                yield pd.DataFrame(
                    {
                        "doc_id": ids[first : first + len(texts)],
                        "n_shingles": sizes,
                        "print1": [mix(s).sum(dtype=np.uint64).view(np.int64) for s in sets],
                        "print2": [mix(~s).sum(dtype=np.uint64).view(np.int64) for s in sets],
                        "us": us,
                        "vs": vs,
                    }
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.filter("doc_id IS NOT NULL").mapInPandas(run, SKETCH)


def picked(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among ``ids`` (one column of that name, staged, distinct)."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, key, "left_semi")


def sets_of(documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(node, items, marks) of the documents named by ``ids``: whole sets, hashed again from the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            nodes = batch["node"].to_numpy()
            for first, texts in slices(batch["text"]):
                sets = distinct_sets(texts, words)
                yield pd.DataFrame(
                    {
                        "node": nodes[first : first + len(texts)],
                        "items": [s.view(np.int64) for s in sets],
                        "marks": [marks_of(s) for s in sets],
                    }
                )

    rows = documents.select(F.col("doc_id").cast("long").alias("node"), F.col("text"))
    return picked(rows, ids, "node").mapInPandas(run, SETS)


def similar(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union of two sets."""
    shared = F.size(F.array_intersect(a, b))
    return shared * 100 >= (F.size(a) + F.size(b) - shared) * percent


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(similar(F.col("items_a"), F.col("items_b"), percent))
        .select("a", "b")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b); the component is its smallest node.

    Rounds of smallest neighbour and pointer jumping, each written to the shared folder, until no
    label changes. A node with very many neighbours is one skewed join key and one pre-aggregated
    minimum, both of which Spark splits.
    """
    both = staged(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "near-dup-links",
    )
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("node")).alias("component")
        ),
        "near-dup-labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("above"))
        after = staged(
            nearer.join(up, "component", "left").select(
                "node", "old", F.least("component", F.coalesce("above", "component")).alias("component")
            ),
            "near-dup-labels",
        )
        changed = after.filter("component <> old").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels


def links_around_pivots(
    homes: DataFrame, classes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int
) -> DataFrame:
    """Links between classes of one pivot (``homes``: node, home) that lie in different components.

    A pivot's classes are dealt to blocks, those of its largest component apart from the others; blocks
    are compared in pairs, except two of the largest component. A comparison returns only links that
    connect what it has not connected yet, so never more than its rows.
    """
    rows = (
        homes.join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(classes.select("node", "n_shingles"), "node")
    )
    sizes = rows.groupBy("home", "component").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")
    )
    # What a component needs: its rows and its shingles in blocks.
    need = F.greatest(F.col("n") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)
    open_homes = (
        sizes.withColumn("need", need)
        .groupBy("home")
        .agg(
            F.max_by("component", F.struct("n", -F.col("component"))).alias("largest"),
            F.max_by("need", F.struct("n", -F.col("component"))).alias("inside"),
            F.sum("need").alias("all"),
            F.count("*").alias("components"),
        )
        .filter("components > 1")
        .select(
            "home",
            "largest",
            F.ceil("inside").cast("int").alias("large_blocks"),
            F.greatest(F.ceil(F.col("all") - F.col("inside")), F.lit(1)).cast("int").alias("blocks"),
        )
    )
    open_homes = staged(open_homes, "near-dup-open-homes")
    if open_homes.count() <= BROADCAST_IDS:
        open_homes = F.broadcast(open_homes)
    # Blocks 0 to blocks - 1 hold the other components, those from there on the largest one.
    in_largest = F.col("component") == F.col("largest")
    block = F.when(
        in_largest, F.col("blocks") + F.pmod(F.xxhash64("node"), F.col("large_blocks"))
    ).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks")))
    last = F.when(in_largest, F.col("blocks")).otherwise(F.col("blocks") + F.col("large_blocks"))
    dealt = (
        rows.join(open_homes, "home")
        .withColumn("block", block.cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), (last - 1).cast("int"))))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .join(sets, "node")
        .select("home", "low", "high", "block", "node", "component", "n_shingles", "marks", "items")
    )

    wanted = least_agreeing(percent)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", kind="stable").drop_duplicates("node")
        node, block, size = (group[c].to_numpy() for c in ("node", "block", "n_shingles"))
        names, place = np.unique(group["component"].to_numpy(), return_inverse=True)
        items = [np.asarray(x) for x in group["items"]]
        marks = np.frombuffer(b"".join(group["marks"]), np.uint8).reshape(len(group), -1)
        same = group["low"].iloc[0] == group["high"].iloc[0]
        joined = place.copy()
        found = []
        for k in range(len(node) - 1):
            ok = joined[k + 1 :] != joined[k]
            if not same:
                ok &= block[k + 1 :] != block[k]
            ok &= 100 * np.minimum(size[k + 1 :], size[k]) >= percent * np.maximum(size[k + 1 :], size[k])
            near = np.flatnonzero(ok) + k + 1
            agree = (marks[near] == marks[k]).sum(axis=1)
            for j in near[np.argsort(-agree, kind="stable")][: (agree >= wanted).sum()]:
                if joined[j] == joined[k]:
                    continue
                shared = len(np.intersect1d(items[k], items[j], assume_unique=True))
                if 100 * shared >= percent * (len(items[k]) + len(items[j]) - shared):
                    found.append((node[k], node[j]))
                    joined[joined == joined[j]] = joined[k]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("home", "low", "high").applyInPandas(run, "a long, b long")


def open_tables(keyed: DataFrame, homes: DataFrame, labels: DataFrame) -> DataFrame:
    """(crowd, node, home, component): the classes of the tables that are still to be compared.

    A table is open if classes of different pivots and components meet in it. The classes outside its
    largest pivot are its strangers; those of one pivot are compared by ``links_around_pivots``. Tables with
    the same largest pivot and the same strangers make one *crowd*, so a class has one row for all tables
    in which it meets the same strangers. Every pair of a crowd with a stranger in it meets in one of
    its tables.
    """
    rows = (
        keyed.join(homes, "node")
        .join(labels, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    by_home = rows.groupBy("key", "home").agg(
        F.count("*").alias("n"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("print1"),
        F.bit_xor(F.xxhash64("node", F.lit(2))).alias("print2"),
    )
    # Prints of all members; without those of the largest pivot they are the strangers' ones.
    by_key = by_home.groupBy("key").agg(
        F.max_by(F.struct("home", "print1", "print2"), F.struct("n", -F.col("home"))).alias("largest"),
        F.bit_xor("print1").alias("print1"),
        F.bit_xor("print2").alias("print2"),
        F.count("*").alias("homes"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    crowds = by_key.filter("homes > 1 AND low < high").select(
        "key",
        F.xxhash64(
            "largest.home",
            F.col("print1").bitwiseXOR(F.col("largest.print1")),
            F.col("print2").bitwiseXOR(F.col("largest.print2")),
        ).alias("crowd"),
    )
    return rows.join(crowds, "key").select("crowd", "node", "home", "component").distinct()


def candidates_in_tables(
    keyed: DataFrame,
    homes: DataFrame,
    classes: DataFrame,
    sets: DataFrame,
    labels: DataFrame,
    percent: int,
) -> DataFrame:
    """Pairs of classes of different pivots and components that meet in a table, each pair once.

    The classes of a crowd of tables are dealt to blocks of about ``TABLE_BLOCK``, and every pair of blocks is
    compared by itself. Many such comparisons share a task's group, since most crowds hold a few classes.
    A pair is returned if set sizes allow the similarity and enough marks agree.
    """
    rows = staged(open_tables(keyed, homes, labels), "near-dup-open")
    crowds = rows.groupBy("crowd").agg(F.count("*").alias("n"))
    crowds = staged(
        crowds.select("crowd", "n", F.ceil(F.col("n") / TABLE_BLOCK).cast("int").alias("blocks")),
        "near-dup-crowds",
    )
    amount = crowds.agg(F.coalesce(F.sum(F.col("n") * F.col("blocks")), F.lit(0))).first()[0]
    groups = amount // GROUP_ROWS + 1
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        rows.join(crowds, "crowd")
        .withColumn("block", block)
        .withColumn("other", other)
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .join(classes.select("node", "n_shingles"), "node")
        .join(sets.select("node", "marks"), "node")
        .withColumn("part", F.pmod(F.xxhash64("crowd", "low", "high"), F.lit(groups)))
        .select(
            "part", "crowd", "low", "high", "block", "node", "home", "component", "n_shingles", "marks"
        )
    )
    wanted = least_agreeing(percent)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["crowd", "low", "high", "node"], kind="stable")
        crowd, low, high, block, node, home, component, size = (
            group[c].to_numpy()
            for c in ("crowd", "low", "high", "block", "node", "home", "component", "n_shingles")
        )
        marks = np.frombuffer(b"".join(group["marks"]), np.uint8).reshape(len(group), -1)
        found = []
        # Rows of one comparison are neighbours: compare each row with the one ``step`` behind it.
        place = np.arange(len(group) - 1)
        step = 1
        while len(place):
            i, j = place, place + step
            place = i[(crowd[i] == crowd[j]) & (low[i] == low[j]) & (high[i] == high[j])]
            i, j = place, place + step
            ok = (component[i] != component[j]) & (home[i] != home[j])
            ok &= (low[i] == high[i]) | (block[i] != block[j])
            ok &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            i, j = i[ok], j[ok]
            ok = (marks[i] == marks[j]).sum(axis=1) >= wanted
            found.append(np.stack([node[i[ok]], node[j[ok]]], axis=1))
            step += 1
            place = place[place + step < len(group)]
        pairs = np.unique(np.concatenate([*found, np.zeros((0, 2), np.int64)]), axis=0)
        return pd.DataFrame(pairs, columns=["a", "b"])

    return dealt.groupBy("part").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``.

    Documents are linked at 100 * intersection >= percent * union of their shingle sets. NULL and
    empty texts have no shingles and no links. ``percent`` is 50 to 100 and sets the number of tables, so that
    a pair is missed with probability 1e-5 at most. Rows that share a doc_id are one document: a link of
    one holds for all (an empty one among them has none). Rows without doc_id are returned with their set size unknown (NULL), no
    component and kept. Other columns are not read. An empty table gives an empty result.
    """
    per_side = half_keys_for(percent)
    sketch = staged(sketches(documents, words, per_side), "near-dup-sketch")
    prints = ["n_shingles", "print1", "print2"]
    classes = staged(
        sketch.filter("n_shingles > 0")
        .groupBy(*prints)
        .agg(
            F.min("doc_id").alias("node"),
            F.min_by("us", "doc_id").alias("us"),
            F.min_by("vs", "doc_id").alias("vs"),
        ),
        "near-dup-classes",
    )
    halves = classes.select("node", F.posexplode("us").alias("at", "half")).union(
        classes.select("node", F.posexplode("vs").alias("at", "half")).withColumn(
            "at", F.col("at") + per_side
        )
    )
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).filter("n > 1").select("half")
    half = F.struct("at", "half")
    sides = (
        halves.join(shared, "half")
        .groupBy("node")
        .agg(
            F.collect_list(F.when(F.col("at") < per_side, half)).alias("us"),
            F.collect_list(F.when(F.col("at") >= per_side, half)).alias("vs"),
        )
    )
    tables = (
        sides.select("node", F.explode("us").alias("u"), "vs")
        .select("node", "u", F.explode("vs").alias("v"))
        .select("node", F.xxhash64("u.half", "v.half").alias("key"))
    )
    tables = staged(tables, "near-dup-tables")
    pivots = (
        tables.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("key", "pivot")
    )
    keyed = staged(tables.join(pivots, "key"), "near-dup-keyed")
    nearest = (
        keyed.groupBy("node", "pivot")
        .agg(F.count("*").alias("met"))
        .groupBy("node")
        .agg(
            F.max_by("pivot", F.struct(F.col("pivot") != F.col("node"), "met", -F.col("pivot"))).alias("home")
        )
    )
    homes = staged(nearest, "near-dup-homes")
    first = homes.filter("node <> home").select(F.col("home").alias("a"), F.col("node").alias("b"))
    # All classes that meet another: their full sets are needed once, for every step.
    ids = staged(keyed.select("node").distinct(), "near-dup-ids")
    sets = staged(sets_of(documents, ids, words), "near-dup-sets")
    links = staged(confirmed(first, sets, percent), "near-dup-confirmed")
    members = sketch.select("doc_id", *prints).join(
        classes.select(*prints, "node"), prints, "left"
    )
    members = staged(members.select("doc_id", "n_shingles", "node"), "near-dup-members")
    # Rows of one doc_id with different texts connect their classes.
    several = (
        members.groupBy("doc_id")
        .agg(F.min("node").alias("a"), F.max("node").alias("last"))
        .filter("a < last")
        .select("doc_id", "a")
    )
    split = (
        members.join(several, "doc_id").filter("node > a").select("a", F.col("node").alias("b"))
    )
    links = links.union(split)
    labels = components(links)
    # A pivot may have a pivot itself: its classes are compared with that one's.
    above = homes.select(F.col("node").alias("home"), F.col("home").alias("above"))
    homes = staged(
        homes.join(above, "home", "left").select(
            "node", F.coalesce("above", "home").alias("home")
        ),
        "near-dup-homes",
    )
    around = staged(
        links_around_pivots(homes, classes, sets, labels, percent), "near-dup-confirmed"
    )
    if not around.isEmpty():
        links = links.union(around)
        labels = components(links)
    rest = staged(
        candidates_in_tables(
            keyed.select("node", "key"), homes, classes, sets, labels, percent
        ),
        "near-dup-rest",
    )
    if not rest.isEmpty():
        more = confirmed(rest, sets, percent)
        links = links.union(staged(more, "near-dup-confirmed"))
        labels = components(links)
    found = (
        members.join(labels, "node", "left")
        .withColumn("component_id", F.coalesce("component", "node", "doc_id"))
        .select("doc_id", "n_shingles", "component_id")
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
    nameless = documents.filter("doc_id IS NULL").select(
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("n_shingles"),
        F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept"),
    )
    return found.union(nameless)


def one_of_each(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` that stay when one document of each group does, all columns kept.

    Columns may have any name. Rows without id and texts without words stay. Rows of one doc_id are one document and stay
    or go together. An empty table stays empty.
    """
    found = near_duplicates(documents, words, percent)
    gone = staged(found.filter("NOT kept").select("doc_id").distinct(), "near-dup-gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    gone = gone.withColumnRenamed("doc_id", "gone_id")
    return documents.join(gone, documents["doc_id"].cast("long") == gone["gone_id"], "left_anti")
