"""Merkle manifest of a dataset: a hash tree for each source, one above them, a proof for every document.

Leaves of a source stand in ascending doc_id and are hashed in runs of ``FANOUT``, and so are the runs until
one hash is left, the top. The tops, ordered by source, are the leaves of the root tree. A proof is the list
of siblings from a leaf to the root.

Proofs come by pointer jumping. Every inner node starts with a pointer to its parent and, as its segment,
the siblings beside it. A round joins the table with itself on the pointer: the pointer of the node ahead
becomes the new one and its segment is put behind the own. The distance doubles, so a tree of
twelve levels takes four rounds. The leaves, fifteen sixteenths of all nodes, make the last jump only: from
their run, whose segment reaches the root by then.

Only DataFrame functions are used. No join has a hot key: at distance d at most ``FANOUT`` ** d nodes share a
pointer, and nodes that point at the root take no further part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import fold, staged
from regiostat.llm.ordering import group_offsets, in_order

FANOUT = 16
#: Characters of a hash in hex.
DIGEST = 64
#: Documents whose crc32 this divides are tampered with in the check of the proofs.
TAMPERED = 5
#: The tree above the sources; those are trees 0, 1, ...
ROOT_TREE = -1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ID = ["tree", "level", "idx"]
NODE = "tree long, level int, idx long"
STEPS = "array<struct<left:string,right:string>>"
PATHS = f"{NODE}, up_tree long, up_level int, up_idx long, reached string, subroot string, steps {STEPS}"


def field(c: Column) -> Column:
    """Byte count, colon and value, so that no two records give one text; ``-`` for NULL."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    """Hash of a document with ``text`` for its text."""
    others = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.concat(*others, field(text)), 256)


def leaves(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves at their place, and (.., n, tree, sources) of every part of a source.

    A leaf is (doc_id, hash, tampered, tree, place, n, sources): its place among the ``n`` leaves of its
    source, which is number ``tree`` of all ``sources``.
    """
    lowered = leaf_hash(F.translate("text", UPPER, LOWER))
    hashed = documents.select(
        "source", "doc_id", leaf_hash(F.col("text")).alias("hash"),
        F.when(fold("doc_id", TAMPERED) == 0, lowered).alias("tampered"),
    )
    # Staged, as a range shuffle runs what stands below it twice: texts are read and hashed once.
    placed = in_order(staged(hashed, "merkle-leaves"), "source", "doc_id", "hash")
    offsets = group_offsets(placed, ["source"])
    # Sources get their number in the same way: there may be many.
    sources = in_order(offsets.select("source").distinct(), "source")
    numbered = sources.join(group_offsets(sources, []), "part").select(
        F.col("source").alias("name"), (F.col("at") + F.col("before")).alias("tree"),
        F.col("n").alias("sources"),
    )
    parts = offsets.join(numbered, F.col("source").eqNullSafe(F.col("name"))).select(
        "name", F.col("part").alias("range"), "first", "before", "n", "tree", "sources"
    )
    parts = staged(parts, "merkle-sources")
    here = F.col("source").eqNullSafe(F.col("name")) & (F.col("part") == F.col("range"))
    placed = placed.join(parts, here).select(
        "doc_id", "hash", "tampered", "tree",
        (F.col("at") - F.col("first") + F.col("before")).alias("place"), "n", "sources",
    )
    return placed, parts


def runs(nodes: DataFrame, level: int, *payload: str) -> DataFrame:
    """Parents of a row of nodes: runs of ``FANOUT`` by place, the members of each in an array.

    Nodes are (tree, place, n, sources, hash) and what of them is to be kept; a parent has the same, its id, and the
    hashes of its members as one text. A group has ``FANOUT`` rows at most.
    """
    slot = F.pmod("place", F.lit(FANOUT)).cast("int").alias("slot")
    idx = F.floor(F.col("place") / FANOUT).alias("idx")
    grouped = nodes.groupBy("tree", idx).agg(
        F.sort_array(F.collect_list(F.struct(slot, "hash", *payload))).alias("members"),
        F.first("n").alias("n"), F.first("sources").alias("sources"),
    )
    hashes = F.array_join("members.hash", "")
    return grouped.select(
        "tree", F.lit(level).alias("level"), "idx", F.col("idx").alias("place"),
        F.ceil(F.col("n") / FANOUT).alias("n"), "sources", F.sha2(hashes, 256).alias("hash"),
        hashes.alias("hashes"), "members",
    )


def beside(hashes: Column, slot: Column) -> Column:
    """The other hashes of a run: those left of ``slot`` and those right of it."""
    cut = slot * DIGEST
    return F.struct(
        F.substring(hashes, F.lit(1), cut).alias("left"),
        F.substring(hashes, cut + DIGEST + 1, F.length(hashes)).alias("right"),
    )


def _first_paths(parents: DataFrame, tops: bool) -> DataFrame:
    """Every member with its pointer to the parent; ``tops``: members are tops of sources."""
    return parents.select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"),
        F.col("hash").alias("reached"), "hashes", F.explode("members").alias("m"),
    ).select(
        *[F.col(f"m.{c}").alias(c) for c in ID], "up_tree", "up_level", "up_idx", "reached",
        (F.col("m.hash") if tops else F.lit(None).cast("string")).alias("subroot"),
        F.array(beside(F.col("hashes"), F.col("m.slot"))).alias("steps"),
    )


def _members_in(parents: DataFrame, tree: Callable[[Column], Column]) -> DataFrame:
    """Names the tree of every member: that of its run inside a source, its own in the root tree."""
    return parents.withColumn("members", F.transform("members", lambda m: m.withField("tree", tree(m))))


def height(n: int) -> int:
    """Levels of runs above a row of n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def jumped(paths: DataFrame, root: tuple[int, int, int], longest: int) -> DataFrame:
    """Paths of all inner nodes up to the root, by doubling; none has more than ``longest`` steps."""
    is_root = F.lit(True)
    for name, value in zip(ID, root, strict=True):
        is_root = is_root & (F.col(f"up_{name}") == value)
    distance = 1
    while distance < longest:
        ahead = paths.select(
            *[F.col(c).alias(f"at_{c}") for c in ID],
            *[F.col(c).alias(f"next_{c}") for c in paths.columns if c not in ID],
        )
        match = [F.col(f"up_{c}") == F.col(f"at_{c}") for c in ID]
        joined = paths.filter(~is_root).join(ahead, match).select(
            *ID, *[F.col(f"next_up_{c}").alias(f"up_{c}") for c in ID],
            F.col("next_reached").alias("reached"),
            F.coalesce("subroot", "next_subroot").alias("subroot"),
            F.concat("steps", "next_steps").alias("steps"),
        )
        paths = staged(joined.unionByName(paths.filter(is_root)), "merkle-paths")
        distance *= 2
    return paths


def manifest(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, steps, tampered): the proof of every document.

    ``steps`` holds, level by level, the hashes left and right of the path; ``folded`` rebuilds the root from
    a leaf and its steps. ``tampered`` is the leaf of the changed text for the documents of the check, else NULL.

    NULL in a column is hashed as ``-``. A NULL doc_id stands before the others of its source, a NULL source before all
    others. Rows of one doc_id are ordered by their hash, and each has its own leaf; columns that the leaf
    does not name take no part. A single document is its own root with an empty proof, and an empty table gives no row.
    """
    spark = documents.sparkSession
    placed, parts = leaves(documents)
    sizes = parts.agg(F.max("n").alias("n"), F.max("sources").alias("sources")).first()
    source_levels, root_levels = height(sizes["n"] or 0), height(sizes["sources"] or 0)

    lone = placed.filter("n = 1").select(
        "tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("idx"), "place", "n", "sources", "hash",
        F.col("hash").alias("hashes"),
        F.array(F.struct(F.lit(0).alias("slot"), "hash", "doc_id", "tampered")).alias("members"),
    )
    bottom = runs(placed.filter("n > 1"), 1, "doc_id", "tampered")
    bottom = staged(bottom.unionByName(lone), "merkle-runs")
    narrow = [*ID, "place", "n", "sources", "hash"]
    row, tops = bottom.select(narrow), []
    first_paths = [spark.createDataFrame([], PATHS)]
    for level in range(2, source_levels + 1):
        tops.append(row.filter("n = 1"))
        parents = staged(runs(row.filter("n > 1"), level, "level", "idx"), "merkle-level")
        row = parents.select(narrow)
        parents = _members_in(parents, lambda m: F.col("tree"))
        first_paths.append(_first_paths(parents, tops=False))
    row = reduce(DataFrame.unionByName, tops, row).select(
        F.lit(ROOT_TREE).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("sources").alias("n"),
        "sources", "hash", F.col("tree").alias("own_tree"), "level", "idx",
    )
    for level in range(1, root_levels + 1):
        parents = staged(runs(row, level, "own_tree", "level", "idx"), "merkle-level")
        parents = _members_in(parents, lambda m: m["own_tree"])
        first_paths.append(_first_paths(parents, tops=level == 1))
        row = parents.select(narrow).withColumn("own_tree", F.col("tree"))

    root = (ROOT_TREE, root_levels, 0) if root_levels else (0, source_levels, 0)
    paths = staged(reduce(DataFrame.unionByName, first_paths), "merkle-paths")
    paths = jumped(paths, root, max(source_levels - 1, 0) + root_levels)
    above = paths.select(*ID, "reached", F.col("subroot").alias("top"), F.col("steps").alias("rest"))
    none = F.array().cast(STEPS)
    own = F.when(F.col("level") > 0, F.array(beside(F.col("hashes"), F.col("m.slot")))).otherwise(none)
    reached = F.coalesce("reached", "hash")
    return bottom.join(above, ID, "left").select(
        "level", "hashes", "rest", reached.alias("root"), F.coalesce("top", reached).alias("subroot"),
        F.explode("members").alias("m"),
    ).select(
        F.col("m.doc_id").alias("doc_id"), F.col("m.hash").alias("leaf"), "subroot", "root",
        F.concat(own, F.coalesce("rest", none)).alias("steps"), F.col("m.tampered").alias("tampered"),
    )


def folded(leaf: Column, steps: str) -> Column:
    """Root that a leaf and the siblings of its path lead to."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def checked_manifest(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document.

    ``proof_sha256`` is the hash of all siblings of the proof, left to right and level by level. ``folded_root`` comes
    from the tampered leaf where there is one. See ``manifest`` for NULLs and repeated rows.
    """
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    proofs = manifest(documents).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), "steps").alias("folded_root"),
    )
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
