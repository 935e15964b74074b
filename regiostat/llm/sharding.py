"""Resharding by minimum-cost flow: from old shard sizes to new capacities with the fewest bytes moved.

The flow between old and new shards is solved from the shard totals; a byte that stays costs 0, a byte
that moves costs 1. Equal texts are one unit, wherever they lie, unless they hold more than a new shard may; only then
they are dealt to several units. Units of more than a small part of a shard are placed first, one by one,
in their own shard where it has room. The others lie side by side in each old shard, in the order
of their hash, and the flow cuts that order into stretches, one for each new shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiostat.llm.common import byte_size, staged

SHARDS = 16
OLD_SHARDS = 12
#: A unit above this part of a shard's bytes is placed by itself; with many shards the part is larger, so that
#: no more than ``MOST_LARGE`` units are.
UNITS_PER_SHARD = 256
MOST_LARGE = 1 << 16
#: A group with more than this part of a shard's rows is numbered in pieces.
PIECES_PER_SHARD = 64
#: Units in a block of the running sums.
BLOCK_UNITS = 1000
#: Old and new shards whose totals may pass through the driver.
MOST_SHARDS = 4096


def minimum_cost_flow(supply: dict[int, int], capacity: dict[int, int]) -> dict[tuple[int, int], int]:
    """Bytes to bring from each old to each new shard; supplies and capacities have the same sum.

    Keeping a byte in the shard of the same number is free, any other move costs 1 a byte. With these costs a flow is
    of least cost if every shard keeps what it has or what it may hold, whichever is less: no flow keeps
    more. What is left over and the room that is left are matched in the order of their numbers, so the
    whole takes one pass over the shards.
    """
    kept = {i: min(v, capacity.get(i, 0)) for i, v in supply.items()}
    flow = {(i, i): v for i, v in kept.items() if v}
    room = iter([(j, v - kept.get(j, 0)) for j, v in sorted(capacity.items()) if v > kept.get(j, 0)])
    j, free = next(room, (None, 0))
    for i in sorted(supply):
        left = supply[i] - kept[i]
        while left:
            amount = min(left, free)
            flow[i, j] = flow.get((i, j), 0) + amount
            left, free = left - amount, free - amount
            if not free:
                j, free = next(room, (None, 0))
    return flow


def place_large(
    units: Iterable[tuple[int, int, int]], capacity: dict[int, int]
) -> tuple[list[int], dict[int, int]]:
    """Shards of (bytes, old shard, ...) units, largest first, and the capacities left for the rest.

    Units stay in their shard as long as it has room; then the others, in the same order, go where most room is. A
    shard that is overfull then has no capacity left, and the others share what it holds too much.
    """
    units, room = list(units), dict(capacity)
    shards: list[int | None] = [None] * len(units)
    for k, (size, old, *_) in enumerate(units):
        if room.get(old, 0) >= size:
            room[old] -= size
            shards[k] = old
    heap = [(-v, j) for j, v in room.items()]
    heapq.heapify(heap)
    for k, (size, *_) in enumerate(units):
        if shards[k] is None:
            free, j = heap[0]
            heapq.heapreplace(heap, (free + size, j))
            room[j] -= size
            shards[k] = j
    over = -sum(v for v in room.values() if v < 0)
    left = {j: max(v, 0) for j, v in room.items()}
    # The level that the other shards are filled to falls by the same amount for all of them.
    open_ = sorted(v for v in left.values() if v)
    cut, below = 0, 0
    for k, v in enumerate(open_):
        cut = -(-(over - below) // (len(open_) - k))
        if cut <= v:
            break
        below += v
    for j in sorted(left):
        taken = min(left[j], cut, over)
        left[j], over = left[j] - taken, over - taken
    return shards, left


def capacities(total: int, shards: int) -> dict[int, int]:
    """Bytes of each new shard, at most one apart."""
    return {j: total // shards + (j < total % shards) for j in range(shards)}


def text_hash() -> Column:
    """Equal texts have equal hashes; NULL is a text of its own."""
    return F.xxhash64("text", F.col("text").isNull())


def resharded(documents: DataFrame, old_shard: Column, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard) of every row.

    ``old_shard`` gives the shard (a number) that a row lies in now; NULL counts as shard 0. The law
    is ``bytes``: new shards have near equal bytes. Equal texts go to one shard, unless they hold more than it may. A
    size is the text's UTF-8 bytes plus 1; NULL texts have size 1 and checksum 0. Slots number the rows of a shard without gaps. Repeated rows are
    rows of their own. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (byte_size("text") + 1).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        text_hash().alias("h"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old_shard"),
    )
    rows = staged(rows, "shard-rows")
    found = rows.groupBy("old_shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    found = found.limit(MOST_SHARDS + 1).collect()
    if max(len(found), shards) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards")
    total = sum(r["bytes"] for r in found)
    many = max(1, sum(r["n"] for r in found) // (shards * PIECES_PER_SHARD))
    room = capacities(total, shards)
    small = max(1, total // (shards * min(UNITS_PER_SHARD, max(1, MOST_LARGE // shards))))

    # Equal texts of all old shards belong together; most of their bytes name their home.
    group = ["h", "text_crc32"]
    groups = rows.groupBy(*group).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    is_huge, is_many = F.col("bytes") > max(room.values(), default=0), F.col("n") > many
    # Fewer than ``shards`` groups are larger than a shard, fewer than ``shards * PIECES_PER_SHARD`` have many rows.
    special = groups.filter(is_huge | is_many).select(
        *group, F.when(is_huge, F.ceil(F.col("bytes") / small)).alias("parts"),
        F.when(is_many, F.ceil(F.col("n") / many)).alias("pieces"),
    )
    # Huge groups are split anyway, so what lies in one old shard is kept apart from what lies in others. The
    # rows of a large group go to one shard, but are numbered in pieces.
    whole = F.col("parts").isNull()
    rows = rows.join(F.broadcast(special), group, "left").withColumns(
        {
            "part": F.when(whole, 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts"))),
            "lot": F.when(whole, -1).otherwise(F.col("old_shard")),
            "piece": F.pmod(F.xxhash64("doc_id", F.lit(1)), F.coalesce("pieces", F.lit(1).cast("long"))),
        }
    )
    unit = [*group, "part", "lot"]
    rows = staged(rows.drop("parts", "pieces"), "shard-rows")
    here = rows.groupBy("old_shard", *unit).agg(F.sum("size").alias("bytes"))
    units = here.groupBy(*unit).agg(
        F.max_by("old_shard", F.struct("bytes", -F.col("old_shard"))).alias("old_shard"),
        F.sum("bytes").alias("bytes"),
    )
    units = staged(units, "shard-units")
    # Fewer than ``MOST_LARGE`` units, or ``shards``, are larger than a small one.
    large = units.filter(F.col("bytes") > small).orderBy(F.desc("bytes"), *unit)
    large = [(r["bytes"], r["old_shard"], *(r[c] for c in unit)) for r in large.collect()]
    chosen, room = place_large(large, room)
    fixed = spark.createDataFrame(
        [(*row[2:], shard) for row, shard in zip(large, chosen, strict=True)],
        "h long, text_crc32 long, part long, lot int, shard int",
    )
    rest = units.filter(F.col("bytes") <= small)
    sizes = {r[0]: r[1] for r in rest.groupBy("old_shard").agg(F.sum("bytes")).collect()}
    blocks = max(1, units.count() // (max(1, len(sizes)) * BLOCK_UNITS))
    block = F.pmod(F.shiftrightunsigned("h", 16), F.lit(blocks))

    flow = minimum_cost_flow(sizes, room)
    stretches, at = [], dict.fromkeys(sizes, 0)
    for (i, j), amount in sorted(flow.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        stretches.append((i, j, at[i], at[i] + amount))
        at[i] += amount
    # At most one row for each old and each new shard.
    plan = spark.createDataFrame(stretches, "old_shard int, shard int, low long, high long")

    placed = running(rest.withColumn("block", block), ["old_shard"], ["block"], "bytes", "start")
    middle = F.col("start") + F.floor(F.col("bytes") / 2)
    placed = placed.join(F.broadcast(plan), "old_shard").filter(
        (middle >= F.col("low")) & (middle < F.col("high"))
    )
    columns = [*unit, "old_shard", "block", "shard"]
    alone = units.withColumn("block", block).join(F.broadcast(fixed), unit)
    placed = placed.select(*columns).unionByName(alone.select(*columns))
    pieces = rows.groupBy(*unit, "piece").agg(F.count("*").alias("n")).join(placed, unit)
    pieces = running(staged(pieces, "shard-pieces"), ["shard"], ["old_shard", "block"], "n", "first_slot", "piece")
    unit = [*unit, "piece"]
    within = Window.partitionBy(*unit).orderBy("doc_id", "size")
    return rows.join(pieces.select(*unit, "shard", "first_slot"), unit).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first_slot") + F.row_number().over(within) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def running(
    units: DataFrame, keys: list[str], order: list[str], amount: str, name: str, *last: str
) -> DataFrame:
    """Sum of ``amount`` over the units before each one, by block totals and then inside blocks."""
    every = [*keys, *order]
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        units.groupBy(*every)
        .agg(F.sum(amount).alias("in_block"))
        .withColumn("before", F.coalesce(F.sum("in_block").over(before), F.lit(0)))
        .drop("in_block")
    )
    inside = (
        Window.partitionBy(*every)
        .orderBy("h", "text_crc32", "part", *last)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        units.withColumn("inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(totals, every)
        .withColumn(name, F.col("before") + F.col("inside"))
        .drop("before", "inside")
    )


def rewrite_shards(spark: SparkSession, old: str, new: str, shards: int = SHARDS) -> DataFrame:
    """Brings a folder of ``shard=<n>`` Parquet folders to ``shards`` shards and returns the manifest.

    Only shards that lose or gain rows are written, to ``new``; the manifest (shard, path, rewritten)
    names the old folder of every other shard. Old files are never touched. All columns are kept as they are, under
    any name but ``shard``. NULL texts and ids, empty texts and repeated rows go with their row; a table
    without rows gives a manifest of empty shards.
    """
    documents = spark.read.parquet(old)
    own = [c for c in documents.columns if c != "shard"]
    moves = staged(resharded(documents, F.col("shard"), shards), "shard-moves")
    moved = moves.filter("old_shard <> shard").select("old_shard", "shard").distinct().collect()
    there = {r[0] for r in moves.select("old_shard").distinct().collect()}
    affected = {k for row in moved for k in row if k < shards} | {k for k in range(shards) if k not in there}
    key = ["doc_id", "size", "text_crc32", "old_shard"]
    targets = moves.filter(F.col("shard").isin(sorted(affected))).groupBy(*key).agg(
        F.sort_array(F.collect_list("shard")).alias("shards")
    )
    # The columns of the table stay together under one name, whatever they are called.
    rows = documents.select(
        F.struct(*[documents[c] for c in own]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), (byte_size("text") + 1).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.col("shard").cast("int"), F.lit(0)).alias("old_shard"), text_hash().alias("h"),
    )
    rows = rows.withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy("h")))
    on = [rows[k].eqNullSafe(targets[k]) for k in key]
    rows.join(targets, on).select(
        *[F.col("row")[c].alias(c) for c in own], F.element_at("shards", F.col("copy")).alias("shard")
    ).write.partitionBy("shard").parquet(new)
    manifest = [
        (k, f"{new if k in affected else old}/shard={k}", k in affected) for k in range(shards)
    ]
    return spark.createDataFrame(manifest, "shard int, path string, rewritten boolean")
