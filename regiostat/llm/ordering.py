"""Positions in a global order, without a window over the whole table or over a hot group."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiostat.llm.common import staged

#: monotonically_increasing_id holds the partition above this bit and the row of the partition below it.
ROW_BITS = 33


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """The table, written in ascending order of ``order`` (NULL first), with ``part`` and ``at``.

    ``part`` counts ranges of rows, ``at`` the rows of a range from 0. One shuffle by ranges of all columns of
    ``order``, so a group that holds most rows is spread over many tasks; rows equal in all of them
    share a task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()
    # One id for both columns: two calls would be two nondeterministic expressions.
    placed = ranged.withColumn("_row", row).select(
        *df.columns,
        F.shiftright("_row", ROW_BITS).cast("int").alias("part"),
        F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("at"),
    )
    return staged(placed, "in-order")


def group_offsets(placed: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, part, first, before, n): where a group starts in a range, rows before and in all of it.

    ``groups`` is a prefix of the order of ``placed``. There is one row for each group and range that
    holds it: at most as many as groups and ranges together, and a group has one for each range.
    """
    runs = placed.groupBy(*groups, "part").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    every = Window.partitionBy(*groups)
    earlier = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select(
        *groups, "part", "first",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(every).alias("n"),
    )


#: Rows of a block and the most blocks of ``with_previous``; beyond, blocks grow with the table.
BLOCK_ROWS = 256
MOST_BLOCKS = 1 << 14
#: Ends of blocks are looked up in groups of so many.
ENDS = 128


def block_ends(keys: DataFrame, order: Sequence[str]) -> tuple[str, str]:
    """(JSON array, its schema) of the highest key of every block, ascending.

    Keys are narrow. ``MOST_BLOCKS`` ends and one for each range of the shuffle reach the driver at most.
    """
    placed = in_order(staged(keys, "keys"), *order)
    rows = placed.count()
    every = max(BLOCK_ROWS, -(-rows // MOST_BLOCKS))
    key = F.struct(*order)
    last = placed.agg(F.max(key).alias("end")).filter("end IS NOT NULL")
    ends = placed.filter((F.col("at") + 1) % every == 0).select(key.alias("end")).union(last)
    listed = ends.agg(F.sort_array(F.collect_set("end")).alias("ends"))
    text = listed.select(F.to_json("ends").alias("text")).first()["text"]
    return text, listed.schema["ends"].dataType.simpleString()


def with_previous(
    df: DataFrame, order: Sequence[str], carried: Sequence[str], prefix: str
) -> DataFrame:
    """Every row with the ``carried`` columns of the row before it in ascending order of ``order``.

    NULL comes first; the row before the first is the last. Rows equal in all of ``order`` must be equal in
    ``carried``; they stand in any order.

    The table is cut into blocks of near equal row counts whose ends are known from the keys alone, and
    the last row of a block is copied to the next one. So wide rows are shuffled once, and no task holds more than its
    blocks.
    """
    # Constants of the plan, parsed once.
    text, schema = block_ends(df.select(*order), order)
    ends = F.from_json(F.lit(text), schema)
    coarse = F.from_json(F.lit(json.dumps(json.loads(text)[ENDS - 1 :: ENDS])), schema)
    key = F.struct(*order)
    # Ends below a key: first whole groups of ends, then those of its group.
    group = F.size(F.filter(coarse, lambda end: end < F.col("_key"))) * ENDS
    inside = F.filter(F.slice(ends, F.col("_group") + 1, ENDS), lambda end: end < F.col("_key"))
    own = F.struct(F.col("_block").alias("block"), F.lit(False).alias("copy"))
    ahead = F.struct(F.pmod(F.col("_block") + 1, F.size(ends)).alias("block"), F.lit(True).alias("copy"))
    is_end = F.get(ends, F.col("_block")).eqNullSafe(F.col("_key"))
    blocks = (
        df.withColumn("_key", key)
        .withColumn("_group", group)
        .withColumn("_block", F.col("_group") + F.size(inside))
        .select(*df.columns, F.explode(F.when(is_end, F.array(own, ahead)).otherwise(F.array(own))).alias("_at"))
        .select(*df.columns, "_at.*")
    )
    near = Window.partitionBy("block").orderBy(F.desc("copy"), *order)
    before = [F.lag(c).over(near).alias(f"{prefix}{c}") for c in carried]
    return blocks.select(*df.columns, "copy", *before).filter(~F.col("copy")).drop("copy")
