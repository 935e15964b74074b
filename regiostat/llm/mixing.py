"""Mixing sources to target weights by the cube method.

Every document of a source may be taken ``target / source size`` times: the whole part for sure,
the fraction by chance. The cube method moves the fractions of three documents at a time along the
null space of two constraints, the number of documents and the number of words, until one of them
is 0 or 1; both totals stay exactly as they are. This *flight* runs in blocks of a source. Each block
leaves at most two open fractions, which form the blocks of the next round, so after a few rounds a
source has at most two. The *landing* rounds those so that the words come nearest to the target.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.llm.common import staged
from regiostat.llm.word_arrays import MASK, splitmix

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
#: Documents in a block of the flight.
BLOCK_ROWS = 2048
EPSILON = 1e-9

STATE = "rank int, doc_id long, size long, tie long, base int, p double, open boolean, taken_copies int"


def word_count(text: str) -> Column:
    """Number of runs of other characters than [\\x20\\x09-\\x0D]; none for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """(source, rank, source_size, n, target) of every source of ``sizes`` (source, size).

    Sources by code point, NULL last, get the weights in turn and share ``share`` of all words. A
    target stops at ``most`` times its source's size; what it leaves is shared by the others. With
    sources by size per weight, that is one level of words per weight, found with running sums over
    the sources (one row each).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
    )
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    level = (
        F.lit(share) * F.sum("source_size").over(Window.partitionBy())
        - F.coalesce(
            F.sum("cap").over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
    ) / F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))
    levels = (
        sources.withColumn("level", level)
        .withColumn("place", F.row_number().over(by_need))
        .withColumn("fits", F.col("level") <= F.col("cap") / F.col("weight"))
        .withColumn(
            "common",
            F.min_by(F.when(F.col("fits"), F.col("level")), F.when(F.col("fits"), F.col("place"))).over(
                Window.partitionBy()
            ),
        )
    )
    target = F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight"))
    return levels.select(
        "source", "rank", "source_size", "n", F.coalesce(target, F.col("cap").cast("double")).alias("target")
    )


def chance(tie: int, step: int) -> float:
    """A number in [0, 1) that depends on a document and a step only."""
    return splitmix((tie ^ (step * 0x9E3779B97F4A7C15)) & MASK) / (MASK + 1)


def direction(a: float, b: float, c: float | None) -> tuple[float, ...] | None:
    """A vector along which neither the count nor the words of two or three documents change."""
    if a == b:
        return (1.0, -1.0, 0.0)
    if c is None:
        return None
    return (b - c, c - a, a - b)


def flight(p: np.ndarray, size: np.ndarray, tie: np.ndarray, seed: int) -> np.ndarray:
    """Moves the fractions ``p`` until at most two are left; counts and words stay the same."""
    p = p.astype(float).tolist()
    sizes, ties = size.tolist(), tie.tolist()
    waiting = iter([k for k in range(len(p)) if EPSILON < p[k] < 1 - EPSILON])
    active: list[int] = []
    step = seed
    while True:
        active += itertools.islice(waiting, 3 - len(active))
        active = [k for k in active if EPSILON < p[k] < 1 - EPSILON]
        if len(active) < 3:
            more = next(waiting, None)
            if more is not None:
                active.append(more)
                continue
        if len(active) < 2:
            break
        third = sizes[active[2]] if len(active) == 3 else None
        u = direction(sizes[active[0]], sizes[active[1]], third)
        if u is None:
            break
        moves = [(p[k], v) for k, v in zip(active, u) if v]  # noqa: B905
        up = min((1 - q) / v if v > 0 else -q / v for q, v in moves)
        down = min(q / v if v > 0 else (q - 1) / v for q, v in moves)
        step += 1
        go = up if chance(ties[active[0]], step) * (up + down) < down else -down
        for k, v in zip(active, u):  # noqa: B905
            moved = p[k] + go * v
            p[k] = 0.0 if moved < EPSILON else 1.0 if moved > 1 - EPSILON else moved
    return np.array(p)


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the few open fractions so that the words change least, then the count."""
    open_ = np.flatnonzero((p > EPSILON) & (p < 1 - EPSILON))
    best = min(
        itertools.product((0.0, 1.0), repeat=len(open_)),
        key=lambda r: (
            abs(float(((np.array(r) - p[open_]) * size[open_]).sum())),
            abs(float((np.array(r) - p[open_]).sum())),
            r,
        ),
    )
    p = p.copy()
    p[open_] = best
    return p


def _block(group: pd.DataFrame) -> pd.DataFrame:
    """One block's flight; a source's only block also lands."""
    group = group.sort_values(["tie", "doc_id", "size"], kind="stable", na_position="last")
    size = group["size"].to_numpy()
    p = flight(group["p"].to_numpy(), size, group["tie"].to_numpy(), int(group["round"].iloc[0]) << 32)
    if group["blocks"].iloc[0] == 1:
        p = landing(p, size)
    done = (p <= EPSILON) | (p >= 1 - EPSILON)
    group["p"], group["open"] = p, ~done
    group["taken_copies"] = group["base"] + np.where(done, np.round(p), 0).astype(int)
    return group[["rank", "doc_id", "size", "tie", "base", "p", "open", "taken_copies"]].astype(
        {"rank": "int32", "base": "int32", "taken_copies": "int32"}
    )


def mixture(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, tie) for every row of ``documents``.

    ``copies`` says how often the mix takes the document, ``taken`` how many words that makes;
    ``tie`` is a hash of the row's text. A NULL source is a source of its own, after all others. NULL
    and empty texts have size 0 and take no words. Draws depend on doc_id, size and text only, so
    reruns agree; rows equal in these are drawn one by one. An empty table gives an empty result.
    """
    rows = staged(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            word_count("text").alias("size"),
            F.xxhash64(F.col("doc_id").cast("long"), "text").alias("tie"),
        ),
        "mix-sizes",
    )
    sources = staged(source_targets(rows, weights, share, most), "mix-sources")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = sources.select(F.col("source").alias("name"), "rank", "source_size", "target")
    state = rows.join(named, rows["source"].eqNullSafe(named["name"])).select(
        "rank",
        "doc_id",
        "size",
        "tie",
        F.floor(copies).cast("int").alias("base"),
        (copies - F.floor(copies)).alias("p"),
    )
    counts = sources.select("rank", "n")
    decided, step = [], 0
    while True:
        blocks = counts.select("rank", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
        dealt = (
            state.join(blocks, "rank")
            .withColumn("block", F.pmod(F.xxhash64("tie", F.lit(step)), F.col("blocks")))
            .withColumn("round", F.lit(step))
        )
        moved = staged(dealt.groupBy("rank", "block").applyInPandas(_block, STATE), "mix-flight")
        decided.append(moved.filter("NOT open"))
        state = moved.filter("open").select("rank", "doc_id", "size", "tie", "base", "p")
        if state.isEmpty():
            break
        counts = state.groupBy("rank").agg(F.count("*").alias("n"))
        step += 1
    whole = decided[0]
    for more in decided[1:]:
        whole = whole.union(more)
    return whole.join(sources.drop("source", "n"), "rank").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("taken_copies")).alias("taken"),
        F.col("taken_copies").alias("copies"),
        "tie",
    )


#: Decisions are broadcast to the documents up to so many rows; beyond that Spark shuffles.
BROADCAST_ROWS = 500_000


def mixed(documents: DataFrame, **settings) -> DataFrame:
    """The rows of ``documents`` as often as the mix takes them, with all their columns.

    Rows that agree in doc_id and text all get the rounded mean of their draws. Columns may have any name. NULL ids,
    texts and sources are drawn as ``mixture`` says; an empty table stays empty.
    """
    drawn = mixture(documents, **settings)
    copies = staged(
        drawn.groupBy("tie").agg(F.round(F.avg("copies")).cast("int").alias("copies")).filter("copies > 0"),
        "mix-copies",
    )
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    # The columns of the table stay together under one name, whatever they are called.
    own = documents.columns
    rows = documents.select(
        F.struct(*[documents[c] for c in own]).alias("row"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("tie")
    )
    repeated = rows.join(copies, "tie").withColumn("copy", F.explode(F.array_repeat(F.lit(True), F.col("copies"))))
    return repeated.select(*[F.col("row")[c].alias(c) for c in own])
