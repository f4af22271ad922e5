"""Mixing sources to target weights by the cube method.

Each document gets ``target / source size`` copies on average: the whole part is taken for sure, the fraction
is an inclusion probability. The flight phase moves the probabilities of a small set of documents along a null
vector of their constraints (one row of token sizes and one of document counts, within a source), until all
but as many documents as there are constraints are settled. Blocks of documents fly in parallel; what stays
open of a block is passed to a block of the next round, so every round leaves a small share, and the last few
documents of a source, fewer than its constraints, land together on the side that leaves its total nearer to
the target.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplylens.llm.common import word_count, written

EDGE = 1e-9
#: Documents that fly together in one block.
BLOCK = 4096


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Target words per source from its size: source, source_size, target.

    ``sizes`` has one row per source. Weights go round in the order of the sources by code point, null last.
    A target above ``most`` times its source is cut to that, and the excess is shared by weight among the
    others, again and again. Sorting by size per weight makes that a single pass: the sources that end at their
    limit are the first ones of that order.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") - 1) % len(weights) + 1)
    w = Window.orderBy(F.col("source_size") / F.col("_w"), "_n")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    onward = w.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0.0))
    level = left / F.sum("_w").over(onward)  # words per unit of weight if all sources before this one are full
    return (
        sizes.withColumn("_n", F.row_number().over(order))
        .withColumn("_w", weight)
        .withColumn("_full", F.col("source_size") * most <= level * F.col("_w"))
        .withColumn("_level", F.max(F.when(~F.col("_full"), level)).over(whole))
        .select(
            "source",
            "source_size",
            F.when(F.col("_full") | (F.col("source_size") == 0), F.col("source_size") * most)
            .otherwise(F.least(F.col("source_size") * most, F.col("_level") * F.col("_w")))
            .alias("target"),
        )
    )


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but two at most, with both totals kept.

    Three open documents always have a move that keeps the sum of p and of p * size; the move ends where the
    first of them reaches 0 or 1.
    """
    p = p.copy()
    open_ = [i for i in np.flatnonzero((p > EDGE) & (p < 1 - EDGE))]
    held: list[int] = []
    for i in open_:
        held.append(i)
        if len(held) < 3:
            continue
        a, b, c = held
        u = np.array([size[b] - size[c], size[c] - size[a], size[a] - size[b]], dtype=float)
        if not u.any():  # three equal sizes: any move of two of them keeps both totals
            u = np.array([1.0, -1.0, 0.0])
        x = p[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)).min()
            down = np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)).min()
        step = up if rng.random() * (up + down) < down else -down
        p[held] = np.clip(x + step * u, 0, 1)
        held = [j for j in held if EDGE < p[j] < 1 - EDGE]
    return np.where(p <= EDGE, 0.0, np.where(p >= 1 - EDGE, 1.0, p))


def _seed(values: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) if len(values) else 0


def _fly(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["_draw", "_row"], kind="stable").reset_index(drop=True)
    rng = np.random.default_rng(_seed(block["_draw"].to_numpy()))
    block["_p"] = flight(block["_p"].to_numpy(), block["size"].to_numpy(), rng)
    return block


def _land(last: pd.DataFrame) -> pd.DataFrame:
    """The few documents left of a source: the 0/1 choice whose words come nearest to what is expected."""
    last = _fly(last)
    p, size = last["_p"].to_numpy(), last["size"].to_numpy()
    at = np.flatnonzero((p > EDGE) & (p < 1 - EDGE))
    want = (p[at] * size[at]).sum()
    best = min(range(1 << len(at)), key=lambda m: (abs(sum(size[j] for k, j in enumerate(at) if m >> k & 1) - want), m))
    for k, j in enumerate(at):
        p[j] = float(best >> k & 1)
    last["_p"] = p
    return last


def mixed(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    size: Column | None = None,
    block: int = BLOCK,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Copies to take of each document: the columns doc_id, source, size, source_size, target, copies, taken.

    ``size`` defaults to the words of ``text``. Nulls: a null text has size 0, a null source is a source of its
    own, a null doc_id is a document like any other. Documents of size 0 get the sure copies alone and take no
    words; a source without words has the target 0. Repeated rows are separate documents. An empty table
    gives an empty table. Other columns are not carried, unless ``carry`` names them. The result depends on the rows alone, not on their order
    or partitioning.
    """
    own = [F.col(c) for c in ("doc_id", "source", *carry)]
    base = docs.select(*own, (word_count(F.col("text")) if size is None else size).alias("size"))
    base = written(base, "mix-sizes")
    goal = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = written(goal, "mix-targets").withColumnRenamed("source", "_source")  # one row per source
    # identical rows are told apart by a number, which no order of rows changes
    same = Window.partitionBy(*own, "size").orderBy(F.lit(1))
    rows = (
        base.withColumn("_row", F.row_number().over(same))
        .join(goal, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("_sure", F.floor("_rate").cast("int"))
        .withColumn("_p", F.when(F.col("size") == 0, 0.0).otherwise(F.col("_rate") - F.col("_sure")))
        .withColumn("_draw", F.xxhash64("source", "doc_id", "size", "_row", *carry))
        .drop("_rate")
    )
    is_open = (F.col("_p") > EDGE) & (F.col("_p") < 1 - EDGE)
    largest = rows.where(is_open).groupBy("source").count().agg(F.max("count")).first()[0] or 0
    schema, columns = rows.schema, rows.columns
    done, open_ = rows.where(~is_open).withColumn("_p", F.round("_p")), rows.where(is_open)
    while largest > block:
        parts = -(-largest // block)  # blocks of about `block` documents, of which each leaves two open
        fly = open_.groupBy("source", F.pmod("_draw", F.lit(parts)).alias("_b"))
        flown = written(fly.applyInPandas(lambda d: _fly(d[columns]), schema), "mix-flight")
        done, open_ = done.union(flown.where(~is_open)), flown.where(is_open)
        largest = 2 * parts
    done = done.union(open_.groupBy("source").applyInPandas(lambda d: _land(d[columns]), schema))
    copies = F.col("_sure") + F.round("_p").cast("int")
    taken = (F.col("size") * copies).alias("taken")
    return done.select(*own, "size", "source_size", "target", copies.alias("copies"), taken)
