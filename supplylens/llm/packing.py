"""Best-fit packing of documents into training sequences, with conflicts.

A document longer than a sequence is cut into full sequences and a rest. Pieces are packed largest first: the
open bins of a group stand ordered by residual room, each with a bitmap of the duplicate clusters and two of
the sources in it. A piece goes to the tightest bin that fits; where that one conflicts, the search goes on to
the next larger residual, until a compatible bin is found or a new one is opened. Groups are dealt by a hash of
the document, so a hot source or cluster is spread over all of them and each holds a bounded number of pieces.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import lower_ascii, word_count

#: Pieces of a group, on average.
GROUP = 8192


def best_fit(size: list[int], source: list[int], cluster: list[int], capacity: int) -> list[int]:
    """Bin number of each piece, pieces given largest first.

    At most one piece of a cluster and two of a source go into one bin; identity is by bit of a bitmap of any length.
    """
    order: list[tuple[int, int]] = []  # (residual, bin), tightest first
    clusters: list[int] = []
    once: list[int] = []
    twice: list[int] = []
    out = []
    for need, src, dup in zip(size, source, cluster):
        if need >= capacity:
            out.append(len(clusters))
            clusters.append(dup)
            once.append(src)
            twice.append(0)
            continue
        at = bisect_left(order, (need, -1))
        while at < len(order):
            bin_ = order[at][1]
            if not (clusters[bin_] & dup or twice[bin_] & src):
                break
            at += 1
        if at < len(order):
            room, bin_ = order.pop(at)
        else:
            room, bin_ = capacity, len(clusters)
            clusters.append(0)
            once.append(0)
            twice.append(0)
        clusters[bin_] |= dup
        twice[bin_] |= once[bin_] & src
        once[bin_] |= src
        if room > need:
            insort(order, (room - need, bin_))
        out.append(bin_)
    return out


def one_hot(keys: pd.Series, limit: int) -> list[int]:
    """A bit of its own for each key that occurs more than ``limit`` times, no bit for one that cannot conflict."""
    code, _ = pd.factorize(keys, use_na_sentinel=False)
    often = np.bincount(code)[code] > limit
    number, _ = pd.factorize(code[often])
    out = np.zeros(len(code), dtype=object)
    out[often] = [1 << n for n in number.tolist()]
    return out.tolist()


def packed(
    docs: DataFrame,
    capacity: int = 2048,
    size: Column | None = None,
    cluster: Column | None = None,
    group: int = GROUP,
) -> DataFrame:
    """Bin of each piece: doc_id, source, piece, start, size, bin_group, bin, used.

    ``piece`` counts the parts of a document from 0, ``start`` is its first word, ``size`` its words, ``used`` the
    words of the whole bin. ``size`` defaults to the words of ``text``, ``cluster`` to a hash of the lower-cased text.
    Nulls: a null or empty text has no words, so the document has no piece and no row; a null source is a source of
    its own; a null doc_id is a document like any other. Repeated rows are separate documents of one cluster, so
    they never share a bin. An empty table gives an empty table. Other columns are not carried.
    """
    base = docs.select(
        "doc_id",
        "source",
        (word_count(F.col("text")) if size is None else size).alias("_size"),
        (F.xxhash64(lower_ascii(F.col("text"))) if cluster is None else cluster).alias("_cluster"),
    )
    counted = base.agg(F.sum(F.ceil(F.col("_size") / capacity))).first()[0] or 0
    groups = max(1, -(-int(counted) // group))
    last = (F.ceil(F.col("_size") / capacity) - 1).cast("int")
    pieces = base.where(F.col("_size") > 0).withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    pieces = pieces.select(
        "doc_id",
        "source",
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("_size") - F.col("piece").cast("long") * capacity).alias("size"),
        F.pmod(F.xxhash64("doc_id", "piece", "_cluster", F.lit(7)), F.lit(groups)).cast("int").alias("bin_group"),
        F.xxhash64("_cluster").alias("_c"),
    )

    def pack(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values(["size", "doc_id", "piece", "source"], ascending=[False, True, True, True], kind="stable")
        bins = best_fit(d["size"].tolist(), one_hot(d["source"], 2), one_hot(d["_c"], 1), capacity)
        d["bin"] = np.array(bins, dtype=np.int64)
        d["used"] = d.groupby("bin")["size"].transform("sum")
        return d[["doc_id", "source", "piece", "start", "size", "bin_group", "bin", "used"]]

    schema = "doc_id long, source string, piece int, start long, size long, bin_group int, bin long, used long"
    return pieces.groupBy("bin_group").applyInPandas(pack, schema)
