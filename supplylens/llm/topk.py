"""Exact search for the largest inner products, by branch and bound over a vertical layout.

Vectors stand in chunks. A chunk holds its vectors column by column: the dimensions, those of most mass first, are cut
into blocks, next to the length of what each vector has left from every block on. A query adds up products block by
block. What the blocks to come can still add is bounded by the lengths of both remainders (Cauchy-Schwarz), so after
each block the vectors that can no longer reach the k-th best score known are dropped, and the columns of the next block
are gathered for the others alone. The first k-th best scores come from the longest vectors of the table; they and the
order of the dimensions decide the speed, never the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplylens.llm.common import written


@dataclass(frozen=True)
class Search:
    """``scale``: entries are floor(scale * x); ``width``: dimensions of a block; ``together``: queries that share the
    list of survivors; ``pilot``: long vectors that give the first thresholds, which bounds their speed only.

    ``chunk``: vectors of a chunk at most; ``cell``: vectors and ``entries``: entries of queries that meet in one task, on
    average.
    """

    scale: int = 256
    width: int = 8
    together: int = 32
    pilot: int = 512
    chunk: int = 4096
    cell: int = 16_384
    entries: int = 1 << 20


def whole_numbers(vectors: DataFrame, s: Search) -> DataFrame:
    """vec_id and v, floor(scale * x) of each entry x, of the rows that take part, once each."""
    rows = vectors.where("vec_id is not null and embedding is not null").select(
        F.col("vec_id").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("x")
    )
    fits = lambda x: F.abs(x) < float(2**62 // s.scale)  # so that the entry is a long; not so for NaN
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | ~fits(x))
    v = F.transform("x", lambda x: F.when(fits(x), F.floor(x * s.scale).cast("long")))
    rows = rows.where(~bad & (F.size("x") > 0)).select("vec_id", v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0)).distinct()


def remainders(v: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Length of what each vector (row) has left from every block on and after the last, rounded up."""
    mass = np.add.reduceat(v.astype(float) ** 2, cuts, axis=1)
    left = np.cumsum(mass[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([left, np.zeros((len(v), 1))])) * (1 + 1e-9)


@dataclass(frozen=True)
class Layout:
    """``order``: the dimensions by falling mass; ``most``: the largest entry; ``width``: dimensions of a block."""

    order: list[int]
    most: int
    width: int

    @property
    def cuts(self) -> list[int]:
        return list(range(0, len(self.order), self.width))

    @property
    def stored(self) -> str:
        return next((t for t, top in (("<i2", 2**15), ("<i4", 2**31)) if self.most < top), "<i8")

    def exact(self, v: np.ndarray) -> np.ndarray:
        """The entries as doubles where all sums of products are whole numbers below 2**53, else as Python integers."""
        return v.astype(float) if len(self.order) * self.most**2 < 2**53 else v.astype(object)

    def packed(self, v: np.ndarray) -> bytes:
        """Vectors (rows) column by column."""
        return np.ascontiguousarray(v.T.astype(self.stored)).tobytes()

    def columns(self, raw: bytes) -> np.ndarray:
        return self.exact(np.frombuffer(raw, self.stored).reshape(len(self.order), -1))


def vertical(rows: DataFrame, layout: Layout, s: Search) -> DataFrame:
    """ids, data (the vectors column by column) and left (remainders) of each chunk."""

    def cut(ids: list[np.ndarray], vectors: list[np.ndarray]) -> pa.RecordBatch:
        i, v = np.concatenate(ids), np.concatenate(vectors)
        values = [i.tobytes(), layout.packed(v), remainders(v, layout.cuts).T.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in values], ["ids", "data", "left"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, size = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, s.chunk - size)
                ids.append(np.asarray(part.column("vec_id")))
                vectors.append(np.asarray(part.column("v").flatten()).reshape(part.num_rows, -1)[:, layout.order])
                size += part.num_rows
                at += part.num_rows
                if size == s.chunk:
                    yield cut(ids, vectors)
                    ids, vectors, size = [], [], 0
        if size:
            yield cut(ids, vectors)

    return rows.mapInArrow(lay, "ids binary, data binary, left binary")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return np.array(sorted(at.tolist(), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)


def search_chunk(
    q: np.ndarray, own: np.ndarray, floor: np.ndarray, ids: np.ndarray, data: np.ndarray, left: np.ndarray, cuts: list[int], k: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[int]]:
    """Ids and scores of the best vectors of a chunk for each query (row of q), and how many were left in each block.

    ``floor``: a score that k vectors of the table reach at least, -inf if none is known. ``data``: dimensions x vectors;
    ``left``: their remainders, a row per block and one of zeros; ``cuts``: first dimension of each block.
    """
    rest = remainders(q, cuts)
    least = floor - 1e-12 * np.abs(floor)
    alive, sums, survivors = np.arange(len(ids)), 0, []
    for b, (first, last) in enumerate(zip(cuts, [*cuts[1:], len(data)])):
        survivors.append(len(alive))
        block = data[first:last] if len(alive) == len(ids) else data[first:last, alive]
        sums = sums + q[:, first:last] @ block
        bound = sums.astype(float) + rest[:, b + 1, None] * left[b + 1, alive]
        keep = (bound >= least[:, None]).any(axis=0)
        if not keep.all():
            alive, sums = alive[keep], sums[:, keep]
        if not len(alive):
            break
    out = []
    for i in range(len(q)):
        able = np.flatnonzero(ids[alive] != own[i])
        at = able[best(sums[i, able], ids[alive[able]], k)]
        out.append((ids[alive[at]], sums[i, at]))
    return out, survivors


def first_floors(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query (row of q) among the vectors x (rows) of other ids."""
    out = []
    for a in range(0, len(q), 1024):
        scores = (q[a : a + 1024] @ x.T).astype(float)
        scores[own[a : a + 1024, None] == ids[None, :]] = -np.inf
        out.append(np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) >= k else np.full(len(scores), -np.inf))
    return np.concatenate(out) if out else np.zeros(0)


def largest(vectors: DataFrame, is_query: Column, k: int = 5, s: Search = Search()) -> DataFrame:
    """The k largest inner products of each query with other vectors: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding; scores are whole numbers, of entries floor(256 x). Nulls: vectors that are null,
    empty or hold null or non-finite entries or ones beyond a long, those of another length than most, and rows without
    vec_id take no part, as queries or candidates. Repeated rows count once. Different vectors of one vec_id are a candidate
    each, never of each other, and as queries share one ranking. Ties go to the smaller vec_id. A score beyond a long is
    null and ranks last. An empty table gives an empty table. Other columns are not carried.
    """
    session = vectors.sparkSession
    rows = written(whole_numbers(vectors, s), "topk-rows")
    size = F.abs(F.col("x").cast("double"))
    entries = rows.select(F.posexplode("v").alias("j", "x")).groupBy("j")
    masses = entries.agg(F.sum(size * size).alias("mass"), F.max(F.abs("x")).alias("most")).collect()  # one row a dimension
    if not masses:
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = [r["j"] for r in sorted(masses, key=lambda r: (-r["mass"], r["j"]))]
    layout = Layout(order, max(r["most"] for r in masses), s.width)
    asked = rows.where(is_query)
    blocks = max(1, -(-asked.count() * len(order) // s.entries))
    cells = max(1, -(-rows.count() // s.cell))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    pilot = rows.orderBy(length.desc(), "vec_id").limit(s.pilot)
    pilot = pilot.select("vec_id", "v", all_of(blocks).alias("block"))

    def pack(queries: pd.DataFrame, long_ones: pd.DataFrame) -> pd.DataFrame:
        """A block of queries by falling first threshold: those of like thresholds have like survivors."""
        if not len(queries):
            return pd.DataFrame({"block": [], "ids": [], "floors": [], "data": []})
        v, ids = np.stack(queries["v"].to_numpy())[:, order], queries["vec_id"].to_numpy()
        x = np.stack(long_ones["v"].to_numpy())[:, order]
        floors = first_floors(layout.exact(v), ids, layout.exact(x), long_ones["vec_id"].to_numpy(), k)
        at = np.lexsort((ids, -floors))
        row = (int(queries["block"].iloc[0]), ids[at].tobytes(), floors[at].tobytes(), layout.packed(v[at]))
        return pd.DataFrame([row], columns=["block", "ids", "floors", "data"])

    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    packs = asked.groupBy("block").cogroup(pilot.groupBy("block"))
    packs = written(packs.applyInPandas(pack, "block int, ids binary, floors binary, data binary"), "topk-queries")
    chunks = written(vertical(rows, layout, s), "topk-chunks")
    chunks = chunks.withColumn("cell", F.pmod(F.xxhash64("ids"), F.lit(cells)).cast("int"))

    def search(block: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        queries, found, scores = [], [], []
        for asked_ids, floors, raw in zip(block["ids"], block["floors"], block["data"]):
            own, floor, q = np.frombuffer(asked_ids, np.int64), np.frombuffer(floors), layout.columns(raw).T
            for ids, data, left in zip(cell["ids"], cell["data"], cell["left"]):
                ids, data = np.frombuffer(ids, np.int64), layout.columns(data)
                left = np.frombuffer(left).reshape(len(layout.cuts) + 1, -1)
                for a in range(0, len(q), s.together):
                    part = slice(a, a + s.together)
                    hits, _ = search_chunk(q[part], own[part], floor[part], ids, data, left, layout.cuts, k)
                    for i, (near, score) in zip(own[part].tolist(), hits):
                        queries += [i] * len(near)
                        found += near.tolist()
                        scores += [int(x) if abs(x) < 2**63 else None for x in score.tolist()]
        columns = {"query_id": queries, "vec_id": found, "score": pd.array(scores, dtype="Int64")}
        return pd.DataFrame(columns)

    # the grid of query blocks and cells of chunks: every pair meets in one task
    left = packs.withColumn("cell", all_of(cells)).groupBy("block", "cell")
    right = chunks.withColumn("block", all_of(blocks)).groupBy("block", "cell")
    hits = left.cogroup(right).applyInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
