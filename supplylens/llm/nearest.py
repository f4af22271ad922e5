"""Nearest neighbours by cosine with several shifted Hilbert curves.

Every curve orders the vectors by the Hilbert key of a random, shifted projection to a few dimensions. The keys
of a curve are parted into ranges of equally many vectors; a query meets its own range and the ones before and
after it. What the curves find is merged, and ranked by the exact cosine of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplylens.llm.common import written


@dataclass(frozen=True)
class Curves:
    """``ranges``: of a curve, so a query meets 3 / ranges of all vectors; fewer when a range had less than ``least``."""

    curves: int = 18
    dimensions: int = 6
    bits: int = 8
    ranges: int = 40
    least: int = 400
    #: vectors of a range that stand in one task
    chunk: int = 20_000
    seed: int = 5


def hilbert(x: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of points with integer coordinates below ``2**bits``, by the transposed form of the curve."""
    x = x.astype(np.int64).copy()
    n, p = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(p):
            hit = (x[:, i] & q) > 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(hit, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, p):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, p - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(n, dtype=np.int64)
    for bit in reversed(range(bits)):
        for i in range(p):
            key = (key << 1) | ((x[:, i] >> bit) & 1)
    return key


def projections(dim: int, c: Curves) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(c.seed)
    wide = min(c.dimensions, dim)
    return [(np.linalg.qr(rng.normal(size=(dim, wide)))[0], rng.uniform(-0.5, 0.5, wide)) for _ in range(c.curves)]


def curve_keys(unit: np.ndarray, plan: list[tuple[np.ndarray, np.ndarray]], c: Curves) -> np.ndarray:
    """Keys of unit vectors on each curve. Coordinates are spread so that random directions fill the grid."""
    top = (1 << c.bits) - 1
    spread = np.sqrt(unit.shape[1])
    out = []
    for axes, shift in plan:
        y = (unit @ axes * spread + shift + 4) / 8 * (1 << c.bits)
        out.append(hilbert(np.clip(y, 0, top).astype(np.int64), c.bits))
    return np.stack(out, axis=1) if out else np.zeros((len(unit), 0), dtype=np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (as double) of the rows that take part, once each: of the most frequent length (the smaller on
    ties), neither null nor zero, all components finite."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.where("vec_id is not null and embedding is not null").select("vec_id", v.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~bad & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (sizes["n"] if sizes else 0)).distinct()


def cosine(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosine of rows, summed in the same order wherever it is computed."""
    return (q * c).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, c: Curves = Curves()) -> DataFrame:
    """The k nearest other vectors of each query: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and embedding. Nulls: vectors that are null, zero or hold null or non-finite components, and
    rows without vec_id, take no part, as queries or candidates; so do those of another length than most. Repeated rows
    count once; rows of one vec_id never are each other's neighbours. Ties go to the smaller vec_id. An empty table gives
    an empty table. Other columns are not carried.
    """
    session = vectors.sparkSession
    rows = usable(vectors)
    # of equal vectors only the k + 1 smallest ids can be among the k nearest of anything
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
    distinct = ranked.where(F.col("_n") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    first = rows.limit(1).collect()
    if not first:
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plan = session.sparkContext.broadcast(projections(len(first[0]["vector"]), c))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["vector"].to_numpy())
            keys = curve_keys(x / np.sqrt((x * x).sum(axis=1))[:, None], plan.value, c)
            ids = [np.sort(np.asarray(i, dtype=np.int64)).tobytes() for i in batch["ids"]]
            yield pd.DataFrame({"ids": ids, "vector": [v.tobytes() for v in x], "keys": list(keys)})

    placed = written(distinct.mapInPandas(place, "ids binary, vector binary, keys array<long>"), "curves")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector").distinct()

    def place_query(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.stack(batch["vector"].to_numpy())
            keys = curve_keys(x / np.sqrt((x * x).sum(axis=1))[:, None], plan.value, c)
            yield pd.DataFrame({"query_id": batch["query_id"], "vector": [v.tobytes() for v in x], "keys": list(keys)})

    asked = queries.mapInPandas(place_query, "query_id long, vector binary, keys array<long>")
    n = placed.count()
    ranges = max(1, min(c.ranges, n // c.least))
    chunks = max(1, -(-n // (ranges * c.chunk)))
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    at = range(c.curves)
    bounds = (
        placed.agg(*[F.percentile_approx(F.col("keys")[i], shares, F.lit(20_000)).alias(f"c{i}") for i in at]).first()
        if ranges > 1
        else [[] for _ in at]
    )  # at most curves * ranges numbers

    def range_of(curve: int) -> Column:
        """How many bounds of the curve are below the key."""
        cuts = F.array(*[F.lit(b).cast("long") for b in bounds[curve]]) if ranges > 1 else F.array().cast("array<long>")
        return F.size(F.filter(cuts, lambda b: b < F.col("keys")[curve]))

    spots = F.array(*[F.struct(F.lit(i).alias("curve"), range_of(i).alias("range")) for i in at])
    candidates = placed.select("ids", "vector", F.explode(spots).alias("s")).select(
        F.col("s.curve").alias("curve"),
        F.col("s.range").alias("range"),
        F.pmod(F.xxhash64("vector"), F.lit(chunks)).cast("int").alias("chunk"),
        "ids",
        "vector",
    )
    near = F.sequence(F.greatest(F.col("s.range") - 1, F.lit(0)), F.least(F.col("s.range") + 1, F.lit(ranges - 1)))
    asked = asked.select("query_id", "vector", F.explode(spots).alias("s")).select(
        "query_id", "vector", F.col("s.curve").alias("curve"), F.explode(near).alias("range")
    )
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def search(found: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(found) and len(wanted):
            x = np.stack([np.frombuffer(v) for v in found["vector"]])
            ids = [np.frombuffer(i, np.int64) for i in found["ids"]]
            length = np.sqrt((x * x).sum(axis=1))
            query_ids = wanted["query_id"].tolist()
            for start in range(0, len(wanted), 256):  # blocks of queries bound the matrix
                q = np.stack([np.frombuffer(v) for v in wanted["vector"].iloc[start : start + 256]])
                rough = q @ x.T / length
                most = min(k + 1, len(x))  # one of them may be the query's own
                least = -np.partition(-rough, most - 1, axis=1)[:, most - 1]
                for i, own in enumerate(query_ids[start : start + 256]):
                    # with all that may tie with the last, up to rounding
                    top = np.flatnonzero(rough[i] >= least[i] - 1e-9 * np.sqrt(q[i] @ q[i]))
                    score = cosine(np.broadcast_to(q[i], (len(top), q.shape[1])), x[top])
                    pairs = [(-s, int(v)) for s, t in zip(score.tolist(), top) for v in ids[t] if v != own]
                    out += [(own, v, -s) for s, v in sorted(pairs)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    on = ["curve", "range", "chunk"]
    hits = candidates.groupBy(*on).cogroup(asked.groupBy(*on)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.distinct()
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
