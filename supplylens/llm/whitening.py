"""Whitening of vectors on their leading principal components, by Chebyshev-filtered subspace iteration.

The covariance V is never formed: a pass over the table multiplies it with a block Q of columns, as the sum over the
rows of (x - mean) ((x - mean)' Q) / n, added up by Spark. Between passes the driver holds blocks of dimension x
columns only. A round is: orthonormal Q (QR), Rayleigh-Ritz on V Q, and the residuals of the leading pairs. While one of
them is above the tolerance, a Chebyshev polynomial of V, by its three-term recurrence with one pass per degree, damps
the spectrum below the smallest Ritz value of the block and lifts what lies above.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import written


@dataclass(frozen=True)
class Whitening:
    """``guard``: columns of the block beyond the components wanted; ``tolerance``: of a residual, relative to the largest
    eigenvalue; ``degree``: of a filter at most; ``lift``: most growth of a filter, which bounds what rounding can mix;
    ``flat``: eigenvalues below this share of the largest are of no use for whitening and give no component;
    ``patience``: rounds in which the residual may fail to halve before the search is given up with an error.
    """

    components: int = 32
    guard: int = 16
    tolerance: float = 1e-12
    degree: int = 16
    lift: float = 1e8
    flat: float = 1e-10
    patience: int = 200
    seed: int = 3


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the rows that take part: all entries there and finite, of the most frequent length (the smaller on
    ties). x holds floor(64 * c) + 1000000 of each entry c."""
    rows = vectors.where("embedding is not null").select(
        "vec_id", F.transform("embedding", lambda c: c.cast("double")).alias("c")
    )
    fits = lambda c: F.abs(c) < 2.0**56  # so that 64 c + 1000000 is a long; not so for NaN
    bad = F.exists("c", lambda c: c.isNull() | F.isnan(c) | ~fits(c))
    rows = rows.where(~bad & (F.size("c") > 0))
    sizes = rows.groupBy(F.size("c").alias("n")).count().orderBy(F.desc("count"), "n").first()
    x = F.transform("c", lambda c: F.when(fits(c), F.floor(c * 64).cast("long") + 1_000_000))
    return rows.where(F.size("c") == (sizes["n"] if sizes else 0)).select("vec_id", x.alias("x"))


def dimension_sums(rows: DataFrame) -> list[int]:
    """Exact sum of each dimension."""
    entries = rows.select(F.posexplode("x").alias("j", "x"))
    sums = entries.groupBy("j").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s")).collect()
    return [int(s) for _, s in sorted((r["j"], r["s"]) for r in sums)]


def matrices(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold rows, with one of their columns of equally long number arrays as a matrix."""
    for batch in batches:
        if batch.num_rows:
            yield batch, np.asarray(batch.column(name).flatten()).reshape(batch.num_rows, -1)


def summed_rows(rows: DataFrame, produce, height: int, width: int) -> np.ndarray:
    """Sum over all tasks of the height x width matrices that ``produce`` makes of a task's batches.

    A task sends ``height`` rows of ``width`` numbers; Spark adds them up by row, and the result has as many.
    """
    names = [f"v{k}" for k in range(width)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for part in produce(batches):
            total += part
        columns = [pa.array(np.arange(height, dtype=np.int32)), *[pa.array(np.ascontiguousarray(c)) for c in total.T]]
        yield pa.RecordBatch.from_arrays(columns, ["i", *names])

    parts = rows.mapInArrow(partial, "i int, " + ", ".join(f"{n} double" for n in names))
    out = np.zeros((height, width))
    for r in parts.groupBy("i").agg(*[F.sum(n).alias(n) for n in names]).collect():
        out[r["i"]] = r[1:]
    return out


def multiplied(rows: DataFrame, shift: np.ndarray, n: int):
    """Q -> V Q for the covariance V of the centred rows: column y less ``shift``."""
    dim = len(shift)

    def times(q: np.ndarray) -> np.ndarray:
        q = np.ascontiguousarray(q)

        def produce(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for _, y in matrices(batches, "y"):
                y = y - shift
                yield y.T @ (y @ q)

        return summed_rows(rows, produce, dim, q.shape[1]) / n

    return times


def leading(times, dim: int, w: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit eigenvectors as columns; residuals are certified."""
    wanted, block = min(w.components, dim), min(w.components + w.guard, dim)
    q = np.linalg.qr(np.random.default_rng(w.seed).normal(size=(dim, block)))[0]
    best, stalled = np.inf, 0
    while True:
        vq = times(q)
        value, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = float(value[0])
        if top <= 0:
            return np.zeros(0), np.zeros((dim, 0))
        off = float(np.sqrt(((vq - q * value) ** 2).sum(axis=0))[:wanted].max()) / top
        # rounding ends what iteration can do: below 1000 tolerances a round that no longer halves the residual is the last
        if off <= w.tolerance or (off <= 1000 * w.tolerance and off > best / 2):
            keep = value[:wanted] > w.flat * top
            return value[:wanted][keep], q[:, :wanted][:, keep]
        stalled = stalled + 1 if off > best / 2 else 0
        if stalled == w.patience:
            raise ArithmeticError(f"eigenvectors not certified: residual {off:.1e} of the largest eigenvalue")
        best = min(best, off) if stalled else off
        q = np.linalg.qr(filtered(times, q, value, off, w))[0]


def filtered(times, q: np.ndarray, value: np.ndarray, off: float, w: Whitening) -> np.ndarray:
    """Chebyshev polynomial of V on the columns of q, small on 0 .. b, where b is the smallest Ritz value of the block.

    The recurrence is scaled by its value at the largest eigenvalue, so that nothing overflows. The degree is the least
    that brings the residual ``off`` below the tolerance, by the growth at the last wanted eigenvalue.
    """
    top, last, edge = float(value[0]), float(value[min(w.components, len(value)) - 1]), max(float(value[-1]), 1e-14 * float(value[0]))
    half = edge / 2
    growth = lambda e: float(np.arccosh(max(1 + 1e-9, (e - half) / half)))
    degree = int(np.ceil(np.log(off / w.tolerance) / growth(last)))
    degree = max(2, min(degree, w.degree, int(np.log(w.lift) / growth(top))))
    sigma = first = half / (top - half)
    before, now = q, (times(q) - half * q) * (first / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        before, now = now, (times(now) - half * now) * (2 * new / half) - before * (sigma * new)
        sigma = new
    return now / np.maximum(np.sqrt((now * now).sum(axis=0)), 1e-300)  # columns of like size: QR loses none


def deviations(y: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * y - rest)**2 for each row, exactly; None where it is no long."""
    if float(n) * float(np.abs(y).max() + 1) * np.sqrt(y.shape[1]) < 2**31:
        return ((n * y - rest) ** 2).sum(axis=1).tolist()
    exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest.tolist())) for row in y.tolist()]
    return [d if d < 1 << 63 else None for d in exact]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, w: Whitening = Whitening()) -> DataFrame:
    """The leading whitened coordinates of ``vectors`` (vec_id, embedding): vec_id, component, n, deviation, whitened,
    explained, identity_error, one row for each vector and component.

    Entries c become x = floor(64 c) + 1000000, which is what is centred and whitened. Nulls: a null vector, one that holds
    null, NaN or infinite entries, an empty one, or one of another length than most takes no part; a null vec_id is a
    vector like any other. Repeated rows all count, and all are returned. Equal eigenvalues: any orthonormal choice within
    their space. Components whose eigenvalue is next to zero cannot be scaled to variance one and are left out, so equal
    vectors, a single one or an empty table give no rows. A deviation beyond a long is null. Other columns are not carried.
    """
    session = vectors.sparkSession
    rows = integers(vectors)
    one = rows.agg(F.count("*"), F.any_value(F.size("x"))).first()
    n, dim = int(one[0]), int(one[1] or 0)
    if not n:
        return session.createDataFrame([], SCHEMA)
    sums = dimension_sums(rows)
    # x - floor(mean) is a small whole number and the rest of the mean below 1, so centring loses no digits
    low = [s // n for s in sums]
    rest = np.array([s - n * b for s, b in zip(sums, low)], dtype=np.int64)
    y = F.zip_with("x", F.array(*[F.lit(b) for b in low]), lambda a, b: a - b)
    rows = written(rows.select("vec_id", y.alias("y")), "whitening")
    shift = rest / n
    times = multiplied(rows, shift, n)
    value, axes = leading(times, dim, w)
    if not len(value):
        return session.createDataFrame([], SCHEMA)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, y in matrices(batches, "y"):
            yield np.array([[((y - shift) ** 2).sum()]])

    explained = (value / (summed_rows(rows, squares, 1, 1)[0, 0] / n)).tolist()
    scaled = axes / np.sqrt(value)
    wide = len(value)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, y in matrices(batches, "y"):
            z = (y - shift) @ scaled
            yield np.vstack([z.T @ z, z.sum(axis=0)])

    moments = summed_rows(rows, products, wide + 1, wide) / n
    error = float(np.abs(moments[:-1] - np.outer(moments[-1], moments[-1]) - np.eye(wide)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, y in matrices(batches, "y"):
            for a in range(0, len(y), 1024):
                part = y[a : a + 1024]
                k = len(part)
                columns = [
                    batch.column("vec_id").slice(a, k).take(pa.array(np.repeat(np.arange(k), wide))),
                    pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), k)),
                    pa.array(np.full(k * wide, n)),
                    pa.array(deviations(part, n, rest), pa.int64()).take(pa.array(np.repeat(np.arange(k), wide))),
                    pa.array(((part - shift) @ scaled).ravel()),
                    pa.array(np.tile(explained, k)),
                    pa.array(np.full(k * wide, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    return rows.select(F.col("vec_id").cast("long"), "y").mapInArrow(project, SCHEMA)
