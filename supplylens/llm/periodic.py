"""Periodic runs of words, found by minimizers at several scales.

A run of period q is a stretch in which words q apart are identical. Scale s looks for the periods from 2**s to
2**(s+1) - 1: every window of 2**s neighbouring pieces of 2**(s+1) words gives the place of its smallest hash, its
minimizer. Inside a run the minima come again one period later, and as a piece is no shorter than a period, equal ones
are no closer than that. So two neighbouring occurrences of one minimizer name the period and a place of the run; the
places of a run chain to one stretch, which is extended word by word at both ends. Periods too short for a scale are
found by direct scans of their lag. A run of four periods always holds two windows that are one period apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import mix, slices, words_of
from supplylens.llm.substring_dedup import smallest_in_windows

U = np.uint64
#: What is told of a run.
NAMES = ("start", "length", "period")


@dataclass(frozen=True)
class Runs:
    """Runs of at least ``least`` words and ``times`` periods; the scales find runs of four periods and more.

    ``scan``: periods below it are scanned for directly, a power of two; ``block``: characters of text taken at once.
    """

    times: int = 4
    least: int = 6
    scan: int = 8
    block: int = 2_000_000

    def __post_init__(self):
        if self.times < 4:
            raise ValueError("runs of fewer than four periods are not found by minimizers")

    def shortest(self, period: int | np.ndarray) -> int | np.ndarray:
        return np.maximum(self.least, self.times * period)


def lag_runs(x: np.ndarray, q: int, least: int) -> np.ndarray:
    """(start, stop, q) of the stretches of ``least`` places or more with x[i] == x[i + q] that cannot be extended."""
    if len(x) < least:
        return np.zeros((0, 3), dtype=np.int64)
    differ = np.flatnonzero(x[q:] != x[:-q])
    start, stop = np.append(0, differ + 1), np.append(differ, len(x) - q)
    wide = np.flatnonzero(stop - start >= least - q)
    return np.stack([start[wide], stop[wide] + q, np.full(len(wide), q)], axis=1)


def _reach(x: np.ndarray, at: np.ndarray, lag: np.ndarray, step: int) -> np.ndarray:
    """Over how many places x[i] == x[i + lag] goes on from each place of ``at``, upwards or downwards."""
    far, live, width = np.zeros(len(at), dtype=np.int64), np.arange(len(at)), 8
    while len(live):
        i = (at[live] + step * far[live])[:, None] + step * np.arange(width)
        other = i + lag[live, None]
        inside = (i >= 0) & (other < len(x))
        same = inside & (x[np.where(inside, i, 0)] == x[np.where(inside, other, 0)])
        run = np.where(same.all(axis=1), width, same.argmin(axis=1))
        far[live] += run
        live = live[run == width]
        width = max(8, min(2 * width, 2_000_000 // max(1, len(live))))
    return far


def minimizer_runs(x: np.ndarray, h: np.ndarray, scale: int) -> np.ndarray:
    """(start, stop, period) of runs whose period belongs to the scale; ``h`` are the hashes of its pieces."""
    width, piece = 1 << scale, 2 << scale
    empty = np.zeros((0, 3), dtype=np.int64)
    if len(h) < width:
        return empty
    best = smallest_in_windows(h, width)
    best = best[np.append(True, best[1:] != best[:-1])]
    order = np.argsort(h[best], kind="stable")
    place, value = best[order], h[best][order]
    lag = np.diff(place)
    seed = np.flatnonzero((value[1:] == value[:-1]) & (lag >= width) & (lag < piece))
    if not len(seed):
        return empty
    lag, place = lag[seed], place[seed]
    order = np.lexsort((place, lag))
    lag, place = lag[order], place[order]
    # places of one lag whose pieces touch are one stretch
    first = np.flatnonzero(np.append(True, (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + piece)))
    last = np.append(first[1:], len(place)) - 1
    lag, left, right = lag[first], place[first], place[last] + piece
    left = left - _reach(x, left - 1, lag, -1)
    right = right + _reach(x, right, lag, 1)
    return np.stack([left, right + lag, lag], axis=1)


def all_runs(texts: list[np.ndarray], r: Runs) -> list[np.ndarray]:
    """(start, length, period) of every run of each text, by start and period; words are given as numbers."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))  # a scale needs the long texts only: they come first
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    offset = np.concatenate([[0], np.cumsum(sizes + 1)]).astype(np.int64)
    x = np.empty(offset[-1], dtype=np.int64)
    for k, i in enumerate(order):
        x[offset[k] : offset[k] + sizes[k]] = texts[i]
        x[offset[k + 1] - 1] = -1 - k  # after each text a number of its own
    prefix = lambda least: int(offset[np.searchsorted(-sizes, -least, side="right")])
    found = []
    for q in range(1, r.scan):
        least = int(r.shortest(q))
        found.append(lag_runs(x[: prefix(least)], q, least))
    h, scale = mix(x.astype(U) * U(0x9E3779B97F4A7C15) + U(1)), r.scan.bit_length() - 1
    size = 1
    while True:
        end = prefix(int(r.shortest(1 << scale)))
        if not end:
            break
        while size < 2 << scale:
            h = mix(h[: len(h) - size] * U(0xD1342543DE82EF95) + h[size:]) if len(h) > size else h[:0]
            size *= 2
        h = h[: max(0, end - size + 1)]
        runs = minimizer_runs(x[:end], h, scale)
        runs = runs[runs[:, 1] - runs[:, 0] >= r.shortest(runs[:, 2])]
        # hashes named the runs, the words decide: a lag that does not hold is scanned for
        holds = np.array([np.array_equal(x[a : b - q], x[a + q : b]) for a, b, q in runs.tolist()], dtype=bool)
        found.append(runs[holds])
        found += [lag_runs(x[:end], q, int(r.shortest(q))) for q in set(runs[~holds, 2].tolist())]
        scale += 1
    rows = np.concatenate(found)
    # one stretch has one smallest period: multiples of it were found with the same ends
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    owner = np.searchsorted(offset, rows[:, 0], side="right") - 1
    rows = np.stack([rows[:, 0] - offset[owner], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out: list[np.ndarray] = [rows[:0]] * len(texts)
    for k, i in enumerate(order):
        out[i] = rows[cut[k] : cut[k + 1]]
    return out


def numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Words as numbers, equal ones for equal words and only for these."""
    number: dict[bytes, int] = {}
    return [np.array([number.setdefault(w, len(number)) for w in t], dtype=np.int64) for t in texts]


def without_repeats(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def collapsed(docs: DataFrame, r: Runs = Runs()) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period) and collapsed, the words outside the
    repeated periods joined by a space, of every row of ``docs`` (doc_id, text).

    Runs are told by the words themselves. Nulls: a null text, like an empty one, has no words and no runs and collapses
    to the empty text; a null doc_id is a document like any other. Very long texts are taken whole, alone in a block.
    Repeated rows get equal results; of two runs over one stretch there is only the one of the smallest period. An empty
    table gives an empty table. Other columns are not carried. Nothing is shuffled.
    """

    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices(texts, r.block):
                words = [words_of(t) for t in texts[a:b]]
                found = all_runs(numbered(words), r)
                left = [b" ".join(without_repeats(w, f)).decode("utf-8", "surrogatepass") for w, f in zip(words, found)]
                columns = {
                    "doc_id": ids.slice(a, b - a),
                    "n_words": pa.array([len(w) for w in words], pa.int64()),
                    "runs": pa.array([[dict(zip(NAMES, row)) for row in f.tolist()] for f in found], spans),
                    "collapsed": pa.array(left, pa.string()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, schema)
