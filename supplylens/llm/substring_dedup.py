"""Removal of word sequences that occur more than once in a corpus, with an FM-index per shard.

Every window of 35 words has a minimizer, the smallest hash among its ten-word runs, and equal windows have equal
ones. A document is cut into runs of windows with the same minimizer; a run whose minimizer occurs nowhere else
cannot hold a repeated window and goes no further. The others are sent to the shard of their minimizer, equal
runs counted once with their number. The shard builds an FM-index over its runs; each of them is streamed
through it by backward search, which yields its matching statistics: the intervals of words that occur twice or
more. Intervals of a full window or longer are reported back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import bounded_batches, span_hashes, text_slices, utf8, window_hashes, word_hashes, written
from supplylens.llm.fm_index import FMIndex

U = np.uint64


@dataclass(frozen=True)
class Dedup:
    window: int = 35
    minimizer: int = 10
    #: minimizers met in one task, and words of runs indexed in one shard, on average
    part: int = 1_000_000
    shard: int = 600_000
    #: bytes of text that a task takes at once
    slice: int = 2_000_000
    #: texts that reach a task in one Arrow batch
    batch: int = 1_000
    #: runs of crowded minimizers that a task cuts into single windows at once
    runs: int = 1_000
    #: different runs of one minimizer above which it is cut into single windows, dealt by their own hash
    crowd: int = 5_000


def smallest_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest value, the leftmost on ties, in each window of ``width`` values."""
    n = len(values)
    bits = U(max(1, int(n).bit_length()))
    keyed = ((values >> bits) << bits) | np.arange(n, dtype=U)
    padded = np.full(-(-n // width) * width, np.iinfo(U).max, dtype=U)
    padded[:n] = keyed
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (least & ((U(1) << bits) - U(1))).astype(np.int64)


def runs(h: np.ndarray, d: Dedup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimizer of each run of a text given by its word hashes."""
    n = len(h) - d.window + 1
    if n < 1:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty.astype(U)
    grams = window_hashes(h, d.minimizer)
    # only the leading bits take part, the same ones in a text of any length
    best = smallest_in_windows((grams >> U(32)) << U(32), d.window - d.minimizer + 1)
    first = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    return first, np.diff(np.append(first, n)), grams[best[first]]


def shared_runs(docs: DataFrame, parts: int, d: Dedup) -> DataFrame:
    """text_key and first window of the runs whose minimizer occurs more than once."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, d.slice):
            keys, owners, places = [], [], []
            for own, raw in zip(batch.column("text_key").to_pylist(), utf8(batch.column("text"))):
                first, _, key = runs(word_hashes(raw), d)
                keys.append(key)
                owners.append(np.full(len(key), own, dtype=np.int64))
                places.append(first)
            key, owner, place = np.concatenate(keys), np.concatenate(owners), np.concatenate(places)
            part = (key % U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            key, owner, place, part = key[order], owner[order], place[order].astype(np.int32), part[order]
            if not len(part):
                continue
            start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            cut = list(zip(start, np.append(start[1:], len(part))))
            blobs = [pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (key, owner, place)]
            yield pa.RecordBatch.from_arrays([pa.array(part[start]), *blobs], ["part", "keys", "owners", "places"])

    def meet(p: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(p["keys"]), dtype=U)
        owner = np.frombuffer(b"".join(p["owners"]), dtype=np.int64)
        place = np.frombuffer(b"".join(p["places"]), dtype=np.int32)
        order = np.lexsort((place, owner, key))
        key, owner, place = key[order], owner[order], place[order]
        new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1]))
        key, owner, place = key[new], owner[new], place[new]
        same = key[1:] == key[:-1]
        twice = np.append(False, same) | np.append(same, False)
        return pd.DataFrame({"text_key": owner[twice], "place": place[twice]})

    rows = docs.select(F.xxhash64("text").alias("text_key"), "text").where(F.col("text").isNotNull())
    rows = rows.mapInArrow(scatter, "part long, keys binary, owners binary, places binary")
    return rows.groupBy("part").applyInPandas(meet, "text_key long, place int")


def run_words(docs: DataFrame, shared: DataFrame, d: Dedup) -> DataFrame:
    """text_key, place, minimizer, words (hashes) and content (their hash) of the shared runs, once per text."""
    per_text = shared.groupBy("text_key").agg(F.collect_list("place").alias("places"))
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text").join(per_text, "text_key").dropDuplicates(["text_key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, d.slice):
            rows = []
            columns = batch.column("text_key").to_pylist(), utf8(batch.column("text")), batch.column("places").to_pylist()
            for own, raw, places in zip(*columns):
                h = word_hashes(raw)
                first, size, key = runs(h, d)
                at = np.searchsorted(first, np.unique(np.asarray(places, dtype=np.int64)))
                first, key = first[at], key[at].view(np.int64)
                stop = first + size[at] + d.window - 1
                content = span_hashes(h, first, stop).view(np.int64)
                for a, b, k, c in zip(first.tolist(), stop.tolist(), key.tolist(), content.tolist()):
                    rows.append((own, a, k, c, h[a:b].tobytes()))
            kinds = {"text_key": pa.int64(), "place": pa.int32(), "minimizer": pa.int64(), "content": pa.int64(), "words": pa.binary()}
            arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())]
            yield pa.RecordBatch.from_arrays(arrays, list(kinds))

    schema = "text_key long, place int, minimizer long, content long, words binary"
    return texts.select("text_key", "text", "places").mapInArrow(cut, schema)


def repeated_intervals(words: list[np.ndarray], copies: np.ndarray, d: Dedup) -> list[tuple[int, int, int]]:
    """(run, first word, last word) of the intervals that occur twice or more, a window long at least.

    ``words`` are the different runs of a shard, ``copies`` how often each occurs.
    """
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    offset = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    flat = np.zeros(int((sizes + 1).sum()), dtype=np.int64)
    body = np.ones(len(flat), dtype=bool)
    body[offset + sizes] = False
    values, code = np.unique(np.concatenate(words), return_inverse=True)
    flat[body] = code + 1  # 0 separates the runs
    weight = np.repeat(copies, sizes + 1)
    index = FMIndex(flat, len(values) + 1, int(sizes.max()), weight)
    out = [(int(r), 0, int(sizes[r]) - 1) for r in np.flatnonzero(copies > 1)]
    run = np.flatnonzero(copies == 1)
    left, right = offset[run], offset[run] + sizes[run] - 1
    while len(run):
        start = index.match_left(flat, left, right, 2)
        full = right - start + 1 >= d.window
        out += zip(run[full].tolist(), (start - offset[run])[full].tolist(), (right - offset[run])[full].tolist())
        # the text from start - 1 to right occurs once: find the shortest such piece from there on, go on before its end
        fail = start > left
        run, left, right, at = run[fail], left[fail], right[fail], start[fail] - 1
        low, high = at.copy(), right.copy()  # the last word of the shortest unique piece is in low .. high
        width = 1
        gallop = np.ones(len(run), dtype=bool)
        while (low < high).any():
            todo = np.flatnonzero(low < high)
            probe = np.where(gallop[todo], np.minimum(at[todo] + width - 1, high[todo] - 1), (low[todo] + high[todo]) // 2)
            probe = np.maximum(probe, low[todo])
            unique = index.match_left(flat, at[todo], probe, 2) > at[todo]
            high[todo] = np.where(unique, probe, high[todo])
            low[todo] = np.where(unique, low[todo], probe + 1)
            gallop[todo] &= ~unique
            width *= 2
        right = high - 1
        more = right - left + 1 >= d.window
        run, left, right = run[more], left[more], right[more]
    return out


def repeats(found: DataFrame, d: Dedup) -> DataFrame:
    """text_key, first, last: words of each text that repeated windows cover. ``found`` are the rows of run_words."""
    different = found.groupBy("content", "minimizer").agg(F.count("*").alias("copies"), F.first("words").alias("words"))
    different = written(different, "dedup-runs")
    crowded = different.groupBy("minimizer").count().where(F.col("count") > d.crowd).select("minimizer")
    crowded = written(crowded, "dedup-crowds")
    words = different.agg(F.sum(F.octet_length("words")) / 8).first()[0] or 0
    shards = max(1, -(-int(words) // d.shard))

    def search(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("content", kind="stable")
        hits = repeated_intervals([np.frombuffer(w, dtype=U) for w in p["words"]], p["copies"].to_numpy(), d)
        at = np.array([r for r, _, _ in hits], dtype=np.int64)
        return pd.DataFrame(
            {
                "content": p["content"].to_numpy()[at],
                "first": np.array([a for _, a, _ in hits], dtype=np.int32),
                "last": np.array([b for _, _, b in hits], dtype=np.int32),
            }
        )

    plain = different.join(crowded, "minimizer", "left_anti")
    plain = plain.withColumn("shard", F.pmod(F.xxhash64("minimizer"), F.lit(shards)))
    hits = plain.groupBy("shard").applyInPandas(search, "content long, first int, last int")
    if not crowded.isEmpty():
        hits = hits.union(_single_windows(different.join(crowded, "minimizer", "left_semi"), search, d))
    hits = written(hits, "dedup-hits")
    at = found.select("content", "text_key", "place").join(hits, "content")
    return at.select("text_key", (F.col("place") + F.col("first")).alias("first"), (F.col("place") + F.col("last")).alias("last"))


def _single_windows(different: DataFrame, search, d: Dedup) -> DataFrame:
    """The same for runs of crowded minimizers: their windows are dealt to the shards one by one, equal ones summed."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), d.runs):
                some = batch.iloc[at : at + d.runs]
                rows = []
                for content, copies, raw in zip(some["content"], some["copies"], some["words"]):
                    w = np.frombuffer(raw, dtype=U)
                    keys = window_hashes(w, d.window).view(np.int64)
                    for a, key in enumerate(keys.tolist()):
                        rows.append((content, a, key, copies, w[a : a + d.window].tobytes()))
                yield pd.DataFrame(rows, columns=["run", "first", "content", "copies", "words"])

    windows = different.mapInPandas(cut, "run long, first int, content long, copies long, words binary")
    windows = written(windows, "dedup-windows")
    # a run is up to 26 windows of 35 words: the shards follow these words, not those of the runs
    kinds = windows.agg(F.approx_count_distinct("content")).first()[0]
    shards = max(1, -(-int(kinds) * d.window // d.shard))
    once = windows.groupBy("content").agg(F.sum("copies").alias("copies"), F.first("words").alias("words"))
    once = once.withColumn("shard", F.pmod(F.xxhash64("content"), F.lit(shards)))
    hits = once.groupBy("shard").applyInPandas(search, "content long, first int, last int").select("content")
    back = windows.select("run", "first", "content").join(hits, "content")
    return back.select(F.col("run").alias("content"), "first", (F.col("first") + d.window - 1).alias("last"))


def removed(docs: DataFrame, d: Dedup = Dedup(), carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, n_words, n_removed and kept (the words left, joined by a space) of every row of ``docs``.

    Windows are judged on the input. Nulls: a null text has no words and kept is empty; a null doc_id is a document like
    any other. A text with fewer words than a window loses nothing. Repeated rows are copies of each other: all their
    words go if they fill a window. An empty table gives an empty table. Other columns are not carried, unless ``carry``
    names them.
    """
    base = docs.select("doc_id", "text")
    # runs per text, from its characters: six a word and 13 windows a run
    chars = base.agg(F.sum(F.char_length("text"))).first()[0] or 0
    shared = shared_runs(base, max(1, int(chars) // 80 // d.part), d)
    found = written(run_words(base, shared, d), "dedup-found", d.batch)
    # both ends in one number, as an array of numbers reaches the task without an object for each interval
    span = F.shiftleft(F.col("first").cast("long"), 32) + F.col("last")
    spans = repeats(found, d).groupBy("text_key").agg(F.collect_set(span).alias("_spans"))
    copies = base.groupBy(F.xxhash64("text").alias("text_key"), F.md5("text").alias("m")).count().where("count > 1")
    copies = copies.groupBy("text_key").agg(F.collect_list("m").alias("_copies"))
    # what is known of a text comes together first, so that the texts are shuffled once
    known = spans.join(copies, "text_key", "full")
    rows = docs.select("doc_id", "text", *[F.col(c) for c in carry], F.xxhash64("text").alias("_k"))
    keyed = rows.join(known, F.col("_k") == F.col("text_key"), "left")
    keyed = keyed.withColumn("_copy", F.coalesce(F.array_contains("_copies", F.md5("text")), F.lit(False)))

    @F.arrow_udf("n_words long, n_removed long, kept string")
    def strip(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        whole = (pa.RecordBatch.from_arrays(list(b), ["text", "spans", "copy"]) for b in batches)
        for rows in text_slices(whole, d.slice):
            size, less, kept = [], [], []
            for raw, own, twice in zip(utf8(rows.column("text")), rows.column("spans"), rows.column("copy").to_pylist()):
                words = (raw or b"").split()
                gone = np.zeros(len(words), dtype=bool)
                if twice and len(words) >= d.window:
                    gone[:] = True
                elif own.is_valid:
                    own = own.values.to_numpy()
                    for first, last in zip((own >> 32).tolist(), (own & 0xFFFFFFFF).tolist()):
                        gone[first : last + 1] = True
                size.append(len(words))
                less.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g))
            columns = [pa.array(size, pa.int64()), pa.array(less, pa.int64()), pa.array(kept, pa.binary()).view(pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_words", "n_removed", "kept"])

    bounded_batches(docs.sparkSession, d.batch)
    out = keyed.withColumn("_r", strip("text", "_spans", "_copy"))
    return out.select("doc_id", "text", *[F.col(c) for c in carry], "_r.n_words", "_r.n_removed", "_r.kept")
