"""Scoring of texts by prediction by partial matching, pretrained on a part of the corpus.

The model is the trie of all byte contexts up to ``order`` bytes of the training texts. A byte is coded in the
longest context that has seen it; each longer one adds the cost of its escape, estimated by method C, and takes
the symbols it has seen out of the shorter ones (symbol exclusion). The trie is never in one place: it is dealt
by the last two context bytes, which keeps a context together with all its longer ones, while the two shortest
orders (at most 65,792 counts) go to every task. Documents stand in blocks; a block asks each part of the trie
for the code lengths of the byte n-grams it contains, once each, and so for the counts of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import LOWER, mix, text_slices, utf8, word_hashes, written

U = np.uint64
#: A byte that UTF-8 never uses, coded after each text.
END = 0xFF
LN10 = float(np.log(10))


@dataclass(frozen=True)
class Ppm:
    """``order``: bytes of context at most; ``block``: bytes of text in a block; ``part``: bytes of text for each part that
    the model is dealt to, so that their number follows the input.
    """

    order: int = 4
    block: int = 4_000_000
    part: int = 12_000_000


def grams(raw: list[bytes], order: int) -> np.ndarray:
    """The byte n-gram (context and byte) at every place of the texts, as numbers; a text starts after zero bytes."""
    pad = b"\0" * order
    data = np.frombuffer(pad + b"".join(r + bytes([END]) + pad for r in raw), dtype=np.uint8)
    code = np.zeros(len(data) - order, dtype=np.int64)
    for j in range(order + 1):
        code = (code << 8) | data[j : len(data) - order + j]
    size = np.array([len(r) + 1 + order for r in raw], dtype=np.int64)
    keep = np.ones(len(code), dtype=bool)
    ends = np.cumsum(size)
    for k in range(order):
        at = ends - 1 - k
        keep[at[at < len(keep)]] = False
    return code[keep]


def _cut(key: np.ndarray, part: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The arrays per part, in their order."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    arrays = [a[order] for a in (key, *values)]
    if len(part):
        start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        for a, b in zip(start, np.append(start[1:], len(part))):
            yield int(part[a]), [x[a:b] for x in arrays]


def _gram_part(code: np.ndarray, parts: int) -> np.ndarray:
    return (mix((code >> 8) & 0xFFFF) % U(parts)).astype(np.int64)


def _word_part(word: np.ndarray, parts: int) -> np.ndarray:
    return (mix(word) % U(parts)).astype(np.int64)


PACK = "kind string, block long, part int, ids binary, counts binary, payload binary"


def squeezed(values: np.ndarray) -> bytes:
    """Numbers of eight bytes as their compressed byte planes: small and like ones take next to no room."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes())


def spread(raw: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def squeezed_ids(ids: np.ndarray) -> bytes:
    """Rising ids by their steps."""
    return squeezed(np.diff(ids, prepend=np.int64(0)))


def spread_ids(raw: bytes) -> np.ndarray:
    return np.cumsum(spread(raw))


def packed(docs: DataFrame, training: Column, parts: int, m: Ppm) -> DataFrame:
    """One pass over the texts: blocks of compressed documents, what they ask for, and the training counts.

    ``kind``: block (ids, sizes and texts in payload), gram or word (ids a block asks for), and train-gram or
    train-word (ids and counts).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in text_slices(batches, m.block):
            raw = [t or b"" for t in utf8(batch.column("text"))]
            own, flags = np.asarray(batch.column("row")), batch.column("learn").to_pylist()
            block = xxhash.xxh64_intdigest(own.tobytes()) - (1 << 63)
            lengths = np.array([len(r) for r in raw], dtype=np.int64)
            out = [("block", block, 0, own.tobytes(), lengths.tobytes(), squeeze.compress(b"".join(raw)))]
            asked = {"gram": [], "word": []}
            for learned in (True, False):
                texts_of = [r for r, f in zip(raw, flags) if bool(f) == learned]
                if not texts_of:
                    continue
                code, n = _unique(texts_of, lambda t: grams(t, m.order))
                ids, k = _unique(texts_of, _words)
                asked["gram"].append(code)
                asked["word"].append(ids)
                if learned:
                    for part, (a, b) in _cut(code, _gram_part(code, parts), n):
                        out.append(("train-gram", 0, part, squeezed_ids(a), squeezed(b), None))
                    for part, (a, b) in _cut(ids, _word_part(ids, parts), k):
                        out.append(("train-word", 0, part, squeezed_ids(a), squeezed(b), None))
            for kind, lists in asked.items():
                ids = np.unique(np.concatenate(lists))
                part_of = (_gram_part if kind == "gram" else _word_part)(ids, parts)
                out += [(kind, block, part, squeezed_ids(a), None, None) for part, (a,) in _cut(ids, part_of)]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PACK.split(", ")])

    rows = docs.select("text", F.col("row"), training.alias("learn"))
    return rows.mapInArrow(pack, PACK)


def _words(raw: list[bytes]) -> np.ndarray:
    return word_hashes(b" ".join(raw).translate(LOWER)).view(np.int64)


def _unique(raw: list[bytes], ids_of) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of texts with counts, gathered in slices so that memory follows the distinct ones."""
    ids, counts, at = [], [], 0
    while at < len(raw):
        stop, size = at, 0
        while stop < len(raw) and (size < 1_000_000 or stop == at):
            size += len(raw[stop]) + 1
            stop += 1
        c, n = np.unique(ids_of(raw[at:stop]), return_counts=True)
        ids.append(c)
        counts.append(n)
        at = stop
    return _summed(np.concatenate(ids), np.concatenate(counts))


def _summed(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    ids, counts = ids[order], counts[order]
    if not len(ids):
        return ids, counts
    start = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
    return ids[start], np.add.reduceat(counts, start)


def merged(rows: DataFrame) -> DataFrame:
    """Counts of all tasks summed per part: part, ids, counts, total and different."""

    def add(d: pd.DataFrame) -> pd.DataFrame:
        ids, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(d), 64):  # what is held follows the different ids
            some = d.iloc[at : at + 64]
            more = [spread_ids(x) for x in some["ids"]], [spread(x) for x in some["counts"]]
            ids, n = _summed(np.concatenate([ids, *more[0]]), np.concatenate([n, *more[1]]))
        return pd.DataFrame(
            [(int(d["part"].iloc[0]), squeezed_ids(ids), squeezed(n), int(n.sum()), len(ids))],
            columns=["part", "ids", "counts", "total", "different"],
        )

    return rows.groupBy("part").applyInPandas(add, "part int, ids binary, counts binary, total long, different long")


def short_orders(model: DataFrame) -> np.ndarray:
    """Counts of (byte before, byte): a table of 256 x 256, summed by Spark."""

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(65536, dtype=np.int64)
        for batch in batches:
            for ids, counts in zip(batch["ids"], batch["counts"]):
                table += np.bincount(spread_ids(ids) & 0xFFFF, spread(counts), 65536).astype(np.int64)
        at = np.flatnonzero(table)
        yield pd.DataFrame({"pair": at, "n": table[at]})

    rows = model.select("ids", "counts").mapInPandas(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = np.zeros(65536, dtype=np.int64)
    for r in rows.collect():  # at most 65,536 rows
        table[r["pair"]] = r["n"]
    return table.reshape(256, 256)


def _find(sorted_: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted array and whether it is there."""
    if not len(sorted_):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return at, sorted_[at] == values


def code_lengths(asked: np.ndarray, ids: np.ndarray, counts: np.ndarray, pair: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of the last byte of each asked n-gram after the bytes before it.

    ``ids`` and ``counts``: training n-grams that share their last two context bytes with asked ones.
    ``pair``: counts of the one-byte contexts.
    """
    log_p = np.zeros(len(asked))
    todo = np.ones(len(asked), dtype=bool)
    hidden_n = np.zeros(len(asked), dtype=np.int64)  # what the longer contexts exclude from this one
    hidden_t = np.zeros(len(asked), dtype=np.int64)
    levels = []
    code, n = ids, counts
    for k in range(order, 1, -1):
        code, n = _summed(code & ((1 << 8 * (k + 1)) - 1), n)
        levels.append((k, code, n))
    levels.append((1, None, None))

    def use(seen: np.ndarray, total: np.ndarray, kinds: np.ndarray, next_n: np.ndarray) -> None:
        """One order: count of the byte, of its context, bytes seen there, and their count one order down."""
        nonlocal hidden_n, hidden_t
        left = np.maximum(total - hidden_n + kinds - hidden_t, 0)
        live = todo & (total > 0) & (left > 0)
        hit = live & (seen > 0)
        log_p[hit] += np.log(seen[hit] / left[hit])
        miss = live & (seen == 0)
        log_p[miss] += np.log(np.maximum(kinds - hidden_t, 1)[miss] / left[miss])
        todo[hit] = False
        known = total > 0
        hidden_n, hidden_t = np.where(known, next_n, hidden_n), np.where(known, kinds, hidden_t)

    one = pair.reshape(-1)
    for (k, code, n), (_, low_code, low_n) in zip(levels, levels[1:]):
        context = code >> 8
        start = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(code) else np.zeros(0, np.int64)
        down = code & ((1 << 8 * k) - 1)
        below = one[down & 0xFFFF] if low_code is None else low_n[_find(low_code, down)[0]] if len(code) else n
        at, there = _find(context[start], (asked & ((1 << 8 * (k + 1)) - 1)) >> 8)
        spot, seen = _find(code, asked & ((1 << 8 * (k + 1)) - 1))
        if len(code):
            total, lower = np.add.reduceat(n, start), np.add.reduceat(below, start)
            kinds = np.diff(np.append(start, len(code)))
            use(np.where(seen, n[spot], 0), np.where(there, total[at], 0), np.where(there, kinds[at], 0), np.where(there, lower[at], 0))
    before, byte = (asked >> 8) & 0xFF, asked & 0xFF
    zero = pair.sum(axis=0)
    low = ((pair > 0) * zero[None, :]).sum(axis=1)
    use(pair[before, byte], pair.sum(axis=1)[before], (pair > 0).sum(axis=1)[before], low[before])
    empty = np.zeros(len(asked), dtype=np.int64)
    use(zero[byte], empty + zero.sum(), empty + int((zero > 0).sum()), empty)
    log_p[todo] -= np.log(max(1, 257 - int((zero > 0).sum())))  # any other byte, all alike
    return log_p / LN10


class Lookup:
    """Values of many ids: a direct table by hash, a search for the few that share a slot."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.shift = U(64 - max(10, int(len(ids) * 6).bit_length()))
        self.slot = np.zeros(1 << int(64 - int(self.shift)), dtype=np.int32)
        self.slot[self._at(self.ids)] = np.arange(len(ids))

    def _at(self, ids: np.ndarray) -> np.ndarray:
        return ((ids.view(U) * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        at = self.slot[self._at(ids)]
        wrong = np.flatnonzero(self.ids[at] != ids)
        at[wrong] = np.searchsorted(self.ids, ids[wrong])
        return self.values[at]


def scored(docs: DataFrame, training: Column, m: Ppm = Ppm()) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with n_tokens, n_known, train_tokens, base_score and score.

    ``training`` marks the rows to learn from; it must be a function of the row alone. ``base_score`` is a word
    unigram with add-one smoothing over words and one end per text, ``score`` the log10 probability of the bytes of
    the text and its end. Nulls: a null text counts as empty and has only its end; a null doc_id is a document like any
    other. Without any training text every byte costs log10 257. Repeated rows stay and count repeatedly in training.
    An empty table gives an empty table. Other columns are not carried.
    """
    base = docs.select(
        "doc_id", "text", training.cast("boolean").alias("learn"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")
    )
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(size) // m.part))
    table = written(packed(base, F.col("learn"), parts, m), "ppm")
    of = lambda kind: table.where(F.col("kind") == kind)
    words = written(merged(of("train-word").select("part", "ids", "counts")), "ppm-words")
    trie = written(merged(of("train-gram").select("part", "ids", "counts")), "ppm-trie")
    ends = base.where("learn").count()
    n, v = words.agg(F.sum("total"), F.sum("different")).first()
    n, v = int(n or 0) + ends, int(v or 0) + bool(ends)
    pair = docs.sparkSession.sparkContext.broadcast(short_orders(trie))  # 256 x 256 counts
    order = m.order

    def gram_answers(model: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, counts = model_of(model)
        value = lambda q: code_lengths(q, ids, counts, pair.value, order)
        return answered(asked, value)

    def word_answers(model: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        ids, counts = model_of(model)

        def value(q: np.ndarray) -> np.ndarray:
            at, there = _find(ids, q)
            return counts[at] * there if len(ids) else np.zeros(len(q), np.int64)

        return answered(asked, value)

    def model_of(model: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        if not len(model):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return spread_ids(model["ids"].iloc[0]), spread(model["counts"].iloc[0])

    def answered(asked: pd.DataFrame, value) -> pd.DataFrame:
        """The values of what each block asks, in its order, some blocks at a time."""
        out = []
        for at in range(0, len(asked), 32):
            got = [spread_ids(a) for a in asked["ids"].iloc[at : at + 32]]
            all_ = np.unique(np.concatenate(got))
            known = value(all_)
            out += [squeezed(known[np.searchsorted(all_, g)]) for g in got]
        return pd.DataFrame({"block": asked["block"], "part": asked["part"], "counts": out})

    answer = "block long, part int, counts binary"
    ask = lambda kind: of(kind).select("part", "block", "ids").groupBy("part")
    g = trie.groupBy("part").cogroup(ask("gram")).applyInPandas(gram_answers, answer).withColumn("kind", F.lit("gram"))
    w = words.groupBy("part").cogroup(ask("word")).applyInPandas(word_answers, answer).withColumn("kind", F.lit("word"))

    def lookup(answers: pd.DataFrame, kind: str, ids: np.ndarray, part_of: np.ndarray) -> Lookup:
        """The values of the ids of a block, which the parts answered in the order of their ids."""
        mine = answers[answers["kind"] == kind]
        raw = dict(zip(mine["part"].tolist(), mine["counts"]))
        value = np.zeros(len(ids), dtype=np.float64 if kind == "gram" else np.int64)
        for part, (at,) in _cut(np.arange(len(ids)), part_of):
            value[at] = spread(raw[part], value.dtype.type)
        return Lookup(ids, value)

    def score(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for ids, lengths, payload in zip(block["ids"], block["counts"], block["payload"]):
            rows, sizes = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
            data = zstandard.ZstdDecompressor().decompress(payload, max_output_size=int(sizes.sum()) + 1)
            stop = np.cumsum(sizes)
            raw = [data[e - s : e] for s, e in zip(sizes.tolist(), stop.tolist())]
            asked = _unique(raw, lambda t: grams(t, order))[0]
            code = lookup(answers, "gram", asked, _gram_part(asked, parts))
            asked = _unique(raw, _words)[0]
            seen = lookup(answers, "word", asked, _word_part(asked, parts))
            out = []
            for a in range(0, len(rows), 64):
                some, size = raw[a : a + 64], sizes[a : a + 64] + 1
                total = np.add.reduceat(code(grams(some, order)), np.cumsum(size) - size)
                for r, t in zip(some, total.tolist()):
                    own = word_hashes(r.translate(LOWER)).view(np.int64)
                    c = seen(own) if len(own) else np.zeros(0, np.int64)
                    logs = np.log10((c + 1) / (n + v + 1)).sum() + np.log10((ends + 1) / (n + v + 1))
                    out.append((len(own) + 1, int((c > 0).sum()) + bool(ends), float(logs), t))
            frame = pd.DataFrame(out, columns=["n_tokens", "n_known", "base_score", "score"])
            frame.insert(0, "row", rows)
            frames.append(frame)
        return pd.concat(frames).drop_duplicates("row") if frames else pd.DataFrame(columns=["row", "n_tokens", "n_known", "base_score", "score"])

    blocks = of("block").select("block", "ids", "counts", "payload").groupBy("block")
    values = blocks.cogroup(g.union(w).groupBy("block")).applyInPandas(
        score, "row long, n_tokens long, n_known long, base_score double, score double"
    )
    values = values.dropDuplicates(["row"])  # copies of a text have one value
    out = base.select("doc_id", "row").join(values, "row")
    return out.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
