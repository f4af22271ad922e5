"""Language identification with a byte convolutional network written in numpy.

Bytes are embedded, filters of several widths run over them, the maximum over the window and a softmax follow.
The network is trained on windows of a bounded sample of labelled documents. For prediction every text is cut
into windows of a fixed length that cover all of it; the filters act through tables of their responses to byte
pairs, so that a window costs a few look-ups per byte, and a document gets the mean of its windows' logits,
weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplylens.llm.common import bounded_batches

#: Verdict on texts without letters.
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """``per_language``: labelled documents used at most for each language, the bound of the training sample."""

    per_language: int = 600
    windows_per_doc: int = 3
    window: int = 160
    embed: int = 8
    filters: int = 12
    widths: tuple[int, ...] = (2, 3, 4)
    steps: int = 1200
    batch: int = 64
    #: texts that reach a task in one Arrow batch
    rows: int = 1_000
    rate: float = 0.004
    seed: int = 11


@dataclass
class Network:
    """``table``: 256 x embed; ``filters``: per width (width*embed) x filters; ``dense``: features x languages."""

    languages: list[str]
    table: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray


def prepared(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def has_letter(text: str | None) -> bool:
    return bool(text) and (text.isalpha() or any(map(str.isalpha, text)))


def sample(docs: DataFrame, usable: Column, s: Settings) -> pd.DataFrame:
    """At most ``per_language`` usable labelled texts a language, those of the smallest hash of their text.

    Hashes are ranked without the texts, and every task first keeps its own smallest ones, so a hot language shuffles
    no more than that; the chosen texts are then fetched by their hash.
    """
    rows = docs.where(usable & F.col("lang").isNotNull() & F.rlike(F.coalesce("text", F.lit("")), F.lit(r"\p{L}")))
    rows = rows.select("lang", F.xxhash64("text", F.lit(s.seed)).alias("h"), "text")
    first = Window.partitionBy("lang").orderBy("h")
    chosen = rows.select("lang", "h").withColumn("n", F.row_number().over(first)).where(F.col("n") <= s.per_language)
    chosen = F.broadcast(chosen.select("lang", "h").distinct())  # per_language numbers for each language
    return rows.join(chosen, ["lang", "h"]).dropDuplicates(["lang", "h"]).select("lang", "text", "h").toPandas()


def train(rows: pd.DataFrame, s: Settings) -> Network:
    """Adam on cross entropy; deterministic for a given sample."""
    rng = np.random.default_rng(s.seed)
    rows = rows.sort_values(["lang", "h", "text"], kind="stable")
    languages = sorted(rows["lang"].unique())
    x, y = [], []
    for lang, text in zip(rows["lang"], rows["text"]):
        raw = prepared(text)
        for _ in range(s.windows_per_doc):
            at = int(rng.integers(0, max(1, len(raw) - s.window + 1)))
            cut = raw[at : at + s.window]
            if rng.random() < 0.3:  # short texts must be known as well
                cut = cut[: int(rng.integers(8, s.window))]
            x.append(np.frombuffer(cut.ljust(s.window, b" "), dtype=np.uint8))
            y.append(languages.index(lang))
    x, y = np.array(x), np.array(y)
    p = [rng.normal(0, 0.3, (256, s.embed))]
    for w in s.widths:
        p += [rng.normal(0, (2 / (w * s.embed)) ** 0.5, (w * s.embed, s.filters)), np.zeros(s.filters)]
    wide = len(s.widths) * s.filters
    p += [rng.normal(0, wide**-0.5, (wide, len(languages))), np.zeros(len(languages))]
    p = [a.astype(np.float32) for a in p]
    first, second = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    order = np.zeros(0, dtype=np.int64)
    for step in range(1, s.steps + 1):
        if len(order) < s.batch:
            order = np.concatenate([order, rng.permutation(len(x))])
        at, order = order[: s.batch], order[s.batch :]
        for a, g, m, v in zip(p, _gradients(p, x[at], y[at], s), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    k = len(s.widths)
    return Network(languages, p[0], p[1 : 1 + 2 * k : 2], p[2 : 2 + 2 * k : 2], p[-2], p[-1])


def _gradients(p: list[np.ndarray], x: np.ndarray, y: np.ndarray, s: Settings) -> list[np.ndarray]:
    n = len(x)
    e = p[0][x]
    pooled, cache = [], []
    for i, w in enumerate(s.widths):
        cols = np.concatenate([e[:, j : x.shape[1] - w + 1 + j] for j in range(w)], axis=2)
        out = cols @ p[1 + 2 * i] + p[2 + 2 * i]
        best = out.argmax(axis=1)
        top = np.take_along_axis(out, best[:, None], 1)[:, 0]
        pooled.append(np.maximum(top, 0))
        cache.append((cols, best, top > 0))
    h = np.concatenate(pooled, axis=1)
    z = h @ p[-2] + p[-1]
    z = np.exp(z - z.max(1, keepdims=True))
    z /= z.sum(1, keepdims=True)
    z[np.arange(n), y] -= 1
    z /= n
    grads = [np.zeros_like(p[0])]
    dh = z @ p[-2].T
    for i, w in enumerate(s.widths):
        cols, best, live = cache[i]
        d = dh[:, i * s.filters : (i + 1) * s.filters] * live
        rows = np.take_along_axis(cols, best[:, :, None], 1)  # n x filters x (w*embed)
        grads += [np.einsum("nfc,nf->cf", rows, d), d.sum(0)]
        back = d[:, :, None] * p[1 + 2 * i].T[None]
        for j in range(w):
            spots = np.take_along_axis(x, best + j, 1)
            np.add.at(grads[0], spots.ravel(), back[:, :, j * s.embed : (j + 1) * s.embed].reshape(-1, s.embed))
    return [g.astype(np.float32) for g in [*grads, h.T @ z, z.sum(0)]]


class Scorer:
    """Prediction of a trained network by look-up tables."""

    def __init__(self, net: Network, s: Settings):
        self.net, self.s = net, s
        single = []
        for w, f in zip(s.widths, net.filters):
            single.append([(net.table @ f[j * s.embed : (j + 1) * s.embed]).astype(np.float32) for j in range(w)])
        #: per width: tables over byte pairs (0: of positions j and j+1) and over single bytes
        self.parts = []
        for w, t in zip(s.widths, single):
            parts = [(j, True, (t[j][:, None] + t[j + 1][None]).reshape(65536, -1)) for j in range(0, w - 1, 2)]
            if w % 2:
                parts.append((w - 1, False, t[w - 1]))
            self.parts.append(parts)

    def logits(self, flat: np.ndarray) -> np.ndarray:
        """Logits of windows given as rows of bytes."""
        n, size = flat.shape
        pair = flat[:, :-1].astype(np.int32) * 256 + flat[:, 1:]
        byte = flat.astype(np.int32)
        pooled = []
        for (w, parts), bias in zip(zip(self.s.widths, self.parts), self.net.biases):
            long = size - w + 1
            total = None
            for j, paired, table in parts:
                got = table[(pair if paired else byte)[:, j : j + long]]
                total = got if total is None else np.add(total, got, out=total)
            pooled.append(np.maximum(total.max(axis=1) + bias, 0))
        return np.concatenate(pooled, axis=1) @ self.net.dense + self.net.offset

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text."""
        size, known = self.s.window, [has_letter(t) for t in texts]
        raw = [prepared(t) if ok else b"" for t, ok in zip(texts, known)]
        counts = np.array([-(-len(r) // size) for r in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(r.ljust(c * size, b" ") for r, c in zip(raw, counts)), dtype=np.uint8).reshape(-1, size)
        owner = np.repeat(np.arange(len(raw)), counts)
        wide = len(self.net.languages)
        total, weight = np.zeros((len(raw), wide)), np.zeros(len(raw))
        for start in range(0, len(flat), 128):
            part, own = flat[start : start + 128], owner[start : start + 128]
            letters = ((part > 64) & (part != 96)).sum(axis=1) + 0.01
            z = self.logits(part) * letters[:, None]
            for k in range(wide):
                total[:, k] += np.bincount(own, z[:, k], len(raw))
            weight += np.bincount(own, letters, len(raw))
        z = total / np.maximum(weight, 1e-9)[:, None]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        best = z.argmax(axis=1)
        names = [self.net.languages[b] if ok else UNDETERMINED for b, ok in zip(best, known)]
        return names, np.where(known, z[np.arange(len(raw)), best], 0.0)


def identified(docs: DataFrame, usable: Column, s: Settings = Settings()) -> DataFrame:
    """``docs`` with the columns lang_pred and score; ``usable`` marks the rows whose text and lang may be learned.

    Nulls: a null text, or one without letters, is ``und`` with score 0; rows with a null lang are predicted but not
    learned from. Without any usable labelled row every text is ``und``. Repeated rows get equal results. An empty
    table gives an empty table. All columns of ``docs`` are kept; old columns lang_pred and score are replaced.
    """
    rows = sample(docs, usable, s)
    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    kept = docs.select([F.col(f"`{f.name}`") for f in fields])
    if rows.empty:
        return kept.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    sent = docs.sparkSession.sparkContext.broadcast(train(rows, s))  # a fixed number of weights per language

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value, s)
        for texts in batches:
            names, score = [], []
            values = texts.tolist()
            for start in range(0, len(values), 256):
                got = scorer(values[start : start + 256])
                names += got[0]
                score.append(got[1])
            yield pd.DataFrame({"lang_pred": names, "score": np.concatenate(score) if score else np.zeros(0)})

    bounded_batches(docs.sparkSession, s.rows)
    return kept.withColumn("_p", predict(F.col("text"))).select(
        *[F.col(f"`{f.name}`") for f in fields], F.col("_p.lang_pred"), F.col("_p.score")
    )
