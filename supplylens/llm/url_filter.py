"""URL filter: rules first, then the ratio of two character language models.

Two variable-order Markov models, one of accepted and one of rejected addresses, are counted by Spark over
all labelled addresses. Counts are exact: a character with its context is one number, and the counts are a table by
that number, at any size of the corpus. Blocks of addresses ask for the n-grams they contain, each once. An address
scores the difference of its log-likelihoods divided by its length; the threshold is calibrated on a histogram of the
labelled scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplylens.llm.common import written

#: The rules of the query contract: (verdict, host and path prefix).
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@dataclass(frozen=True)
class Markov:
    """Settings of the character models; an ``order`` above 6 does not fit the number of an n-gram."""

    order: int = 5
    prior: float = 1.0
    bins: int = 4001
    span: float = 8.0
    #: addresses that ask for n-grams together, on average
    block: int = 20_000


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of ``url``; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _grams(texts: Sequence[str], m: Markov) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number of each character, text lengths, and the number of each character with its longest context.

    The character is the lowest byte, the one before it the next; the n-gram of order k is the lowest k + 1 bytes.
    """
    raw = [t.encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    code = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(raw)), size)
    place = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    gram = code.copy()
    for k in range(1, m.order + 1):
        before = np.zeros(len(code), dtype=np.int64)
        before[k:] = code[:-k]
        before[place < k] = 0  # a context that reaches over the start is padded
        gram |= before << (8 * k)
    return owner, size, gram


def asked_grams(rows: DataFrame, m: Markov) -> DataFrame:
    """block, gram and how often it stands in accepted and in rejected addresses of the block (allow, reject)."""

    def count(d: pd.DataFrame) -> pd.DataFrame:
        owner, _, gram = _grams(d["address"].tolist(), m)
        grams, at = np.unique(gram, return_inverse=True)
        verdict = d["verdict"].to_numpy()
        out = {"block": np.full(len(grams), d["block"].iloc[0]), "gram": grams}
        for name, kind in (("allow", "allow"), ("reject", "block")):
            out[name] = np.bincount(at[(verdict == kind)[owner]], minlength=len(grams))
        return pd.DataFrame(out)

    return rows.select("block", "address", "verdict").groupBy("block").applyInPandas(
        count, "block long, gram long, allow long, reject long"
    )


def gram_values(asked: DataFrame, m: Markov) -> DataFrame:
    """gram and value: log-likelihood difference of its character after its context, accepted minus rejected.

    The shorter context is the prior of the longer one. A context has at most 256 characters, and a shorter n-gram at
    most 256 that are one longer, so no key of these joins and windows is hot.
    """
    counts = [asked.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("reject").alias("reject"))]
    counts[0] = written(counts[0], "url-counts")
    for k in range(m.order - 1, -1, -1):
        shorter = counts[0].withColumn("gram", F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1))
        counts.insert(0, shorter.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("reject").alias("reject")))
    known = None
    for k, level in enumerate(counts):
        context = Window.partitionBy(F.shiftright("gram", 8))
        level = level.withColumns({"of_allow": F.sum("allow").over(context), "of_reject": F.sum("reject").over(context)})
        if known is None:
            level = level.withColumns({"p_allow": F.lit(1 / 256), "p_reject": F.lit(1 / 256)})
        else:
            level = level.withColumn("low", F.col("gram").bitwiseAND((1 << 8 * k) - 1)).join(known, "low")
        p = lambda v: (F.col(v) + m.prior * F.col(f"p_{v}")) / (F.col(f"of_{v}") + m.prior)
        known = level.select(F.col("gram").alias("low"), p("allow").alias("p_allow"), p("reject").alias("p_reject"))
    return known.select(F.col("low").alias("gram"), (F.log("p_allow") - F.log("p_reject")).alias("value"))


def with_scores(rows: DataFrame, asked: DataFrame, m: Markov) -> DataFrame:
    """``rows`` with ``score``: length-normalised log-likelihood difference in nats per character, 0 if empty."""
    answers = asked.select("block", "gram").join(gram_values(asked, m), "gram").select("block", "gram", "value")

    def score(d: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(d):
            return d.assign(score=pd.Series(dtype="float64"))
        known = known.sort_values("gram")
        values = d["address"].tolist()
        owner, size, gram = _grams(values, m)
        value = known["value"].to_numpy()[np.searchsorted(known["gram"].to_numpy(), gram)]
        got = np.bincount(owner, value, len(values)) / size
        got[[not v for v in values]] = 0.0
        return d.assign(score=np.round(got, 9))

    kind = rows.schema["page_id"].dataType
    plain = rows.withColumn("page_id", F.col("page_id").cast("string"))  # a null among numbers would make them floats
    schema = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    out = plain.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, schema)
    return out.withColumn("page_id", F.col("page_id").cast(kind))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, m: Markov = Markov()) -> DataFrame:
    """Verdict per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, score.

    Nulls: a null url has empty host and path and no rule, and is judged by its score like any address without
    evidence: score 0. Repeated rows stay repeated. With only one kind of labelled address, or none, every
    unlabelled address is allowed. An empty table gives an empty table. Other columns are not carried.
    """
    base = pages.select(F.col("page_id"), F.col("url").alias("_url"))
    host, path = split_url(F.col("_url"))
    base = base.withColumns({"host": host, "path": path}).drop("_url")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "verdict": verdict, "address": F.concat("host", "path")})
    blocks = max(1, -(-base.count() // m.block))
    base = base.withColumn("block", F.pmod(F.xxhash64("page_id", "address"), F.lit(blocks)).cast("long"))
    scored = written(with_scores(base, written(asked_grams(base, m), "url-grams"), m), "url-scores")
    cut = calibrated(scored, m)
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"),
        "score",
    )


def calibrated(scored: DataFrame, m: Markov) -> float:
    """The cut on ``score`` with the smallest sum of both error rates on all labelled rows, from a histogram."""
    at = F.floor((F.least(F.greatest("score", F.lit(-m.span)), F.lit(m.span)) + m.span) / (2 * m.span) * (m.bins - 1))
    rows = scored.where(F.col("verdict").isNotNull()).groupBy("verdict", at.alias("bin")).count().toPandas()
    hist = {v: np.zeros(m.bins) for v in ("allow", "block")}
    for verdict, bin_, n in rows.itertuples(index=False):
        hist[verdict][int(bin_)] += n
    if not (hist["allow"].any() and hist["block"].any()):
        return float("-inf")
    below_allow = np.concatenate([[0], np.cumsum(hist["allow"])]) / hist["allow"].sum()
    above_block = 1 - np.concatenate([[0], np.cumsum(hist["block"])]) / hist["block"].sum()
    loss = below_allow + above_block
    best = np.flatnonzero(loss == loss.min())
    edge = float(best[len(best) // 2])  # the middle of the best cuts
    return edge / (m.bins - 1) * 2 * m.span - m.span
