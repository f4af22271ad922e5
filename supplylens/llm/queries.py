"""Registered queries of the corpus operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from supplylens.llm import (
    fingerprint,
    html_extraction,
    language_id,
    mixing,
    nearest,
    ngram_join,
    packing,
    periodic,
    ppm,
    substring_dedup,
    topk,
    url_filter,
    whitening,
)
from supplylens.llm.common import WORD, fold, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_fingerprint(spark, sf_dir):
    return fingerprint.fingerprinted(read(spark, sf_dir, "documents"))


@query
def op2_url_filter(spark, sf_dir):
    return url_filter.judged(read(spark, sf_dir, "pages"))


@query
def op3_substring_dedup(spark, sf_dir):
    found = substring_dedup.removed(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 3) == 1
    found = language_id.identified(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op5_ppm_score(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    found = ppm.scored(docs, ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op6_best_fit_packing(spark, sf_dir):
    return packing.packed(read(spark, sf_dir, "documents"))


@query
def op7_nearest(spark, sf_dir):
    return nearest.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op8_ngram_join(spark, sf_dir):
    found = ngram_join.linked(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


@query
def op9_source_mixing(spark, sf_dir):
    return mixing.mixed(read(spark, sf_dir, "documents"))


@query
def op10_html_extraction(spark, sf_dir):
    return html_extraction.extracted(read(spark, sf_dir, "pages"))


def with_planted_run(doc_id: Column, text: Column) -> Column:
    """The words of every tenth document (by the hash of its id) with a piece of them repeated up to the end.

    With h = crc32 of the id and g = h // 10, the words from a = g % n on become the first p of them over and over. A
    null id leaves the text as it is.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def repeated(row: Column) -> Column:
        a = row["g"] % F.size(row["words"])
        p = 1 + F.floor((F.size(row["words"]) - a) / (3 + row["g"] % 8))
        return F.transform(row["words"], lambda w, i: F.when(i < a, w).otherwise(row["words"][(a + (i - a) % p).cast("int")]))

    rows = F.array(F.struct(words.alias("words"), F.floor(h / 10).alias("g")))  # each is written once in the plan
    edited = F.transform(rows, lambda row: F.when(F.size(row["words"]) > 0, F.array_join(repeated(row), " ")))[0]
    return F.when(h % 10 == 0, F.coalesce(edited, text)).otherwise(text)


@query
def op11_periodic_runs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.collapsed(docs.select("doc_id", with_planted_run(F.col("doc_id"), F.col("text")).alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # structs compare field by field: the longest run, then the first one, then the shortest period
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.expr("(1000 * _best.length) div (-_best.p)").alias("exponent_milli"),
        digest(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


@query
def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


@query
def op13_exact_topk(spark, sf_dir):
    return topk.largest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op13_exact_topk"] = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT query_id, vec_id, score,
    CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
