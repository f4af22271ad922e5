"""From raw documents to packed training sequences: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplylens.llm import language_id, mixing, ngram_join, packing, substring_dedup
from supplylens.llm.common import read, written

#: A document stays if its language is told with this probability.
LEAST_LANGUAGE_SCORE = 0.4


def whole_row(docs: DataFrame, but: str = "") -> Column:
    """All columns of a row in one, so that none can clash with those of a stage; without the column ``but``."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != but]).alias("_row")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Null, empty and letterless texts go, and unsure ones."""
    found = language_id.identified(docs.select("text", "lang", whole_row(docs, but="text")), F.lit(True))
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(sure).select(*["text" if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest (doc_id, hash of the text), null ids last.

    Documents without words are near copies of nothing and stay, repeated rows of them once.
    """
    found = ngram_join.linked(docs)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    best = found.where("class_id is not null").groupBy("class_id").agg(F.min(rank).alias("r"))
    keys = best.select("r.doc_id", "r.text_key").union(found.where("class_id is null").select("doc_id", "text_key"))
    keys = keys.select(F.xxhash64("doc_id", "text_key").alias("_key")).distinct()
    # one key for the row, so that the join and the removal of repeats share a shuffle
    keyed = docs.select(whole_row(docs), F.xxhash64("doc_id", F.xxhash64("text")).alias("_key"))
    return keyed.join(keys, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; those of which nothing is left go.

    A document that loses nothing keeps its text as it is. n_chars follows the text.
    """
    found = substring_dedup.removed(docs.select("doc_id", "text", whole_row(docs, but="text")), carry=["_row"])
    left = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return left.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])


def mixing_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; of repeated rows as many copies as these are given together.

    Texts without words, null ones included, are taken as often as their source is surely; null sources are one source.
    """
    key = F.xxhash64("doc_id", "source", F.xxhash64("text")).alias("_key")
    found = mixing.mixed(docs.select("doc_id", "text", "source", key), carry=["_key"])
    copies = found.groupBy("_key").agg(F.sum("copies").cast("int").alias("_n"))
    taken = docs.select(whole_row(docs), key).dropDuplicates(["_key"]).join(copies.where("_n > 0"), "_key")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select("_row.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands: doc_id, source, piece, start, size, bin_group, bin, used."""
    return packing.packed(docs)


STAGES = [
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mixing", mixing_by_source),
    ("best-fit packing", sequences),
]

#: Language, best fit and the cube method have no SQL form; tests hold every stage against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
