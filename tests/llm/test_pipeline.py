from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from supplylens.llm import mixing
from tests.conftest import SMALL
from tests.llm import brute


def docs_of(df):
    return [r.asDict() for r in df.collect()]


def check_stages(spark, docs):
    """Each stage on what the one before it kept, against plain versions."""
    stages = dict(corpus_pipeline.STAGES)
    first = docs_of(docs)
    docs = corpus_pipeline.written(stages["language ID"](spark, docs, SMALL), "t")
    kept = docs_of(docs)
    assert docs.columns and {r["doc_id"] for r in first if any(c.isalpha() for c in r["text"] or "")} >= {r["doc_id"] for r in kept}
    assert not [r for r in kept if not any(c.isalpha() for c in r["text"])]

    groups = defaultdict(list)
    for (d, n, c), r in zip(brute.join_components([(r["doc_id"], r["text"]) for r in kept]), kept):
        groups[c if n else ("none", d)].append(r)
    docs = corpus_pipeline.written(stages["near duplicates"](spark, docs, SMALL), "t")
    single = docs_of(docs)
    assert Counter(r["doc_id"] for r in single) == Counter(min((r["doc_id"] for r in g if r["doc_id"] is not None), default=None) for g in groups.values())

    want = []
    for r, (n, gone, text) in zip(single, brute.removed_words([r["text"] for r in single])):
        if gone < n or not n:
            want.append((r["doc_id"], text if gone else r["text"]))
    docs = corpus_pipeline.written(stages["repeated passages"](spark, docs, SMALL), "t")
    clean = docs_of(docs)
    assert Counter(want) == Counter((r["doc_id"], r["text"]) for r in clean)
    assert all(r["n_chars"] == len(r["text"]) for r in clean)

    copies = Counter()
    for r in mixing.mixed(docs.withColumn("_key", F.xxhash64("doc_id", "source", F.xxhash64("text"))), carry=["_key"]).collect():
        copies[r["doc_id"]] += r["copies"]
    docs = corpus_pipeline.written(stages["source mixing"](spark, docs, SMALL), "t")
    mixed = docs_of(docs)
    assert Counter(r["doc_id"] for r in mixed) == +copies

    words = Counter()
    for r in mixed:
        words[r["doc_id"]] += len(brute.WORD.findall(r["text"]))
    packed = stages["best-fit packing"](spark, docs, SMALL).collect()
    placed = Counter()
    for r in packed:
        placed[r["doc_id"]] += r["size"]
    assert placed == +words and all(r["used"] <= 2048 for r in packed)
    return len(packed)


def test_stages_on_the_small_table(spark, documents):
    assert check_stages(spark, documents) > 50


def test_stages_on_odd_rows(spark, odd_documents):
    check_stages(spark, odd_documents)


def test_columns_with_the_names_of_helpers_keep_their_values(spark, odd_documents):
    names = ["_key", "_n", "_copy", "_p", "_r", "_row", "score", "lang_pred", "copies", "kept"]
    docs = odd_documents.withColumns({c: F.lit("own " + c) for c in names})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "t")
        assert docs.columns == columns
        rows = docs.select(names).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple("own " + c for c in names)], name


def test_pipeline_of_an_empty_table(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "t")
    assert docs.count() == 0


def test_run_equals_the_stages(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 50
