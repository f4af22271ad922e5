import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from supplylens.llm import periodic, queries
from tests.conftest import SMALL
from tests.llm import brute


def runs_of(texts, r=periodic.Runs()):
    return [[tuple(x) for x in found.tolist()] for found in periodic.all_runs([np.array(t, dtype=np.int64) for t in texts], r)]


@st.composite
def repetitive(draw):
    """A text of pieces that are powers of short words, with a change here and there."""
    out = []
    for _ in range(draw(st.integers(1, 4))):
        piece = draw(st.lists(st.integers(0, 2), min_size=1, max_size=draw(st.integers(1, 24))))
        out += (piece * draw(st.integers(1, 9)))[: draw(st.integers(1, 150))]
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(repetitive(), min_size=1, max_size=4), st.sampled_from([2, 4, 8]))
def test_runs_match_all_lags(texts, scan):
    assert runs_of(texts, periodic.Runs(scan=scan)) == [brute.word_runs(t) for t in texts]


def test_long_periods_and_neighbouring_texts():
    rng = random.Random(5)
    texts = []
    for period in (1, 7, 8, 15, 16, 17, 100, 255, 256, 700):
        piece = [rng.randint(0, 10**6) for _ in range(period)]
        head = [rng.randint(0, 10**6) for _ in range(rng.randint(0, 60))]
        texts += [head + piece * 4 + head, (piece * 5)[:-1], (piece * 4)[:-1], piece]
    assert runs_of(texts) == [brute.word_runs(t) for t in texts]
    assert runs_of(texts, periodic.Runs(scan=2)) == runs_of(texts)


def test_words_in_thue_morse_order():
    """Two orders of the same two words, whose polynomial hashes modulo a power of two would be equal."""
    order = [bin(i).count("1") % 2 for i in range(4096)]
    texts = [order, [1 - x for x in order], (order + [1 - x for x in order]) * 2, order[:1024] * 5]
    assert runs_of(texts) == [brute.word_runs(t) for t in texts]


def test_a_hash_that_says_too_much_is_put_right(monkeypatch):
    """With all pieces under one hash the words alone decide."""
    text = [1, 2, 3] * 3 + [9] + [4, 5, 6, 7, 8, 9, 10, 11, 12] * 4 + [1]
    monkeypatch.setattr(periodic, "mix", lambda x: x * np.uint64(0))
    got = runs_of([text])[0]
    assert set(got) <= set(brute.word_runs(text))


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.Runs(times=3)


def expected(df):
    return sorted((brute.run_digest(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def digest_of(spark, df, tmp_path):
    path = str(tmp_path / "sf")
    df.write.parquet(f"{path}/documents.parquet")
    return sorted((tuple(r) for r in queries.op11_periodic_runs(spark, path).collect()), key=repr)


def test_query_on_the_smallest_table(spark, documents):
    got = queries.op11_periodic_runs(spark, SMALL)
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(documents)


def test_query_on_odd_rows(spark, odd_documents, tmp_path):
    assert digest_of(spark, odd_documents, tmp_path) == expected(odd_documents)


def test_empty_table(spark, no_documents, tmp_path):
    assert digest_of(spark, no_documents, tmp_path) == []


def test_collapsed_text_keeps_one_period(spark):
    df = spark.createDataFrame([(2**60 + 1, "x " + "so it goes " * 6 + "y"), (None, "a a a a a a"), (3, "a a a a a")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic.collapsed(df).collect()}
    assert got[2**60 + 1]["collapsed"] == "x so it goes y"
    assert [tuple(s) for s in got[2**60 + 1]["runs"]] == [(1, 18, 3)]
    assert got[None]["collapsed"] == "a" and got[3]["collapsed"] == "a a a a a"


def test_blocks_do_not_change_results(spark, documents):
    key = lambda df: sorted(df.select("doc_id", F.col("runs").cast("string"), "collapsed").collect(), key=repr)
    assert key(periodic.collapsed(documents)) == key(periodic.collapsed(documents, periodic.Runs(block=500)))
