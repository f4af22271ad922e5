import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from supplylens.llm import queries, topk
from supplylens.llm.common import read
from supplylens.llm.topk import Search
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=5, every=50):
    """(query, rank, id, score) over different (id, vector) rows, in Python integers."""
    whole = sorted({(i, tuple(int(np.floor(256 * np.float64(x))) for x in v)) for i, v in rows})
    out = []
    for own in sorted({i for i, _ in whole if i % every == 0}):
        scores = [
            (-sum(a * b for a, b in zip(q, c)), i) for j, q in whole if j == own for i, c in whole if i != own
        ]
        out += [(own, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def found(df, **kw):
    out = topk.largest(df, F.col("vec_id") % 50 == 0, **kw)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], SCHEMA).repartition(5)


def test_query_gives_the_rows_of_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = sorted(con.sql(queries.SQL["op13_exact_topk"]).fetchall())
    got = queries.op13_exact_topk(spark, SMALL)
    assert sorted(tuple(r) for r in got.collect()) == want
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, SMALL, "embeddings").collect() if r["embedding"]]
    assert want == brute(rows)


@pytest.mark.parametrize("kind", ["random", "ties", "clusters", "steep"])
def test_matches_a_scan_at_every_cut(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(420, 21))
    if kind == "ties":
        x = rng.integers(-1, 2, size=(420, 21)) / 64
    if kind == "clusters":
        x = x[:6][rng.integers(0, 6, 420)] + 0.01 * x
    if kind == "steep":
        x *= 0.5 ** np.arange(21)
    rows = list(enumerate(x))
    df, want = frame(spark, rows), brute(rows)
    small = Search(width=4, together=2, pilot=20, chunk=37, cell=90, entries=60)
    for s in (Search(), small, Search(pilot=2, width=21)):
        assert found(df, s=s) == want


def test_survivors_shrink_and_blocks_are_left_out():
    """On vectors whose mass is in few dimensions nearly all are dropped after the first blocks."""
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(size=(2000, 32)) * 0.6 ** np.arange(32)).astype(np.int64)
    layout = topk.Layout(list(range(32)), int(np.abs(v).max()), 4)
    q, ids = v[:10], np.arange(2000)
    floor = topk.first_floors(layout.exact(q), ids[:10], layout.exact(v[:300]), ids[:300], 5)
    left = topk.remainders(v, layout.cuts).T
    hits, survivors = topk.search_chunk(layout.exact(q), ids[:10], floor, ids, layout.columns(layout.packed(v)), left, layout.cuts, 5)
    assert survivors[0] == 2000 and survivors[2] < 600 and survivors[-1] < 200
    for i, (near, score) in enumerate(hits):
        full = (v @ v[i])
        order = sorted((-int(s), j) for j, s in enumerate(full) if j != i)[:5]
        assert [(-int(s), int(j)) for j, s in zip(near, score)] == order


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).tolist()) for i in range(49, 160)] + [(0, [0.0] * 4), (2**60, [1.0] * 4), (2**60 + 2, [2.0] * 4)]
    good += [(100, [3.0, 1.0, 0.0, 0.0]), (101, [9.0, 9.0, 9.0, 9.0]), good[7], good[7]]
    nan, inf = float("nan"), float("inf")
    bad = [(None, [9.0] * 4), (1000, None), (1050, []), (1100, [1.0, None, 1.0, 1.0]), (1150, [nan] * 4), (1200, [inf] * 4),
           (1250, [1.0] * 3), (1300, [1e300] * 4)]
    df = spark.createDataFrame(good + bad, SCHEMA).repartition(4)
    df = df.withColumns({c: F.lit("q") for c in ("v", "x", "j", "ids", "block", "cell", "score", "rank", "query_id")})
    assert found(df) == brute(good)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 0.5]), (50, [1.0, 1.0])]
    df = frame(spark, rows)
    assert found(df) == brute(rows)
    assert found(df.where("vec_id = 0")) == [] and found(df.limit(0)) == []
    assert found(df.where("vec_id = 1")) == []
    assert found(df.withColumn("embedding", F.lit(None).cast("array<double>"))) == []


def test_large_entries_are_exact(spark):
    """Products beyond 2**53, and scores beyond a long."""
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=5) * 3e5) for i in range(60)]
    assert found(frame(spark, rows)) == brute(rows)
    rows = [(i, rng.normal(size=5) * 1e12) for i in range(60)]
    want = [(q, r, i, s if abs(s) < 2**63 else None) for q, r, i, s in brute(rows)]
    got = found(frame(spark, rows))
    assert len(got) == len(want) and {r[3] for r in got} == {None}
