import numpy as np
import pytest
from pyspark.sql import functions as F

from supplylens.llm import queries, whitening
from supplylens.llm.common import read
from supplylens.llm.whitening import Whitening
from tests.conftest import SMALL

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def as_integers(vectors):
    return [[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors]


def check(df, rows, w=Whitening()):
    """``rows``: (vec_id, entries as stored) of the vectors that take part."""
    got = df.collect()
    assert df.columns == NAMES
    x = as_integers([v for _, v in rows])
    n, dim = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    y = np.array([[a - s // n for a, s in zip(r, sums)] for r in x], dtype=float) - np.array([s % n / n for s in sums])
    v = y.T @ y / n
    value, axes = np.linalg.eigh(v)
    value, axes = value[::-1], axes[:, ::-1]
    k = min(w.components, dim, int((value > w.flat * value[0]).sum()))
    assert len(got) == n * k
    deviation = sorted((repr(i), sum((n * a - s) ** 2 for a, s in zip(r, sums))) for (i, _), r in zip(rows, x))
    assert sorted((repr(r["vec_id"]), r["deviation"]) for r in got if r["component"] == 1) == deviation
    assert {r["n"] for r in got} == {n}
    z = np.zeros((n, k))
    place = {}
    for r in sorted(got, key=lambda r: (repr(r["vec_id"]), r["component"])):
        place.setdefault(repr(r["vec_id"]), len(place))
        z[place[repr(r["vec_id"])], r["component"] - 1] = r["whitened"]
        assert abs(r["explained"] / (value[r["component"] - 1] / np.trace(v)) - 1) < 1e-9
    if len(place) == n:
        order = np.argsort([repr(i) for i, _ in rows], kind="stable")
        want = (y @ axes[:, :k] / np.sqrt(value[:k]))[order]
        for c in range(k):
            gap = np.abs(np.delete(value, c) - value[c]).min() / value[0]
            if gap > 1e-6:
                sign = np.sign(want[:, c] @ z[:, c])
                assert np.abs(sign * z[:, c] - want[:, c]).max() < 1e-9 / gap
        assert np.abs(z.T @ z / n - np.outer(z.mean(0), z.mean(0)) - np.eye(k)).max() < 1e-8
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-8


def frame(spark, vectors, first=0):
    rows = [(first + i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), rows


def test_query_on_the_smallest_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, SMALL, "embeddings").collect() if r["embedding"]]
    check(queries.op12_embedding_whitening(spark, SMALL), rows)


@pytest.mark.parametrize("spectrum", ["flat", "steep", "ties"])
def test_spectra(spark, spectrum):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 90))
    if spectrum == "steep":
        x *= 100 * 0.8 ** np.arange(90)
    if spectrum == "ties":  # orthogonal designs: all eigenvalues are equal in pairs or more
        x = np.vstack([np.eye(90) * 3, -np.eye(90) * 3])
    df, rows = frame(spark, x)
    check(whitening.whitened(df), rows)


def test_fewer_dimensions_than_components_and_repeated_rows(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 5)) * [9, 7, 5, 3, 2]
    df, rows = frame(spark, x)
    check(whitening.whitened(df), rows)
    twice = whitening.whitened(df.union(df))
    assert twice.count() == 400 and twice.select("vec_id", "component").distinct().count() == 200


def test_dependent_dimensions_give_fewer_components(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-500, 500, size=(200, 3)) / 64.0
    df, rows = frame(spark, np.hstack([x, x, x[:, :1] * 2]))
    out = whitening.whitened(df)
    assert out.agg(F.max("component")).first()[0] == 3
    check(out, rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(9)
    good = [(int(i), [float(c) for c in rng.normal(size=6)]) for i in range(30)] + [(None, [1.5] * 6), (2**60 + 1, [0.0] * 6)]
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (93, [float("nan")] * 6), (94, [float("inf")] * 6),
           (95, [1.0] * 5), (96, [1e300] * 6)]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + bad, schema).repartition(5)
    df = df.withColumns({c: F.lit("q") for c in ("x", "y", "n", "c", "component", "i", "v0", "whitened")})
    check(whitening.whitened(df), good)


def test_nothing_to_whiten(spark):
    df, _ = frame(spark, [[1.0, 2.0]] * 7)
    for rows in (df, df.limit(1), df.limit(0), df.select("vec_id", F.lit(None).cast("array<double>").alias("embedding"))):
        out = whitening.whitened(rows)
        assert out.columns == NAMES and out.collect() == []


def test_large_entries_have_exact_deviations(spark):
    rng = np.random.default_rng(10)
    df, rows = frame(spark, rng.normal(size=(50, 4)) * 1.2e5)
    check(whitening.whitened(df), rows)
    huge, _ = frame(spark, rng.normal(size=(50, 4)) * 1e12)
    assert huge.count() == 50 and whitening.whitened(huge).where("deviation is not null").count() == 0


def test_iteration_uses_few_columns_and_is_certified():
    rng = np.random.default_rng(11)
    a = rng.normal(size=(800, 300)) * np.linspace(3, 1, 300)
    v = a.T @ a / 800
    widths = []

    def times(q):
        widths.append(q.shape[1])
        return v @ q

    value, axes = whitening.leading(times, 300, Whitening())
    assert set(widths) == {48}
    assert np.abs(v @ axes - axes * value).max() < 1e-10 * value[0]
    assert np.allclose(value, np.linalg.eigvalsh(v)[::-1][:32], rtol=1e-12)


def test_gives_up_when_products_are_wrong():
    rng = np.random.default_rng(12)
    with pytest.raises(ArithmeticError):
        whitening.leading(lambda q: q + 0.1 * rng.normal(size=q.shape), 60, Whitening(patience=5))
