"""Whitening against the dense eigensolver; exact figures against Python integers."""

import numpy as np
import pytest

from grist.llm import whitening as W
from grist.llm.registry import QUERIES


class Dense:
    def __init__(self, v):
        self.v, self.products = v, 0

    def __matmul__(self, u):
        self.products += 1
        return self.v @ u


def covariance(rows):
    c = rows - rows.mean(0)
    return c.T @ c / len(c)


RNG = np.random.default_rng(5)
CASES = {
    "random": covariance(RNG.standard_normal((200, 64))),
    "wide": covariance(RNG.standard_normal((400, 300))),
    "flat": np.diag(np.linspace(1, 2, 200)),
    "identity": np.eye(64),
    "equal values": np.diag([5.0] * 6 + [1.0] * 30),
    "rank two": covariance(RNG.standard_normal((3, 40))),
    "close values": np.diag(np.concatenate(([1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.5], np.full(60, 0.1)))),
    "one": np.array([[3.0]]),
    "three": covariance(RNG.standard_normal((9, 3))),
}


@pytest.mark.parametrize("name", CASES)
def test_solver_reaches_double_precision(name):
    v, trace = CASES[name], np.trace(CASES[name])
    values, vectors = W.jacobi_davidson(Dense(v), len(v), 4, trace)
    expected = np.sort(np.linalg.eigvalsh(v))[::-1][:4]
    assert len(values) == min(4, len(v)) and np.abs(values - expected).max() < 1e-13 * trace
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() < 5e-14 * trace
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_minres_solves_indefinite_systems():
    a = RNG.standard_normal((20, 20))
    a = (a + a.T) / 2
    b = RNG.standard_normal(20)
    m = W.Minres(b)
    for _ in range(40):
        if m.size < 1e-10 * m.start or m.beta == 0 and m.v_old.any():
            break
        m.step(a @ m.v)
    assert np.linalg.norm(a @ m.x - b) < 1e-7


def check(rows, got, k=4):
    """``rows``: (id, list) that take part; ``got``: collected results."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for _, v in rows], dtype=object)
    fit = np.unique(x.astype(np.int64), axis=0).astype(object)
    n, s = len(fit), fit.sum(0)
    c = (fit * n - s).astype(float) / n
    v = c.T @ c / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    real = (values > 1e-12 * np.trace(v)).sum()
    assert len(got) == real * len(rows)
    table = {}
    for r in got:
        table.setdefault(r.id, {})[r.component] = r
    for (i, _), own in zip(rows, x):
        d = own * n - s
        for j in range(real):
            r = table[i][j + 1]
            assert r.n == n and r.deviation == (d * d).sum()
            assert r.explained == pytest.approx(values[j] / np.trace(v), rel=1e-9) and 0 <= r.identity_error < 1e-9
    for j in range(real):
        plain = np.array([(own * n - s).astype(float) / n @ vectors[:, j] for own in x]) / np.sqrt(values[j])
        mine = np.array([table[i][j + 1].whitened for i, _ in rows])
        assert min(np.abs(plain - mine).max(), np.abs(plain + mine).max()) < 1e-8


def test_query_equals_dense_solution(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(rows, QUERIES["op12_whitening"](spark, sf).withColumnRenamed("vec_id", "id").collect())


def test_defined_cases(spark):
    r = np.random.default_rng(1)
    good = [(i, [float(c) for c in r.standard_normal(6) * [9, 5, 3, 2, 1, 0.5]]) for i in range(40)]
    hot = [(100 + i, good[0][1]) for i in range(60)]                      # copies count once
    bad = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] + [0.0] * 5), (904, [float("inf")] + [0.0] * 5),
           (905, [1e300] + [0.0] * 5), (906, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", 1.0) for i, v in good + hot + bad], "vec_id long, embedding array<double>, x string, component double")
    check(good + hot, W.whiten(df.repartition(3)).collect())


def test_few_dimensions_rank_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    two = [(i, [float(i), float(i % 3)]) for i in range(9)]
    check(two, W.whiten(spark.createDataFrame(two, schema)).collect())
    line = [(i, [float(i), 2.0 * i, -float(i)]) for i in range(5)]        # one component varies
    check(line, W.whiten(spark.createDataFrame(line, schema)).collect())
    assert W.whiten(spark.createDataFrame([], schema)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    assert W.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(i, [float(i) * 1e10, float(i % 7)]) for i in range(50)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all(r.deviation is None for r in got if r.id == 49) and all(abs(r.identity_error) < 1e-6 for r in got)
