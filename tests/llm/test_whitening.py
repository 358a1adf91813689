import math
from fractions import Fraction

import numpy as np
import pytest

from pricemart.llm import whitening
from pricemart.llm.common import table

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrices():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((24, 24)))
    out = {"one": np.array([[3.0]]), "zero": np.zeros((4, 4)), "identity": 5 * np.eye(6), "diagonal": np.diag([3.0, 1.0, 3.0, 2.0]),
           "equal diagonal": np.ones((7, 7)), "pair": np.array([[2.0, 1.0], [1.0, 2.0]])}
    for name, values in (("spread", np.arange(1.0, 25)), ("decades", 10.0 ** -np.arange(24)), ("twins", np.repeat([4.0, 3.0, 2.0, 1.0], 6)),
                         ("rank three", np.r_[[9.0, 5.0, 1.0], np.zeros(21)]), ("close", 1 + 1e-9 * np.arange(24)), ("signs", np.arange(-12.0, 12))):
        out[name] = (q * values) @ q.T
    x = rng.standard_normal((500, 64)) @ rng.standard_normal((64, 64))
    out["covariance"] = np.cov(x.T)
    return out


@pytest.mark.parametrize("name", matrices())
def test_spectra(name):
    v = matrices()[name]
    v = (v + v.T) / 2
    values, vectors = whitening.spectrum(v)
    norm = np.linalg.norm(v) + 1e-300
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1], rtol=0, atol=1e-14 * norm * len(v))
    assert np.linalg.norm(vectors.T @ vectors - np.eye(len(v))) < 1e-13 * len(v)
    assert np.linalg.norm(v @ vectors - vectors * values) < 1e-14 * norm * len(v)


def test_polar_factors_are_signs():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    values = np.r_[10.0 ** -(np.arange(15) / 2), -(10.0 ** -(np.arange(15) / 2))]
    assert np.abs(whitening.polar((q * values) @ q.T) - (q * np.sign(values)) @ q.T).max() < 1e-7
    values = np.r_[np.arange(1.0, 16), -np.arange(1.0, 16)]
    assert np.abs(whitening.polar((q * values) @ q.T) - (q * np.sign(values)) @ q.T).max() < 1e-13


def brute(rows, most=32):
    """Exact mean, covariance and deviations in whole numbers, numpy's eigenvectors."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(good), len(good[0][1])
    s = [sum(x[j] for _, x in good) for j in range(d)]
    v = np.array([[float(Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for _, x in good), n ** 3)) for j in range(d)] for i in range(d)])
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    real = [k for k in range(min(most, d)) if e[k] > e[0] * 1e-12]
    out = {}
    for i, x in good:
        y = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)])
        out.setdefault(i, []).append((sum((n * a - b) ** 2 for a, b in zip(x, s)), [y @ q[:, k] / math.sqrt(e[k]) for k in real]))
    return n, out, [e[k] / v.trace() for k in real]


def compare(rows, got):
    n, want, explained = brute(rows)
    signs = {}
    by_row = {}
    for r in got:
        assert r.n == n and abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
    assert sum(len(x[1]) for x in by_row.values()) == sum(len(x) for x in want.values())
    for (i, deviation), components in by_row.items():
        mine = [w for dev, w in want[i] if dev == deviation]
        assert mine and sorted(components) == list(range(1, len(explained) + 1))
        for k, values in components.items():
            for value in values:
                if abs(value) > 1e-6:
                    signs.setdefault(k, np.sign(value) * np.sign(mine[0][k - 1]))
                assert abs(value - signs.get(k, 1) * mine[0][k - 1]) < 1e-6


def test_report_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    scales = np.array([9.0, 6.0, 4.0, 3.0, 2.0])
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * scales]) for i in range(80)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (81, rows[5][1])]                                         # repeated, null id, copy
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0, 0.0]), (92, [float("nan")] * 5), (93, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (94, []),
           (95, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).withColumnRenamed("label", "whitened").repartition(4)
    got = whitening.report(frame).collect()
    compare(rows, got)
    assert whitening.report(frame).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    white, fit = whitening.whiten(frame, most=2)
    assert white.columns == ["vec_id", "embedding", "whitened", "_whitened", "deviation"] and fit.n == 83
    assert all(len(r._whitened) == 2 for r in white.collect())


def test_the_table(spark):
    t = table(spark, SF, "embeddings")
    got = whitening.report(t).collect()
    rows = [(r.vec_id, r.embedding) for r in t.select("vec_id", "embedding").collect()]
    assert len(got) == 32 * len(rows)
    n, want, explained = brute(rows[:0] or rows)
    assert {r.deviation for r in got if r.vec_id == rows[0][0]} == {want[rows[0][0]][0][0]}
    assert all(abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9 and r.n == n for r in got)


def test_no_rows_or_no_spread(spark):
    for rows in ([], [(1, None, 0), (2, [], 0)], [(1, [float("nan")], 0)]):
        assert whitening.report(spark.createDataFrame(rows, SCHEMA)).collect() == []
    assert whitening.report(spark.createDataFrame([(1, [2.0, 3.0], 0), (2, [2.0, 3.0], 0)], SCHEMA)).collect() == []
    flat = whitening.report(spark.createDataFrame([(i, [float(i), 7.0], 0) for i in range(5)], SCHEMA)).collect()
    assert {r.component for r in flat} == {1} and len(flat) == 5 and all(abs(r.explained - 1) < 1e-12 for r in flat)


def test_sums_are_exact_for_large_entries(spark):
    rows = [(i, [1e12 * (i % 7) + i, -3e9 * i], 0) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = whitening.fit(frame.select("embedding").repartition(3))
    xs = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v, _ in rows]
    assert got.total == [sum(x[j] for x in xs) for j in range(2)]
    n = len(xs)
    want = [[float(Fraction(sum((n * x[i] - got.total[i]) * (n * x[j] - got.total[j]) for x in xs), n ** 3)) for j in range(2)] for i in range(2)]
    assert got.covariance.tolist() == want
