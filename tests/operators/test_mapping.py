import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from furlong.operators import mapping as M


def test_isotonic_pools_descents():
    assert M.isotonic([1.0, 3.0, 2.0, 4.0], [1, 1, 1, 1]) == [1.0, 2.5, 2.5, 4.0]
    assert M.isotonic([3.0, 2.0, 1.0], [1, 1, 2]) == [1.75] * 3
    assert M.isotonic([], []) == []
    rng = random.Random(4)
    y, w = [rng.gauss(i / 5, 1) for i in range(40)], [rng.randint(1, 9) for _ in range(40)]
    fit = M.isotonic(y, w)
    # min-max formula: the greatest over starts of the least over ends of the mean between
    best = [max(min(np.average(y[a : b + 1], weights=w[a : b + 1]) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert fit == pytest.approx(best)


def test_smoothing_spline():
    x = np.linspace(0, 10, 60)
    straight = M.smoothing_spline(x, 2 * x + 1, 0.5)
    assert straight(np.array([-5.0, 0.0, 3.3, 10.0, 20.0])) == pytest.approx([-9.0, 1.0, 7.6, 21.0, 41.0], abs=1e-3)
    y = np.sin(x) + np.random.default_rng(1).normal(0, 0.2, 60)
    curve = M.smoothing_spline(x, y, 60 * 0.04)
    assert ((curve(x) - y) ** 2).sum() == pytest.approx(60 * 0.04, rel=1e-3)
    # the same by the eigenvectors of the curvature of natural splines, with the penalty that leaves the same residual
    h = x[1] - x[0]
    second, mass = np.zeros((58, 60)), np.zeros((58, 58))
    for j in range(58):
        second[j, j : j + 3] = 1 / h, -2 / h, 1 / h
        mass[j, max(0, j - 1) : j + 2] = h / 6
        mass[j, j] = 2 * h / 3
    values, vectors = np.linalg.eigh(second.T @ np.linalg.inv(mass) @ second)
    shrunk = lambda k: vectors @ ((vectors.T @ y) / (1 + k * values))
    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if ((shrunk(middle) - y) ** 2).sum() <= 60 * 0.04 else (low, middle)
    assert curve(x) == pytest.approx(shrunk(low), abs=1e-4)
    exact = M.smoothing_spline(x, np.sin(x), 0.0)
    assert exact(x) == pytest.approx(np.sin(x), abs=1e-6)
    step = 1e-5
    for k in x[1:-1]:  # one slope at each knot
        left, at, right = exact(np.array([k - step, k, k + step]))
        assert (at - left) / step == pytest.approx((right - at) / step, abs=1e-3)


def test_smoothed_cdf_of_one_cell_is_normal():
    counts = np.zeros(2001)
    counts[1000] = 50
    cdf = M.smoothed_cdf(counts, 0.01, 1.0)
    want = [0.5 * (1 + math.erf((i - 1000) * 0.01 / math.sqrt(2))) for i in (900, 1000, 1150)]
    assert [cdf[i] for i in (900, 1000, 1150)] == pytest.approx(want, abs=3e-3) and cdf[-1] == 1


def test_grids():
    assert len(M.banded_grid(*M.TAILS)) == 20 + 45 + 21 and len(M.banded_grid(*M.FAR_TAILS)) == 20 + 16 + 40 + 16 + 21
    assert all(g == sorted(g) and g[0] == 0 and g[-1] == 1 for g in (M.banded_grid(*M.TAILS), M.banded_grid(*M.FAR_TAILS), M.beta_grid(100, 0.3), M.even_grid(7)))
    for x in (0.01, 0.2, 0.5, 0.77, 0.999):
        assert M.beta_share(x, 0.5) == pytest.approx(2 / math.pi * math.asin(math.sqrt(x)))
        assert M.beta_share(x, 1.0) == pytest.approx(x)
        assert M.beta_share(x, 2.0) == pytest.approx(3 * x**2 - 2 * x**3)


def rows(n=6000):
    rng = random.Random(9)
    out = []
    for i in range(n):
        truth, surface = rng.gauss(60, 20), rng.choice(["turf", "sand"])
        shrunk = 60 + (truth - 60) * (0.6 if surface == "turf" else 0.8) + rng.gauss(0, 3)
        out.append((surface, shrunk, truth, i % 3 != 0))
    return [*out, ("rare", 1.0, 2.0, True), ("rare", 1.0, 3.0, False), ("turf", None, 1.0, True), ("turf", 50.0, None, False), (None, 7.0, 8.0, False)]


def test_summaries_and_bake_off(spark):
    said = rows()
    df = spark.createDataFrame(said, "surface string, x double, y double, fit boolean").repartition(4)
    found = M.summaries(df.where("fit and x is not null and y is not null"), "surface", "x", "y", 1000)
    assert set(found) == {"turf", "sand"}
    for g, s in found.items():
        a, b = (np.array([r[k] for r in said if r[0] == g and r[3] and None not in r]) for k in (1, 2))
        assert s.n == len(a) == s.cells[0].sum() == s.cells[1].sum() and s.spread == pytest.approx((a.std(), b.std()))
        assert [s.x_at[q] for q in (0.0, 0.25, 1.0)] == pytest.approx(np.percentile(a, [0, 25, 100]))
        for n in (M.BINS, M.BIAS_BINS):
            edges = np.unique(np.percentile(a, np.linspace(0, 100, n + 1)))[1:-1]
            at = np.searchsorted(edges, a, "right")
            assert s.bins[n] == pytest.approx(np.array([((at == c).sum(), a[at == c].mean(), b[at == c].mean()) for c in np.unique(at)]))
        whole = sorted(zip(a, b, strict=True))
        assert M.tanh_stretch(s)(np.array([60.0]))[0] == pytest.approx(b.mean() + (60 - a.mean()) * (1 + (b.std() / a.std() - 1) * math.tanh(abs(60 - a.mean()) / a.std() * 1.5)))
        assert M.quantile_curve(M.even_grid(50))(s)(np.array([whole[0][0]]))[0] == pytest.approx(b.min())
    scores = {r.method: r for r in M.bake_off(df, "surface", "x", "y", F.col("fit")).collect()}
    assert set(scores) == {*M.METHODS, *M.CORRECTED}
    held = [r for r in said if not r[3] and None not in r[1:3]]
    assert {r.n for r in scores.values()} == {len(held)}
    assert scores["none"].mae == pytest.approx(np.mean([abs(r[1] - r[2]) for r in held]))
    for name, r in scores.items():
        assert r.mae < (scores["none"].mae if name != "none" else 100), name
    assert scores["isotonic"].rmse < scores["none"].rmse - 1 and abs(scores["pchip_50"].bias) < 1


def test_too_few_rows_keep_their_values(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0, True), ("a", 2.0, 5.0, False)], "surface string, x double, y double, fit boolean")
    assert {(r.mae, r.n) for r in M.bake_off(df, "surface", "x", "y", F.col("fit")).collect()} == {(3.0, 1)}
    assert M.bake_off(df.where("false"), "surface", "x", "y", F.col("fit")).count() == 0
