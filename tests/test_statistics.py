"""Finalizer arithmetic against published vectors and closed forms (no Spark)."""

import math

import numpy as np
import pytest

from estimand.functions import dist
from estimand.functions.formula import read_iv, read_metric, read_model
from estimand.operators.ks import asymptotic_p, exact_p, ks_p_value
from estimand.operators.regress import solve
from estimand.operators.srm import chi_square
from estimand.operators.ttest import MetricStats, adjusted_pair, t_tail
from estimand.operators.xexpt import power_at, sample_size
from estimand.plans.moments import Moments, invert


def moments_of(x):
    x = np.asarray(x, float)
    d = x - x.mean(axis=0)
    return Moments(len(x), x.mean(axis=0), d.T @ d)


# ---- golden vectors ----

@pytest.mark.parametrize("ratios, chi2", [((1, 2), 9.673e7), ((1, 20), 3.122e9), ((1.2, 2.3), 8.571e7)])
def test_srm_golden(ratios, chi2):
    got, p, message = chi_square([333186776.0, 312839437.0], list(ratios))
    assert got == pytest.approx(chi2, rel=2e-4) and p == 0 and message is None


def test_srm_messages():
    assert chi_square([1.0, 2.0], [1])[2] and chi_square([], [])[2] and chi_square([1.0, 2.0], [1, -1])[2]
    assert chi_square([1.0, 2.0], [1, 0])[2] and chi_square([5.0, 5.0], [1, 1])[2]


def test_matrix_inverse_golden():
    got = invert([[10084817, 2263711], [2263711, 645240]])
    assert got[0] == pytest.approx([4.6663876038472666e-7, -1.6371199784719947e-6], rel=1e-9)
    assert got[1, 1] == pytest.approx(7.293358290848084e-6, rel=1e-9)
    with pytest.raises(ValueError):
        invert([[1.0, 2.0], [2.0, 4.0]])


@pytest.mark.parametrize("alternative, d, p", [
    ("two-sided", 0.0011771460569102998, 0.9463332283360488),
    ("less", 0.00017325088037367653, 0.9879951241446749),
    ("greater", 0.0005790931664269028, 0.8749589090661597),
])
def test_ks_golden(alternative, d, p):
    assert ks_p_value(d, 396774, 396426, alternative) == pytest.approx(p, abs=1e-9)


def test_t_tail_golden():
    two = t_tail(-50.589793, 70.303156, 396774)
    assert two["t_statistic"] == pytest.approx(-0.719595, abs=1e-6)
    assert two["p_value"] == pytest.approx(0.471774, abs=1e-6)
    assert two["lower"] == pytest.approx(-188.381868, abs=2e-6)
    assert two["upper"] == pytest.approx(87.202282, abs=2e-6)
    less = t_tail(-50.589793, 70.303156, 396774, "less")
    assert less["p_value"] == pytest.approx(0.235887, abs=1e-6)
    assert less["lower"] == -math.inf and less["upper"] == pytest.approx(65.048879, abs=2e-6)
    greater = t_tail(-50.589793, 70.303156, 396774, "greater")
    assert greater["upper"] == math.inf and greater["lower"] == pytest.approx(-166.228465, abs=2e-6)
    # alpha is a significance level
    assert t_tail(-61.587158, 69.737975, 396774, "less", 0.95)["upper"] == pytest.approx(-176.296187, abs=3e-6)
    assert t_tail(1.0, 2.0, 100, alpha=0)["upper"] == 0.0


def test_power_and_sample_size_golden():
    assert power_at(892.0711, 155.295243 / 1.554852, 0.004, 0.03) == pytest.approx(0.030105, abs=2e-6)
    assert power_at(467.869635, 50.696598 / 0.042320, 0.4, 0.3) == pytest.approx(0.305875, abs=2e-5)
    assert power_at(839.739439, 50.589793 / 0.263640, 0.4, 0.3) == pytest.approx(0.765056, abs=1e-5)
    n = sample_size(7.978e4, 9.077e4, 396774, 396426, 839.739439, 0.3, 0.4, 0.12)
    assert n == pytest.approx(2483, abs=2)


# ---- distributions ----

@pytest.mark.parametrize("p, df, q", [(0.975, 1, 12.706204736), (0.975, 10, 2.228138852), (0.95, 120, 1.657650899),
                                      (0.975, 1e6, 1.959966357), (0.025, 10, -2.228138852)])
def test_t_quantile(p, df, q):
    assert dist.t_ppf(p, df) == pytest.approx(q, abs=2e-9)
    assert dist.t_cdf(dist.t_ppf(p, df), df) == pytest.approx(p, abs=1e-12)


def test_large_df_agrees_with_beta():
    for t in (0.3, 1.96, 4.0):
        exact = 0.5 * dist.beta_inc(2e5 / 2, 0.5, 2e5, t * t)
        assert dist.t_sf(t, 2e5) == pytest.approx(exact, rel=1e-9)


def test_chi2_and_f():
    assert dist.chi2_sf(3.0, 2) == pytest.approx(math.exp(-1.5), rel=1e-13)
    assert dist.chi2_sf(30.0, 4) == pytest.approx(math.exp(-15) * 16, rel=1e-12)
    assert dist.f_sf(4.0, 1, 10) == pytest.approx(2 * dist.t_sf(2.0, 10), rel=1e-12)
    assert dist.f_sf(1.3, 2, 1e9) == pytest.approx(math.exp(-1.3), rel=1e-7)


# ---- Kolmogorov-Smirnov ----

def brute_exact(d, n1, n2, two_sided):
    """Share of all interleavings whose largest gap reaches d."""
    from itertools import combinations

    hits = total = 0
    for chosen in combinations(range(n1 + n2), n1):
        chosen, i, j, top, low = set(chosen), 0, 0, 0.0, 0.0
        for s in range(n1 + n2):
            i, j = (i + 1, j) if s in chosen else (i, j + 1)
            top, low = max(top, i / n1 - j / n2), min(low, i / n1 - j / n2)
        total += 1
        hits += (max(top, -low) if two_sided else top) >= d - 1e-9
    return hits / total


@pytest.mark.parametrize("n1, n2", [(4, 4), (5, 3), (3, 6)])
@pytest.mark.parametrize("two_sided", [True, False])
def test_ks_exact_small(n1, n2, two_sided):
    for num in range(1, n1 * n2 + 1):
        d = num / (n1 * n2)
        assert exact_p(d, n1, n2, two_sided) == pytest.approx(brute_exact(d, n1, n2, two_sided), abs=1e-12)


def test_ks_exact_near_asymptotic():
    assert exact_p(0.04, 3000, 2500, True) == pytest.approx(asymptotic_p(0.04, 3000, 2500, True), abs=5e-3)


# ---- moments, formulas, regression ----

def test_merge_equals_whole():
    x = np.random.default_rng(1).normal(1e6, 1.0, (1000, 3))
    parts = moments_of(x[:100]).merge(moments_of(x[100:101])).merge(moments_of(x[101:]))
    whole = moments_of(x)
    assert parts.n == 1000
    np.testing.assert_allclose(parts.mean, whole.mean, rtol=1e-12)
    np.testing.assert_allclose(parts.comoment, whole.comoment, rtol=1e-8)


def test_metric_gradient():
    columns, (g,) = read_metric("(avg(a) - 2) / avg(b) * -avg(c) + avg(a)")
    at = np.array([3.0, 5.0, 7.0])
    value, grad = g.at(at)
    assert columns == ["a", "b", "c"] and value == pytest.approx((3 - 2) / 5 * -7 + 3)
    for i in range(3):
        step = np.eye(3)[i] * 1e-6
        assert grad[i] == pytest.approx((g.at(at + step)[0] - g.at(at - step)[0]) / 2e-6, rel=1e-6)


def test_metric_arguments():
    assert read_metric("x1/x2", ["a", "b"])[0] == ["a", "b"]
    columns, metrics = read_metric("x1/x2", ["a", "b", "c", "d", "e"], "X=x3/x4+x5")
    assert len(metrics) == 3 and columns == ["a", "b", "c", "d", "e"]
    for bad, args in (("x1/x3", ["a", "b"]), ("x1", ["a", "b"]), ("max(a)", None), ("a + 1", None)):
        with pytest.raises(ValueError):
            read_metric(bad, args)


def test_model_formulas():
    assert read_model("y ~ a + f(b + c)") == ("y", ["a", "f(b + c)"])
    assert read_iv("y ~ (d1 ~ z1) + (d2 ~ (z + w)) + x") == ("y", [("d1", "z1"), ("d2", "(z + w)")], ["x"])
    with pytest.raises(ValueError):
        read_model("y")


def test_cuped_reduces_variance():
    rng = np.random.default_rng(2)
    c = rng.normal(10, 2, 4000)
    y = 3 * c + rng.normal(0, 1, 4000)
    _, metrics = read_metric("x1", ["y", "c"], "x2")
    m0, m1 = moments_of(np.c_[y, c][:2000]), moments_of(np.c_[y, c][2000:])
    (_, v0), (_, v1) = adjusted_pair(m0, m1, metrics)
    plain = [MetricStats.of(m, metrics[:1]).cov[0, 0] for m in (m0, m1)]
    assert v0 + v1 < 0.1 * sum(plain)


@pytest.mark.parametrize("bias", [True, False])
def test_solve_matches_lstsq(bias):
    rng = np.random.default_rng(3)
    x = rng.normal(5, [1, 2, 3], (500, 3))
    y = x @ [1.0, -2.0, 0.5] + 4 + rng.normal(0, 1, 500)
    design = np.c_[x, np.ones(500)] if bias else x
    coef = np.linalg.lstsq(design, y, rcond=None)[0]
    fit = solve(moments_of(np.c_[y, x]), ["a", "b", "c"], bias)
    np.testing.assert_allclose(fit.coef, coef, rtol=1e-9)
    rss = np.sum((y - design @ coef) ** 2)
    assert fit.df == 496 and fit.sigma2 == pytest.approx(rss / 496)
    np.testing.assert_allclose(fit.xx_inv, np.linalg.inv(design.T @ design), rtol=1e-7)
    assert solve(moments_of(np.c_[y, x]), ["a", "b", "c"], bias, df_mode="exact").df == 500 - design.shape[1]


def test_ols_tail_golden():
    # adjusted R-squared and F from R-squared, n, k
    fit = solve(moments_of(np.random.default_rng(0).normal(size=(50, 2))), ["x"])
    fit.n, fit.k, fit.df, fit.r_squared = 793200, 4, 793195, 0.016053
    row = next(iter(fit.rows()))
    assert row["adj_r_squared"] == pytest.approx(0.016048, abs=1e-6)
    assert row["f_statistic"] == pytest.approx(3235.2249, abs=1e-3)
