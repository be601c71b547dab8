"""Delta-method standard errors and t-tests with variance reduction (CUPED)."""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

from estimand.functions import dist
from estimand.functions.columns import as_column
from estimand.functions.formula import read_metric
from estimand.plans.finalize import by_schema, finalize, pack
from estimand.plans.moments import Moments, invert, moments, select_by

ALTERNATIVES = ("two-sided", "less", "greater")
TTEST_SCHEMA = (
    "estimate double, stderr double, t_statistic double, p_value double, lower double, upper double"
)


def check_alternative(alternative):
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}, not {alternative!r}")


# ---- statistics on moments -------------------------------------------------


@dataclass
class MetricStats:
    """Values and delta-method covariance of several metrics in one group."""

    values: np.ndarray
    cov: np.ndarray

    @classmethod
    def of(cls, m, metrics):
        values, grads = zip(*[g.at(m.mean) for g in metrics])
        grads = np.vstack(grads)
        with np.errstate(all="ignore"):
            cov = grads @ m.cov() @ grads.T / m.n
        return cls(np.array(values, dtype=float), cov)

    def theta(self):
        """Regression of the metric on its covariates."""
        return self.cov[0, 1:] @ invert(self.cov[1:, 1:], "covariate")

    def adjusted_var(self, theta):
        cxy, cxx = self.cov[0, 1:], self.cov[1:, 1:]
        return float(self.cov[0, 0] + theta @ cxx @ theta - 2.0 * theta @ cxy)


def adjusted_pair(m0, m1, metrics, theta_from=None):
    """Adjusted means and variances of control and treatment.

    ``theta_from`` supplies the covariate regression and the reference
    covariate values; by default the two groups pooled.
    """
    pooled = MetricStats.of(theta_from or m0.merge(m1), metrics)
    theta = pooled.theta() if len(metrics) > 1 else np.zeros(0)
    out = []
    for m in (m0, m1):
        s = MetricStats.of(m, metrics)
        mean = float(s.values[0] - theta @ (s.values[1:] - pooled.values[1:]))
        out.append((mean, s.adjusted_var(theta)))
    return out


def normal_p(t, alternative):
    if math.isnan(t):
        return t
    if math.isinf(t):
        return 0.0
    if alternative == "less":
        return dist.norm_cdf(t)
    if alternative == "greater":
        return dist.norm_sf(t)
    return 2.0 * dist.norm_sf(abs(t))


def t_tail(estimate, stderr, n, alternative="two-sided", alpha=0.05):
    """p from the normal, interval from Student-t with n - 1 df.

    ``alpha`` is a significance level; alpha <= 0 reports zero bounds.
    """
    with np.errstate(all="ignore"):
        t = float(np.float64(estimate) / np.float64(stderr))
    lower = upper = 0.0
    if alpha > 0:
        q = dist.t_ppf(1.0 - (alpha / 2 if alternative == "two-sided" else alpha), n - 1)
        lower = -math.inf if alternative == "less" else estimate - q * stderr
        upper = math.inf if alternative == "greater" else estimate + q * stderr
    return {
        "estimate": estimate, "stderr": stderr, "t_statistic": t,
        "p_value": normal_p(t, alternative), "lower": lower, "upper": upper,
    }


def two_sample(m0, m1, metrics, alternative, alpha):
    (mean0, var0), (mean1, var1) = adjusted_pair(m0, m1, metrics)
    return t_tail(mean1 - mean0, float(np.sqrt(var0 + var1)), m0.n, alternative, alpha)


# ---- operators ---------------------------------------------------------------


def deltamethod(df, g, args=None, is_std=True, by=()):
    """Standard error (or variance) of ``g`` at the sample means."""
    columns, metrics = read_metric(g, args)
    df, by = select_by(df, by)
    agg = moments(df, columns, by)

    def fn(row):
        if not row["n"]:
            return
        var = float(MetricStats.of(Moments.of(row), metrics).cov[0, 0])
        yield {**row, "result": math.sqrt(var) if is_std and var >= 0 else var}

    return finalize(agg, fn, by_schema(df, by) + "result double")


def ttest_1samp(df, g, alternative="two-sided", mu=0.0, alpha=0.05, cuped=None, args=None, by=()):
    """One-sample test of ``g`` against ``mu``; CUPED reduces the variance only."""
    check_alternative(alternative)
    columns, metrics = read_metric(g, args, cuped)
    df, by = select_by(df, by)
    agg = moments(df, columns, by)

    def fn(row):
        if not row["n"]:
            return
        m = Moments.of(row)
        s = MetricStats.of(m, metrics)
        try:
            theta = s.theta() if len(metrics) > 1 else np.zeros(0)
        except ValueError:
            if not by:
                raise
            yield dict(row)
            return
        stderr = float(np.sqrt(s.adjusted_var(theta)))
        yield {**row, **t_tail(float(s.values[0]) - mu, stderr, m.n, alternative, alpha)}

    return finalize(agg, fn, by_schema(df, by) + TTEST_SCHEMA)


def _indexed_moments(df, columns, index, by):
    df, by = select_by(df, by)
    df = df.withColumn("_index", as_column(index))
    if df.schema["_index"].dataType.simpleString() in ("double", "float") or df.schema["_index"].dataType.simpleString().startswith("decimal"):
        whole = F.col("_index").cast("bigint")
        df = df.withColumn("_index", F.when(F.col("_index") == whole, whole).when(
            F.col("_index").isNotNull(), F.raise_error(F.lit("the index must hold whole numbers")).cast("bigint")))
    df = df.withColumn("_index", F.col("_index").cast("bigint"))
    return df, by, moments(df, columns, [*by, "_index"], required=["_index"])


def ttest_2samp(df, g, index, alternative="two-sided", alpha=0.05, cuped=None, args=None, by=()):
    """Treatment (index 1) minus control (index 0)."""
    check_alternative(alternative)
    columns, metrics = read_metric(g, args, cuped)
    df, by, agg = _indexed_moments(df, columns, index, by)
    return ttest_2samp_from_moments(df, agg.where("_index in (0, 1)"), by, metrics, alternative, alpha)


def ttest_2samp_from_moments(df, agg, by, metrics, alternative="two-sided", alpha=0.05):
    """Finish a 2-sample test from a moments table keyed by (by, _index)."""
    packed = pack(agg, by, "_index", ["n", "mean", "comoment"], 2)

    def fn(row):
        groups = {c["key"]: Moments.of(c) for c in row["cells"]}
        if 0 not in groups or 1 not in groups:
            if not by:
                raise ValueError("at least 2 groups are required: the index must contain 0 and 1")
            yield dict(row)
            return
        try:
            tested = two_sample(groups[0], groups[1], metrics, alternative, alpha)
        except ValueError:
            if not by:
                raise
            tested = {}
        yield {**row, **tested}

    return finalize(packed, fn, by_schema(df, by) + TTEST_SCHEMA)


def ttests_2samp(df, g, index, alternative="two-sided", alpha=0.05, cuped=None, args=None, by=()):
    """All pairs of index values; one-sided tests also swap the pair."""
    check_alternative(alternative)
    columns, metrics = read_metric(g, args, cuped)
    df, by, agg = _indexed_moments(df, columns, index, by)
    fields = ["_index", "n", "mean", "comoment"]
    left = agg.select(*by, *[F.col(f).alias(f"a_{f}") for f in fields])
    right = agg.select(*[F.col(b).alias(f"b_{b}") for b in by], *[F.col(f).alias(f"b_{f}") for f in fields])
    order = F.col("a__index") < F.col("b__index") if alternative == "two-sided" else F.col("a__index") != F.col("b__index")
    for b in by:
        order = order & F.col(b).eqNullSafe(F.col(f"b_{b}"))

    def fn(row):
        one, two = (Moments.of({f: row[f"{p}_{f}"] for f in fields}) for p in "ab")
        try:
            tested = two_sample(one, two, metrics, alternative, alpha)
        except ValueError:
            if not by:
                raise
            tested = {}
        yield {**row, "control": row["a__index"], "treatment": row["b__index"], **tested}

    return finalize(left.join(right, order), fn, by_schema(df, by) + "control bigint, treatment bigint, " + TTEST_SCHEMA)
