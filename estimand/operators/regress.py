"""Least squares from moments, prediction as native column arithmetic."""

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import functions as F

from estimand.functions import dist
from estimand.functions.columns import as_double
from estimand.functions.formula import read_model
from estimand.plans.finalize import by_schema, finalize
from estimand.plans.moments import (
    NATIVE_PRODUCTS, Moments, collect_moments, invert, moments, select_by, weighted,
)
from estimand.plans.segments import Groups

INTERCEPT = "(Intercept)"
OLS_SCHEMA = (
    "term string, term_index int, estimate double, std_error double, t_value double, p_value double, "
    "n bigint, df bigint, residual_se double, r_squared double, adj_r_squared double, "
    "f_statistic double, f_p_value double"
)


@dataclass
class LinearFit:
    """Coefficients in design order: the x terms, then the intercept."""

    terms: list
    coef: np.ndarray
    xx_inv: np.ndarray
    bias: bool
    n: int
    k: int
    df: int
    sigma2: float
    r_squared: float
    std_error: np.ndarray = field(default=None)

    def with_covariance(self, cov):
        self.std_error = np.sqrt(np.diag(cov))
        return self

    def rows(self):
        """Result rows, intercept first."""
        with np.errstate(all="ignore"):
            t = self.coef / self.std_error
            adj = 1 - (1 - self.r_squared) * (self.n - 1) / self.df if self.df > 0 else math.nan
            f = float(np.float64(self.r_squared / self.k) / ((1 - self.r_squared) / np.float64(self.df)))
        shared = {
            "n": self.n, "df": self.df, "residual_se": math.sqrt(self.sigma2) if self.sigma2 >= 0 else math.nan,
            "r_squared": self.r_squared, "adj_r_squared": adj, "f_statistic": f,
            "f_p_value": dist.f_sf(f, self.k, self.df),
        }
        order = list(range(len(self.terms)))
        if self.bias:
            order = order[-1:] + order[:-1]
        for pos, i in enumerate(order):
            ti = float(t[i])
            p = ti if math.isnan(ti) else 0.0 if math.isinf(ti) else 2 * dist.t_sf(abs(ti), self.df)
            yield {
                "term": self.terms[i], "term_index": pos, "estimate": float(self.coef[i]),
                "std_error": float(self.std_error[i]), "t_value": ti, "p_value": p, **shared,
            }


def solve(m, terms, bias=True, weighted=False, df_mode="reference"):
    """Least squares of column 0 on the rest.

    ``weighted`` moments carry sqrt(w) as their last column, which replaces the
    constant.  Degrees of freedom are n - k - 1 even without an intercept;
    ``df_mode="exact"`` counts the fitted coefficients instead.
    """
    k = len(terms)
    xs = list(range(1, k + 1))
    names = [*terms, INTERCEPT] if bias else list(terms)
    if bias and not weighted:
        # centred system: better conditioned than the raw one
        s_inv = invert(m.comoment[np.ix_(xs, xs)])
        mean_x = m.mean[xs]
        slope = s_inv @ m.comoment[xs, 0]
        coef = np.append(slope, m.mean[0] - slope @ mean_x)
        cross = -s_inv @ mean_x
        xx_inv = np.block([
            [s_inv, cross[:, None]], [cross[None, :], np.array([[1.0 / m.n + mean_x @ s_inv @ mean_x]])],
        ])
        rss = m.comoment[0, 0] - slope @ m.comoment[xs, 0]
    else:
        design = xs + ([k + 1] if bias else [])
        raw = m.raw()
        xx_inv = invert(raw[np.ix_(design, design)])
        coef = xx_inv @ raw[design, 0]
        rss = raw[0, 0] - coef @ raw[design, 0]
        slope = coef[:k]
    df = m.n - k - 1 if df_mode == "reference" else m.n - len(names)
    sigma2 = max(float(rss), 0.0) / df if df > 0 else math.nan
    with np.errstate(all="ignore"):
        explained = slope @ m.comoment[np.ix_(xs, xs)] @ slope
        r2 = float(np.float64(explained) / m.comoment[0, 0])
    fit = LinearFit(names, coef, xx_inv, bias, m.n, k, df, sigma2, r2)
    return fit.with_covariance(sigma2 * xx_inv)


def _design(formula, weight):
    y, xs = read_model(formula)
    columns = [y, *xs]
    return y, xs, weighted(columns, weight) if weight is not None else columns


def ols(df, formula, bias=True, by=(), weight=None, df_mode="reference", xx_inverse=None, xx_weighted=None):
    """One row per coefficient and group.

    With ``xx_inverse`` and ``xx_weighted`` (matrices in design order: x terms,
    then the constant) standard errors are sqrt(diag(A B A)).
    """
    _, xs, columns = _design(formula, weight)
    df, by = select_by(df, by)
    return ols_from_moments(
        df, moments(df, columns, by), by, xs, bias, weight is not None, df_mode, xx_inverse, xx_weighted
    )


def ols_from_moments(df, agg, by, terms, bias=True, weighted=False, df_mode="reference",
                     xx_inverse=None, xx_weighted=None):
    def fn(row):
        if not row["n"]:
            return
        try:
            fit = solve(Moments.of(row), terms, bias, weighted, df_mode)
        except ValueError:
            if not by:
                raise
            yield dict(row)
            return
        if xx_inverse is not None and xx_weighted is not None:
            a, b = np.asarray(xx_inverse, float), np.asarray(xx_weighted, float)
            if a.shape != fit.xx_inv.shape or b.shape != a.shape:
                raise ValueError("xx_inverse / xx_weighted do not fit the design")
            fit.with_covariance(a @ b @ a)
        for r in fit.rows():
            yield {**row, **r}

    return finalize(agg, fn, by_schema(df, by) + OLS_SCHEMA)


def wls(df, formula, weight, bias=True, by=(), df_mode="reference"):
    """Weighted least squares; R-squared is of the sqrt(w)-scaled columns."""
    return ols(df, formula, bias=bias, by=by, weight=weight, df_mode=df_mode)


class LinearModel:
    """A fitted model on the driver (k numbers); rows never leave Spark."""

    def __init__(self, fit, terms):
        self.fit = fit
        self.terms = list(terms)

    def _design(self, xs):
        xs = self.terms if xs is None else list(xs)
        if len(xs) != len(self.terms):
            raise ValueError(f"the model has {len(self.terms)} terms, got {len(xs)}")
        cols = [as_double(x) for x in xs]
        return cols + [F.lit(1.0)] if self.fit.bias else cols

    def column(self, xs=None):
        """The prediction as a Column."""
        total = F.lit(0.0)
        for c, x in zip(self.fit.coef, self._design(xs)):
            total = total + F.lit(float(c)) * x
        return total

    def se2_column(self, xs=None):
        """sigma2 * x (X'X)^-1 x', expanded over the upper triangle."""
        design = self._design(xs)
        v = self.fit.sigma2 * self.fit.xx_inv
        total = F.lit(0.0)
        for i, a in enumerate(design):
            for j in range(i, len(design)):
                total = total + F.lit(float(v[i, j] * (1 if i == j else 2))) * a * design[j]
        return F.greatest(total, F.lit(0.0))

    def predict(self, df, xs=None, name="predict"):
        return df.withColumn(name, self.column(xs))

    def predict_interval(self, df, interval="confidence", level=0.95, xs=None):
        """Adds fit, lower, upper."""
        if interval not in ("confidence", "prediction"):
            raise ValueError("interval must be 'confidence' or 'prediction'")
        se2 = self.se2_column(xs)
        if interval == "prediction":
            se2 = se2 + F.lit(self.fit.sigma2)
        half = F.lit(dist.t_ppf(1 - (1 - level) / 2, self.fit.df)) * F.sqrt(se2)
        center = self.column(xs)
        return df.withColumns({"fit": center, "lower": center - half, "upper": center + half})


def fit_linear(df, formula, bias=True, weight=None, df_mode="reference"):
    """Fit on all rows of ``df``; one aggregation, one row to the driver."""
    _, xs, columns = _design(formula, weight)
    found = collect_moments(df, columns)
    if () not in found:
        raise ValueError("no complete rows to fit on")
    return LinearModel(solve(found[()], xs, bias, weight is not None, df_mode), xs)


def predict(df, formula, train=None, interval=None, level=0.95, weight=None, bias=True, xs=None):
    """Fit on ``train`` (default: ``df`` itself) and predict every row of ``df``."""
    model = fit_linear(df if train is None else train, formula, bias, weight)
    return model.predict_interval(df, interval, level, xs) if interval else model.predict(df, xs)


def score_products(df, design, residual):
    """Sum of e^2 x_i x_j (the middle of an HC0 sandwich) as a k x k array."""
    k = len(design)
    if k > NATIVE_PRODUCTS:
        e = as_double(residual)
        return collect_moments(df, [e * as_double(x) for x in design])[()].raw()
    picked = df.select(
        as_double(residual).alias("_e"), *[as_double(x).alias(f"_x{i}") for i, x in enumerate(design)]
    ).dropna()
    e2 = F.col("_e") * F.col("_e")
    cells = [F.sum(e2 * F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(k) for j in range(i, k)]
    upper = picked.agg(F.array(*cells).alias("c")).first()["c"]
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = upper
    return m + np.triu(m, 1).T


def fit_frame(spark, fit):
    """Coefficient rows of a driver-side fit."""
    names = [f.split()[0] for f in OLS_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in fit.rows()], OLS_SCHEMA)


def ols_sandwich(df, formula, bias=True):
    """OLS with heteroscedasticity-robust (HC0) standard errors: two scans."""
    y, xs = read_model(formula)
    model = fit_linear(df, formula, bias)
    design = model._design(None)
    middle = score_products(df, design, as_double(y) - model.column())
    a = model.fit.xx_inv
    return fit_frame(df.sparkSession, model.fit.with_covariance(a @ middle @ a))


def model_table(df, formula, by, bias=True, weight=None, level=0.95):
    """One row for each group of ``by``: its keys and the fitted state, coef (terms, then the constant), v (upper triangle of
    their covariances), sigma2 and t, the Student quantile of two-sided intervals at ``level``.  Singular groups have nulls.
    """
    _, xs, columns = _design(formula, weight)
    groups = Groups(by)
    rows = df.select(*groups.columns(), *[as_double(c).alias(f"_x{i}") for i, c in enumerate(columns)])
    agg = moments(rows, [f"_x{i}" for i in range(len(columns))], groups.names)

    def fn(row):
        own = {k: row[k] for k in groups.names}
        try:
            fit = solve(Moments.of(row), xs, bias, weight is not None)
        except ValueError:
            yield own
            return
        v = fit.sigma2 * fit.xx_inv
        own |= {"coef": [float(x) for x in fit.coef], "v": [float(x) for x in v[np.triu_indices(len(v))]], "sigma2": float(fit.sigma2)}
        yield own | ({"t": float(dist.t_ppf(1 - (1 - level) / 2, fit.df))} if fit.df > 0 else {})

    return finalize(agg, fn, groups.schema(agg) + "coef array<double>, v array<double>, sigma2 double, t double")


def predict_grouped(df, formula, by, train=None, interval=None, level=0.95, bias=True, weight=None):
    """Rows of ``df`` scored by the model of their group: adds ``predict``, or fit, lower and upper of an interval ("confidence" or "prediction").

    Models are fitted on ``train`` (default: ``df``) in one aggregation and
    joined by the group's keys (null-safe), so they are a table of any size.
    Rows of a group without a model, and intervals without degrees of freedom, get nulls.
    """
    if interval not in (None, "confidence", "prediction"):
        raise ValueError("interval must be 'confidence' or 'prediction'")
    groups = Groups(by)
    _, xs = read_model(formula)
    added = ["predict"] if interval is None else ["fit", "lower", "upper"]
    names = [f"_d{i}" for i in range(len(xs))]
    # the user's row travels as one column, so that no name of it can clash
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in added]).alias("_row"), *groups.columns(), *[as_double(x).alias(n) for x, n in zip(xs, names)])
    models = model_table(df if train is None else train, formula, by, bias, weight, level)
    keys = [f"_g{i}" for i in range(len(groups.names))]
    models = models.withColumnsRenamed(dict(zip(groups.names, keys)))
    joined = rows.join(models, [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(groups.names, keys)], "left")
    design = [F.col(n) for n in names] + ([F.lit(1.0)] if bias else [])
    center = sum((F.col("coef")[i] * x for i, x in enumerate(design)), F.lit(0.0))
    if interval is None:
        return joined.select("_row.*", center.alias("predict"))
    se2, at = F.lit(0.0), 0
    for i, a in enumerate(design):
        for j in range(i, len(design)):
            se2 = se2 + F.col("v")[at] * (1 if i == j else 2) * a * design[j]
            at += 1
    se2 = F.greatest(se2, F.lit(0.0)) + (F.col("sigma2") if interval == "prediction" else F.lit(0.0))
    half = F.col("t") * F.sqrt(se2)
    return joined.select("_row.*", center.alias("fit"), (center - half).alias("lower"), (center + half).alias("upper"))


def ols_sandwich_grouped(df, formula, by, bias=True):
    """(by.., coefficient rows): ``ols_sandwich`` in every group: residuals from the table of models, then the middle of each sandwich in one aggregation.

    Singular groups have one row of nulls.
    """
    y, xs = read_model(formula)
    groups = Groups(by)
    names = [f"_d{i}" for i in range(len(xs))]
    rows = df.select(*groups.columns(), as_double(y).alias("_y"), *[as_double(x).alias(n) for x, n in zip(xs, names)]).dropna(subset=["_y", *names])
    keys = [f"_g{i}" for i in range(len(groups.names))]
    plain = ["_y", *names]
    agg = moments(rows, plain, groups.names)
    inner = " + ".join(names)
    models = model_table(rows, f"_y ~ {inner}", groups.names, bias).withColumnsRenamed(dict(zip(groups.names, keys)))
    same = [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(groups.names, keys)]
    design = [F.col(n) for n in names] + ([F.lit(1.0)] if bias else [])
    fitted = sum((F.col("coef")[i] * x for i, x in enumerate(design)), F.lit(0.0))
    e2 = F.pow(F.col("_y") - fitted, F.lit(2.0))
    k = len(design)
    middle = rows.join(models.where("coef is not null").select(*keys, "coef"), same).groupBy(*keys).agg(
        F.array(*[F.sum(e2 * design[i] * design[j]) for i in range(k) for j in range(i, k)]).alias("middle"))
    joined = agg.join(middle, same, "left").drop(*keys)

    def fn(row):
        own = {b: row[b] for b in groups.names}
        try:
            fit = solve(Moments.of(row), xs, bias)
        except ValueError:
            yield own
            return
        if row["middle"] is None:
            yield own
            return
        b = np.zeros((k, k))
        b[np.triu_indices(k)] = row["middle"]
        b = b + np.triu(b, 1).T
        for r in fit.with_covariance(fit.xx_inv @ b @ fit.xx_inv).rows():
            yield {**own, **r}

    found = finalize(joined, fn, groups.schema(agg) + OLS_SCHEMA)
    return found.select(*groups.restored(), *[c for c in found.columns if c not in groups.names])
