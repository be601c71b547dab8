"""Two-stage least squares; every endogenous variable has its own instrument."""

import numpy as np
from pyspark.sql import functions as F

from estimand.functions.columns import as_double
from estimand.functions.formula import read_iv
from estimand.operators.regress import fit_frame, ols_from_moments, score_products, solve
from estimand.plans.finalize import by_schema, finalize
from estimand.plans.moments import MOMENT_FIELDS, Moments, collect_moments, moments, select_by


def _second_stage(m, endogenous, xs):
    """Moments over [y, d.., z.., x..] -> moments over [y, d-hat.., x..].

    First-stage predictions are linear in (z, x), so their moments follow from
    the same matrix without another scan.
    """
    e, k = len(endogenous), len(xs)
    z0, x0 = 1 + e, 1 + 2 * e
    a = np.zeros((1 + e + k, 1 + 2 * e + k))
    shift = np.zeros(1 + e + k)
    a[0, 0] = 1.0
    stages = []
    for i in range(e):
        regressors = [z0 + i, *range(x0, x0 + k)]
        stage = solve(m.take([1 + i, *regressors]), [str(r) for r in regressors])
        a[1 + i, regressors] = stage.coef[:-1]
        shift[1 + i] = stage.coef[-1]
        stages.append((regressors, stage))
    for j in range(k):
        a[1 + e + j, x0 + j] = 1.0
    return m.transform(a, shift), stages


def iv_2sls(df, formula, robust=False, by=()):
    """``y ~ (d1 ~ z1) + (d2 ~ z2) + x``: one aggregation for both stages.

    Default standard errors are those of the second-stage OLS; ``robust`` uses
    the structural residual y - x'b in an HC0 sandwich (one more scan).
    """
    y, pairs, xs = read_iv(formula)
    ds, zs = [d for d, _ in pairs], [z for _, z in pairs]
    columns = [y, *ds, *zs, *xs]
    terms = [*ds, *xs]
    df, by = select_by(df, by)
    if not robust:
        agg = moments(df, columns, by)
        k = len(terms) + 1

        def project(row):
            if not row["n"]:
                return
            try:
                m2, _ = _second_stage(Moments.of(row), ds, xs)
            except ValueError:
                if not by:
                    raise
                # no variance at all: the second stage gives null results for this group
                m2 = Moments(row["n"], np.zeros(k), np.zeros((k, k)))
            upper = m2.comoment[np.triu_indices(k)]
            yield {**row, "n": m2.n, "mean": m2.mean.tolist(), "comoment": upper.tolist()}

        staged = finalize(agg, project, by_schema(df, by) + MOMENT_FIELDS)
        return ols_from_moments(df, staged, by, terms)

    if by:
        raise ValueError("robust 2SLS is fitted on the whole DataFrame; filter it per group")
    m = collect_moments(df, columns)[()]
    m2, stages = _second_stage(m, ds, xs)
    fit = solve(m2, terms)
    doubles = [as_double(c) for c in columns]
    fitted = []
    for regressors, stage in stages:
        col = F.lit(float(stage.coef[-1]))
        for r, c in zip(regressors, stage.coef[:-1]):
            col = col + F.lit(float(c)) * doubles[r]
        fitted.append(col)
    exog = doubles[1 + 2 * len(ds):]
    structural = F.lit(float(fit.coef[-1]))
    for c, x in zip(fit.coef[:-1], doubles[1:1 + len(ds)] + exog):
        structural = structural + F.lit(float(c)) * x
    middle = score_products(df, [*fitted, *exog, F.lit(1.0)], doubles[0] - structural)
    return fit_frame(df.sparkSession, fit.with_covariance(fit.xx_inv @ middle @ fit.xx_inv))
