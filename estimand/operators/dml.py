"""Double machine learning with cross-fitted least-squares nuisances."""

from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import functions as F

from estimand.functions import dist
from estimand.functions.columns import as_column, as_double, stable_bucket
from estimand.operators.penalized import lasso_fit
from estimand.operators.regress import LinearModel, fit_frame, solve
from estimand.plans.moments import collect_moments, merge_all
from estimand.plans.prefix import release, stored

NUISANCES = ("ols", "lasso", "logistic")
#: Newton steps of a logistic propensity, and the move at which they end.
STEPS, SETTLED = 40, 1e-10


def _nuisance(m, terms, kind, penalty):
    """Coefficients (x terms, constant) of column 0 on the rest."""
    if kind == "lasso":
        return lasso_fit(m, penalty, shrink_bias=False)
    return solve(m, terms).coef


def _fold_moments(df, columns, fold):
    parts = {k[0]: m for k, m in collect_moments(df.withColumn("_fold", fold), columns, by=["_fold"]).items()}
    if len(parts) < 2:
        raise ValueError("cross-fitting needs at least two non-empty folds")
    return parts


def _propensities(df, fold, t, controls, folds, mean, sd):
    """{fold: logistic coefficients (controls, constant)} of ``t``, each fitted on the other folds.

    All folds take their Newton steps together: a row counts in the sums of
    every fold but its own, so a step is one aggregation over a stored table of
    few columns.
    """
    k = len(controls)
    sd = np.where(sd > 0, sd, 1.0)
    z = [(c - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(controls, mean, sd)]
    rows = stored(df.select(fold.alias("_fold"), t.alias("_t"), *[c.alias(f"_z{i}") for i, c in enumerate(z)]).dropna().withColumn(f"_z{k}", F.lit(1.0)))
    if rows.where("_t not in (0, 1)").head(1):
        raise ValueError("a logistic nuisance is for a treatment of 0 and 1")
    names = [f"_z{i}" for i in range(k + 1)]
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    w = {f: np.zeros(k + 1) for f in folds}
    for _ in range(STEPS):
        table = F.create_map(*[x for f in folds for x in (F.lit(f), F.array(*[F.lit(float(c)) for c in w[f]]))])
        long = rows.withColumn("_of", F.explode(F.array(*[F.lit(f) for f in folds]))).where("_of <> _fold").withColumn("_w", F.element_at(table, F.col("_of")))
        eta = sum((F.col("_w")[i] * F.col(c) for i, c in enumerate(names)), F.lit(0.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        work = long.select("_of", *names, (F.col("_t") - p).alias("_r"), (p * (1 - p)).alias("_v"))
        sums = work.groupBy("_of").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("_r") * F.col(c)) for c in names]).alias("g"),
                                       F.array(*[F.sum(F.col("_v") * F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("h")).collect()
        far = 0.0
        for r in sums:  # a row for each fold
            h = np.zeros((k + 1, k + 1))
            for (i, j), x in zip(pairs, r["h"]):
                h[i, j] = h[j, i] = x / r["n"]
            move = np.linalg.solve(h + 1e-12 * np.eye(k + 1), np.array(r["g"]) / r["n"])
            w[r["_of"]] = w[r["_of"]] + move * min(1.0, 5.0 / max(1e-300, np.max(np.abs(move))))
            far = max(far, np.max(np.abs(move)))
        if far < SETTLED:
            break
    else:
        raise ValueError(f"the propensity has not converged in {STEPS} steps")
    release(rows)
    return {f: np.append(c[:-1] / sd, c[-1] - (c[:-1] / sd) @ mean) for f, c in w.items()}


def residualize(df, y, treatments, controls, fold, model_y="ols", model_t="ols", penalty=0.0):
    """Add out-of-fold residuals ``_ry`` and ``_rt0.._rtk``.

    One aggregation gives the moments of every fold; the training moments of a
    fold are those of the other folds merged, so no fold is scanned twice.
    """
    for kind in (model_y, model_t):
        if kind.lower() not in NUISANCES:
            raise ValueError(f"nuisance models are {NUISANCES}")
    if model_y.lower() == "logistic":
        raise ValueError("a logistic nuisance is for a treatment of 0 and 1")
    columns = [y, *treatments, *controls]
    parts = _fold_moments(df, columns, fold)
    p, c = len(treatments), len(controls)
    xs = list(range(1 + p, 1 + p + c))
    doubles = [as_double(col) for col in columns]
    residuals = {f"_r{i}": F.lit(None).cast("double") for i in range(1 + p)}
    logistic = {}
    if model_t.lower() == "logistic":
        scale = merge_all(list(parts.values()))
        for i in range(1, 1 + p):
            own = scale.take([i, *xs])
            logistic[i] = _propensities(df, fold, doubles[i], [doubles[x] for x in xs], sorted(parts), own.mean[1:], np.sqrt(np.diag(own.comoment)[1:] / own.n))
    for f in sorted(parts):
        train = merge_all([m for g, m in parts.items() if g != f])
        for i in range(1 + p):
            if i in logistic:
                eta = sum((F.lit(float(b)) * doubles[x] for b, x in zip(logistic[i][f], xs)), F.lit(float(logistic[i][f][-1])))
                residuals[f"_r{i}"] = F.when(F.col("_fold") == f, doubles[i] - F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))).otherwise(residuals[f"_r{i}"])
                continue
            coef = _nuisance(train.take([i, *xs]), list(controls), (model_y if i == 0 else model_t).lower(), penalty)
            pred = F.lit(float(coef[-1]))
            for b, x in zip(coef[:-1], xs):
                pred = pred + F.lit(float(b)) * doubles[x]
            residuals[f"_r{i}"] = F.when(F.col("_fold") == f, doubles[i] - pred).otherwise(residuals[f"_r{i}"])
    out = df.withColumn("_fold", fold).withColumns(residuals)
    return out.withColumnRenamed("_r0", "_ry").withColumnsRenamed({f"_r{i + 1}": f"_rt{i}" for i in range(p)})


class LinearDML:
    """Linear heterogeneous effect: theta(X) = X b + b0 per treatment feature.

    ``X`` drives the effect, ``W`` are further controls (lists of SQL
    expressions).  ``treatment_featurizer`` lists expressions of the treatment
    column ``T`` such as the output of ``poly_features``.  Folds come from a
    seeded hash of ``key`` or an own ``fold`` expression.
    """

    def __init__(self, Y, T, X, W=(), model_y="ols", model_t="ols", cv=3, key=None, fold=None,
                 treatment_featurizer=None, seed=0, penalty=0.0):
        if not X:
            raise ValueError("X must name at least one column")
        if fold is None and not key:
            raise ValueError("give key columns (or a fold expression) for cross-fitting")
        self.Y, self.T, self.X, self.W = Y, T, list(X), list(W)
        self.features = list(treatment_featurizer) if treatment_featurizer else [T]
        self.model_y, self.model_t, self.penalty = model_y, model_t, penalty
        self.fold = as_column(fold).cast("int") if fold is not None else stable_bucket(key, cv, seed)
        self.fit_result = None

    def fit(self, df):
        controls = list(dict.fromkeys([*self.X, *self.W]))
        res = residualize(df, self.Y, self.features, controls, self.fold, self.model_y, self.model_t, self.penalty)
        k = len(self.features)
        # x-major, then the intercept of each treatment feature
        design = [F.col(f"_rt{j}") * as_double(x) for x in self.X for j in range(k)]
        design += [F.col(f"_rt{j}") for j in range(k)]
        if k == 1:
            self.terms = [*self.X, "cate_intercept"]
        else:
            self.terms = [f"{x}:{f}" for x in self.X for f in self.features]
            self.terms += [f"cate_intercept:{f}" for f in self.features]
        m = collect_moments(res, [F.col("_ry"), *design])[()]
        self.fit_result = solve(m, self.terms, bias=False)
        self._train = df
        return self

    def summary(self):
        return fit_frame(self._train.sparkSession, self.fit_result)

    def _contrast(self, T0, T1):
        """phi(T1) - phi(T0) per treatment feature, as columns."""
        def at(feature, value):
            if len(self.features) == 1 and feature == self.T:
                return as_double(str(value))
            # the featurizer is SQL over the treatment column: bind it to the value
            return F.expr(f"aggregate(array(cast({value} as double)), 0D, (acc, {self.T}) -> cast({feature} as double))")
        return [at(f, T1) - at(f, T0) for f in self.features]

    def _design(self, phi, X):
        xs = [as_double(x) for x in (self.X if X is None else X)]
        if len(xs) != len(self.X):
            raise ValueError(f"the model has {len(self.X)} effect columns")
        return [p * x for x in xs for p in phi] + list(phi)

    def _linear(self, design):
        return LinearModel(self.fit_result, self.terms).column(design)

    def effect(self, df, T0=0, T1=1, X=None, name="effect"):
        """Per-row effect of moving the treatment from T0 to T1."""
        return df.withColumn(name, self._linear(self._design(self._contrast(T0, T1), X)))

    def ate(self, df, T0=0, T1=1, X=None):
        return self.effect(df, T0, T1, X, "_e").agg(F.avg("_e").alias("ate"))

    def effect_interval(self, df, T0=0, T1=1, alpha=0.05, X=None):
        """Adds fit, lower, upper at level 1 - alpha."""
        design = self._design(self._contrast(T0, T1), X)
        return LinearModel(self.fit_result, self.terms).predict_interval(df, "confidence", 1 - alpha, design)

    def ate_interval(self, df, T0=0, T1=1, alpha=0.05, X=None):
        """Interval of the effect at the average X."""
        xs = self.X if X is None else list(X)
        means = df.agg(*[F.avg(as_double(x)).alias(f"_a{i}") for i, x in enumerate(xs)])
        out = self.effect_interval(means, T0, T1, alpha, [f"_a{i}" for i in range(len(xs))])
        return out.select(
            F.col("fit").alias("mean_point"), F.col("lower").alias("ci_mean_lower"), F.col("upper").alias("ci_mean_upper")
        )

    def _unit(self, j):
        return [F.lit(1.0 if i == j else 0.0) for i in range(len(self.features))]

    def const_marginal_effect(self, df, X=None):
        """Adds effect_1.. per treatment feature."""
        cols = {f"effect_{j + 1}": self._linear(self._design(self._unit(j), X)) for j in range(len(self.features))}
        return df.withColumns(cols)

    def marginal_effect(self, df, X=None, name="effect"):
        ones = [F.lit(1.0)] * len(self.features)
        return df.withColumn(name, self._linear(self._design(ones, X)))

    def marginal_ate(self, df, X=None):
        return self.marginal_effect(df, X, "_e").agg(F.avg("_e").alias("ate"))


class NonParamDML:
    """Binned effect: per cell of the (binned) X, sum(rt * ry) / sum(rt^2).

    The cells come from expressions such as ``cut_bins`` results or plain
    categorical columns.
    """

    def __init__(self, Y, T, X, cells, W=(), model_y="ols", model_t="ols", cv=3, key=None, fold=None, seed=0,
                 penalty=0.0):
        if fold is None and not key:
            raise ValueError("give key columns (or a fold expression) for cross-fitting")
        self.Y, self.T, self.X, self.W = Y, T, list(X), list(W)
        self.cells = dict(cells)
        self.args = (model_y, model_t, penalty)
        self.fold = as_column(fold).cast("int") if fold is not None else stable_bucket(key, cv, seed)

    def fit(self, df):
        controls = list(dict.fromkeys([*self.X, *self.W]))
        res = residualize(df, self.Y, [self.T], controls, self.fold, *self.args)
        keyed = res.withColumns({n: as_column(e) for n, e in self.cells.items()})
        t, y = F.col("_rt0"), F.col("_ry")
        stats = keyed.dropna(subset=["_rt0", "_ry"]).groupBy(*self.cells).agg(
            F.count(F.lit(1)).alias("n"), F.sum(t * y).alias("_ty"), F.sum(t * t).alias("_tt"),
            F.sum(y * y).alias("_yy"), F.sum(t * t * y * y).alias("_m22"), F.sum(t * t * t * y).alias("_m31"),
            F.sum(t * t * t * t).alias("_m4"),
        )
        tau = F.try_divide(F.col("_ty"), F.col("_tt"))
        # HC0: sum rt^2 (ry - tau rt)^2 / (sum rt^2)^2
        middle = F.col("_m22") - 2 * F.col("effect") * F.col("_m31") + F.pow("effect", F.lit(2)) * F.col("_m4")
        self.effects = stats.withColumn("effect", tau).select(
            *self.cells, "n", "effect",
            F.try_divide(F.sqrt(F.greatest(middle, F.lit(0.0))), F.col("_tt")).alias("std_error"),
        )
        return self

    def effect_interval(self, alpha=0.05):
        q = dist.norm_ppf(1 - alpha / 2)
        return self.effects.withColumns({
            "lower": F.col("effect") - q * F.col("std_error"), "upper": F.col("effect") + q * F.col("std_error"),
        })

    def effect(self, df, name="effect"):
        """Attach the cell effect to every row (the cell table stays small)."""
        keyed = df.withColumns({f"_c_{n}": as_column(e) for n, e in self.cells.items()})
        table = self.effects.select(*[F.col(n).alias(f"_c_{n}") for n in self.cells], F.col("effect").alias(name))
        table = table.withColumnsRenamed({f"_c_{n}": f"_t_{n}" for n in self.cells})
        same = reduce(and_, [F.col(f"_c_{n}").eqNullSafe(F.col(f"_t_{n}")) for n in self.cells])
        return keyed.join(table, same, "left").drop(*[f"{p}{n}" for n in self.cells for p in ("_c_", "_t_")])
