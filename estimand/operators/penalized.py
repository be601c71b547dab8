"""Ridge, lasso and logistic fits, and the first-order update rules.

The reference trains these online, in row order.  Here the fit is the fixed
point of the same update (full batch), so it depends on the data only.  A
linear loss needs one aggregation in total; a logistic loss one small
aggregation per iteration.
"""

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import functions as F

from estimand.functions.columns import as_double
from estimand.functions.formula import read_model
from estimand.plans.moments import NATIVE_PRODUCTS, collect_moments, invert
from estimand.plans.prefix import release, stored

OPTIMIZERS = ("SGD", "Momentum", "Nesterov", "Adam", "Lasso")

# Fixed values of the update rules.
MOMENTUM_KEEP = 0.1
NESTEROV_KEEP = 0.9
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPS = 1e-6


def soft(v, limit):
    return np.sign(v) * np.maximum(0.0, np.abs(v) - limit)


def _descend(s, r, penalty, scale, tol=1e-12, sweeps=10_000):
    """Coordinate descent for b's b - 2 r'b + penalty * |b|_1."""
    b = np.zeros(len(r))
    for _ in range(sweeps):
        change = 0.0
        for j in range(len(r)):
            if s[j, j] <= 0:
                continue
            old = b[j]
            b[j] = soft(r[j] - s[j] @ b + s[j, j] * old, penalty / 2) / s[j, j]
            change = max(change, abs(b[j] - old) * math.sqrt(s[j, j]))
        if change <= tol * scale:
            return b
    raise ValueError(f"coordinate descent has not converged in {sweeps} sweeps")


def lasso_fit(m, penalty, shrink_bias=True):
    """Minimise mean (y - xb - c)^2 + penalty * (|b|_1 + |c|) from moments.

    Given b the best c is the soft-thresholded mean residual, so c is either
    zero or moves the cross moments by a constant; each case is one descent.
    """
    s, r = m.comoment[1:, 1:] / m.n, m.comoment[1:, 0] / m.n
    y0, x0 = m.mean[0], m.mean[1:]
    scale = math.sqrt(max(m.comoment[0, 0] / m.n, 1e-300))
    if not shrink_bias:
        b = _descend(s, r, penalty, scale)
        return np.append(b, y0 - b @ x0)
    for sign in (1.0, -1.0):
        b = _descend(s, r + penalty / 2 * sign * x0, penalty, scale)
        rest = y0 - b @ x0
        if sign * rest > penalty / 2:
            return np.append(b, rest - sign * penalty / 2)
    b = _descend(s + np.outer(x0, x0), r + y0 * x0, penalty, scale)
    return np.append(b, 0.0)


def ridge(m, l2):
    """Minimise mean (y - xb - c)^2 + l2 * |b|^2."""
    k = len(m.mean) - 1
    s = m.comoment[1:, 1:] / m.n + l2 * np.eye(k)
    b = invert(s) @ (m.comoment[1:, 0] / m.n)
    return np.append(b, m.mean[0] - b @ m.mean[1:])


@dataclass
class Updater:
    """One full-batch step per call; ``gradient`` is the ascent direction."""

    name: str
    lr: float
    penalty: float = 0.0
    step: int = 0
    memory: dict = field(default_factory=dict)

    def look_ahead(self, w):
        return w + NESTEROV_KEEP * self.memory.get("v", 0.0) if self.name == "Nesterov" else w

    def apply(self, w, gradient):
        self.step += 1
        if self.name == "SGD":
            return w + self.lr * gradient
        if self.name == "Lasso":
            return soft(w + self.lr * gradient, self.lr * self.penalty)
        if self.name in ("Momentum", "Nesterov"):
            keep = MOMENTUM_KEEP if self.name == "Momentum" else NESTEROV_KEEP
            v = keep * self.memory.get("v", np.zeros_like(w)) + self.lr * gradient
            self.memory["v"] = v
            return w + v
        zero = np.zeros_like(w)
        a = ADAM_BETA1 * self.memory.get("a", zero) + (1 - ADAM_BETA1) * gradient
        q = ADAM_BETA2 * self.memory.get("q", zero) + (1 - ADAM_BETA2) * gradient**2
        self.memory.update(a=a, q=q)
        fair_a, fair_q = a / (1 - ADAM_BETA1**self.step), q / (1 - ADAM_BETA2**self.step)
        return w + self.lr * fair_a / (np.sqrt(fair_q) + ADAM_EPS)


class PenalizedModel:
    """x weights then the bias; predicts with native columns."""

    def __init__(self, terms, coef, link="identity", converged=True):
        self.terms, self.coef, self.link, self.converged = list(terms), np.asarray(coef, float), link, converged

    def column(self, xs=None):
        xs = self.terms if xs is None else list(xs)
        if len(xs) != len(self.terms):
            raise ValueError(f"the model has {len(self.terms)} terms, got {len(xs)}")
        z = F.lit(float(self.coef[-1]))
        for c, x in zip(self.coef[:-1], xs):
            z = z + F.lit(float(c)) * as_double(x)
        return z if self.link == "identity" else F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def predict(self, df, xs=None, name="predict"):
        return df.withColumn(name, self.column(xs))

    def coefficients(self, spark):
        rows = [(t, float(c)) for t, c in zip([*self.terms, "bias"], self.coef)]
        return spark.createDataFrame(rows, "term string, estimate double")


def _check_optimizer(optimizer):
    if optimizer is not None and optimizer not in OPTIMIZERS:
        raise ValueError(f"optimizer must be one of {OPTIMIZERS}")


def sgd_linear(df, formula, lr=1.0, l2=0.5, optimizer=None, iterations=1000, tol=1e-9):
    """Squared-loss linear fit; targets and features on their own scale.

    Without ``optimizer`` the fixed point is solved directly: ridge with
    penalty ``l2``.  With one, ``iterations`` full-batch steps of its update
    rule run over the moment matrix, still after a single scan; ``converged``
    of the result tells whether the last step was below ``tol``.
    """
    _check_optimizer(optimizer)
    y, xs = read_model(formula)
    m = collect_moments(df, [y, *xs])[()]
    if optimizer is None:
        return PenalizedModel(xs, ridge(m, l2))
    n, k = m.n, len(xs)
    raw = m.raw() / n
    gram = np.block([[raw[1:, 1:], m.mean[1:, None]], [m.mean[None, 1:], np.ones((1, 1))]])
    cross = np.append(raw[1:, 0], m.mean[0])
    shrink = np.append(np.full(k, 0.0 if optimizer == "Lasso" else l2), 0.0)
    rule, w = Updater(optimizer, lr, l2), np.zeros(k + 1)
    for _ in range(iterations):
        at, before = rule.look_ahead(w), w
        w = rule.apply(w, 2 * (cross - gram @ at) - 2 * shrink * at)
        if not np.all(np.isfinite(w)):
            raise ValueError(f"{optimizer} diverged with lr={lr}; lower it or scale the features")
    return PenalizedModel(xs, w, converged=_settled(w, before, tol))


def _settled(w, before, tol):
    return bool(np.max(np.abs(w - before)) <= tol * max(1.0, np.max(np.abs(w))))


def lasso(df, formula, penalty, shrink_bias=True):
    """L1-penalised linear fit from one scan; by default the bias is shrunk too."""
    y, xs = read_model(formula)
    return PenalizedModel(xs, lasso_fit(collect_moments(df, [y, *xs])[()], penalty, shrink_bias))


def sgd_logistic(df, formula, l2=0.5, optimizer=None, lr=1.0, iterations=25, positive=1, tol=1e-10):
    """Logistic fit of ``y == positive`` (the targets +1/-1 of the reference).

    Newton steps on the mean log-loss + l2 * |b|^2; every step is one
    aggregation of k gradient and k^2/2 curvature sums over the stored design.  ``optimizer`` runs its
    update rule on the aggregated gradient instead; "Lasso" shrinks by ``l2``.
    Newton's method raises if it has not converged; with an update rule the
    result's ``converged`` tells.
    """
    _check_optimizer(optimizer)
    y, xs = read_model(formula)
    k = len(xs)
    rows, stats = _design_table(df, F.when(as_double(y) == float(positive), 1.0).otherwise(0.0), xs)
    n = stats["n"]
    if not n:
        raise ValueError("no complete rows to fit on")
    plain = optimizer is not None
    mean = np.zeros(k) if plain else np.array([stats[f"m{i}"] for i in range(k)])
    scale = np.ones(k) if plain else np.array([stats[f"s{i}"] or 1.0 for i in range(k)])
    z = [(F.col(f"_x{i}") - float(mean[i])) / float(scale[i]) for i in range(k)] + [F.lit(1.0)]
    penalty = np.append(2 * l2 / scale**2, 0.0)

    def aggregate(w, curvature):
        eta = F.lit(0.0)
        for c, col in zip(w, z):
            eta = eta + F.lit(float(c)) * col
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        work = rows.select(*[col.alias(f"z{i}") for i, col in enumerate(z)], (F.col("_n") * (F.col("_y") - p)).alias("r"),
                           (F.col("_n") * p * (1 - p)).alias("v"))
        names = [f"z{i}" for i in range(k + 1)]
        sums = [F.sum(F.col("r") * F.col(c)) for c in names]
        wide = k + 1 > NATIVE_PRODUCTS - 2
        if curvature and not wide:
            sums += [F.sum(F.col("v") * F.col(names[i]) * F.col(names[j])) for i in range(k + 1) for j in range(i, k + 1)]
        got = np.array(work.agg(F.array(*sums).alias("a")).first()["a"], dtype=float) / n
        g = got[:k + 1]
        if not curvature:
            return g, None
        if wide:
            root = F.sqrt("v")
            return g, collect_moments(work, [root * F.col(c) for c in names])[()].raw() / n
        h = np.zeros((k + 1, k + 1))
        h[np.triu_indices(k + 1)] = got[k + 1:]
        return g, h + np.triu(h, 1).T

    w = np.zeros(k + 1)
    if plain:
        rule = Updater(optimizer, lr, l2)
        decay = np.append(np.full(k, 0.0 if optimizer == "Lasso" else 2 * l2), 0.0)
        for _ in range(iterations):
            at, before = rule.look_ahead(w), w
            g, _h = aggregate(at, False)
            w = rule.apply(w, g - decay * at)
            if _settled(w, before, tol):
                break
        release(rows)
        return PenalizedModel(xs, w, "logistic", converged=_settled(w, before, tol))
    for _ in range(iterations):
        g, h = aggregate(w, True)
        move = np.linalg.solve(h + np.diag(penalty) + 1e-12 * np.eye(k + 1), g - penalty * w)
        w = w + move * min(1.0, 5.0 / max(1e-300, np.max(np.abs(move))))
        if np.max(np.abs(move)) < tol:
            break
    else:
        raise ValueError(f"Newton's method has not converged in {iterations} iterations")
    release(rows)
    slope = w[:-1] / scale
    return PenalizedModel(xs, np.append(slope, w[-1] - slope @ mean), "logistic")


#: Equal rows are counted when they are at most one in so many.
COLLAPSE_FACTOR = 20


def _design_table(df, y, xs):
    """Stored complete rows (_y, _x0.., _n) and their totals; equal rows are one where that shrinks the table a lot.

    Two scans of the input; every later step reads these few columns only.
    """
    names = [f"_x{i}" for i in range(len(xs))]
    rows = df.select(y.alias("_y"), *[as_double(x).alias(n) for x, n in zip(xs, names)]).dropna()
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("_y", *names)).alias("distinct"), *[
        f for i, n in enumerate(names) for f in (F.avg(n).alias(f"m{i}"), F.stddev_pop(n).alias(f"s{i}"))]).first()
    if stats["distinct"] * COLLAPSE_FACTOR <= stats["n"]:
        return stored(rows.groupBy("_y", *names).agg(F.count(F.lit(1)).cast("double").alias("_n"))), stats
    return stored(rows.withColumn("_n", F.lit(1.0))), stats


def logistic_lasso(df, formula, penalty, positive=1, iterations=60, tol=1e-9):
    """Minimise mean log-loss of ``y == positive`` + penalty * sum |b|; the bias is not shrunk.

    Proximal Newton: a step aggregates loss, gradient and curvature over the
    stored design, the L1 problem of that quadratic is solved by coordinate
    descent over k numbers, and a step that does not lower the objective is halved.
    """
    y, xs = read_model(formula)
    k = len(xs)
    rows, stats = _design_table(df, F.when(as_double(y) == float(positive), 1.0).otherwise(0.0), xs)
    n = stats["n"]
    if not n:
        raise ValueError("no complete rows to fit on")
    mean, scale = np.array([stats[f"m{i}"] for i in range(k)]), np.array([stats[f"s{i}"] or 1.0 for i in range(k)])
    z = [(F.col(f"_x{i}") - float(mean[i])) / float(scale[i]) for i in range(k)] + [F.lit(1.0)]
    weight = np.append(penalty / scale, 0.0)  # of the coefficients of the scaled columns

    def look(w):
        eta = sum((F.lit(float(c)) * col for c, col in zip(w, z)), F.lit(0.0))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        work = rows.select("_n", (F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta))) - F.col("_y") * eta).alias("loss"),
                           (p - F.col("_y")).alias("r"), (p * (1 - p)).alias("v"), *[c.alias(f"z{i}") for i, c in enumerate(z)])
        pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
        sums = [F.sum(F.col("_n") * F.col("loss")), *[F.sum(F.col("_n") * F.col("r") * F.col(f"z{i}")) for i in range(k + 1)],
                *[F.sum(F.col("_n") * F.col("v") * F.col(f"z{i}") * F.col(f"z{j}")) for i, j in pairs]]
        got = np.array(work.agg(F.array(*sums).alias("a")).first()["a"], float) / n
        h = np.zeros((k + 1, k + 1))
        for (i, j), x in zip(pairs, got[k + 2 :]):
            h[i, j] = h[j, i] = x
        return got[0] + float(weight @ np.abs(w)), got[1 : k + 2], h

    w = np.zeros(k + 1)
    best, g, h = look(w)
    for _ in range(iterations):
        target, diagonal = w.copy(), np.diag(h) + 1e-12
        for _sweep in range(10_000):
            before = target.copy()
            for i in range(k + 1):
                slope = g[i] + h[i] @ (target - w)
                target[i] = soft(target[i] - slope / diagonal[i], weight[i] / diagonal[i])
            if _settled(target, before, tol * 1e-3):
                break
        move, share = target - w, 1.0
        if np.max(np.abs(move)) <= tol * max(1.0, np.max(np.abs(w))):
            break
        while True:
            value, g2, h2 = look(w + share * move)
            if value <= best + 1e-15 * abs(best) or share < 1e-6:
                break
            share /= 2
        w, best, g, h = w + share * move, value, g2, h2
    else:
        raise ValueError(f"the proximal steps have not converged in {iterations} iterations")
    release(rows)
    slope = w[:-1] / scale
    return PenalizedModel(xs, np.append(slope, w[-1] - slope @ mean), "logistic")
