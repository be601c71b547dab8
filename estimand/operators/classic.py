"""Textbook tests from group moments."""

import math

from pyspark.sql import functions as F

from estimand.functions import dist
from estimand.functions.columns import as_column, as_double
from estimand.operators.ttest import check_alternative
from estimand.plans.finalize import finalize, pack
from estimand.plans.moments import moments

TWO_SAMPLE_SCHEMA = "statistic double, df double, p_value double, lower double, upper double"


def _arms(df, value, index):
    rows = df.select(as_double(value).alias("_v"), as_column(index).cast("bigint").alias("_index")).dropna()
    stats = rows.where("_index in (0, 1)").groupBy("_index").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg("_v").alias("mean"), F.var_samp("_v").alias("var")
    )
    return pack(stats, [], "_index", ["n", "mean", "var"], 2)


def _two(row):
    cells = {c["key"]: c for c in row["cells"]}
    if 0 not in cells or 1 not in cells:
        raise ValueError("the index must contain 0 and 1")
    return cells[0], cells[1]


def _tail(stat, sf, alternative):
    if math.isnan(stat):
        return math.nan
    return {"two-sided": 2 * sf(abs(stat)), "greater": sf(stat), "less": sf(-stat)}[alternative]


def _t_test(df, value, index, alternative, alpha, pooled):
    check_alternative(alternative)

    def fn(row):
        a, b = _two(row)
        diff = a["mean"] - b["mean"]
        if pooled:
            dof = a["n"] + b["n"] - 2
            s2 = ((a["n"] - 1) * a["var"] + (b["n"] - 1) * b["var"]) / dof
            se = math.sqrt(s2 * (1 / a["n"] + 1 / b["n"]))
        else:
            va, vb = a["var"] / a["n"], b["var"] / b["n"]
            se = math.sqrt(va + vb)
            dof = (va + vb) ** 2 / (va**2 / (a["n"] - 1) + vb**2 / (b["n"] - 1)) if va + vb > 0 else math.nan
        t = diff / se if se > 0 else math.nan
        half = dist.t_ppf(1 - alpha / 2, dof) * se if dof > 0 else math.nan
        yield {"statistic": t, "df": dof, "p_value": _tail(t, lambda x: dist.t_sf(x, dof), alternative),
               "lower": diff - half, "upper": diff + half}

    return finalize(_arms(df, value, index), fn, TWO_SAMPLE_SCHEMA)


def student_ttest(df, value, index, alternative="two-sided", alpha=0.05):
    """Pooled-variance t-test of group 0 minus group 1."""
    return _t_test(df, value, index, alternative, alpha, True)


def welch_ttest(df, value, index, alternative="two-sided", alpha=0.05):
    """Unequal-variance t-test of group 0 minus group 1."""
    return _t_test(df, value, index, alternative, alpha, False)


def mean_ztest(df, value, index, var0, var1, alternative="two-sided", alpha=0.05):
    """z-test of group 0 minus group 1 with known population variances."""
    check_alternative(alternative)

    def fn(row):
        a, b = _two(row)
        se = math.sqrt(var0 / a["n"] + var1 / b["n"])
        diff = a["mean"] - b["mean"]
        z, half = diff / se, dist.norm_ppf(1 - alpha / 2) * se
        yield {"statistic": z, "df": None, "p_value": _tail(z, dist.norm_sf, alternative),
               "lower": diff - half, "upper": diff + half}

    return finalize(_arms(df, value, index), fn, TWO_SAMPLE_SCHEMA)


def anova(df, value, group):
    """One-way analysis of variance over any number of groups."""
    rows = df.select(as_double(value).alias("_v"), as_column(group).alias("_g")).dropna()
    n = F.count(F.lit(1))
    groups = rows.groupBy("_g").agg(n.alias("n"), F.avg("_v").alias("m"), (F.var_pop("_v") * n).alias("m2"))
    whole = rows.agg(F.avg("_v").alias("m")).first()["m"]
    if whole is None:
        raise ValueError("no complete rows")
    agg = groups.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("m2").alias("within"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.lit(whole), F.lit(2))).alias("between"),
    )

    def fn(row):
        d1, d2 = row["k"] - 1, row["n"] - row["k"]
        if d1 < 1 or d2 < 1 or row["within"] <= 0:
            f = math.nan
        else:
            f = (row["between"] / d1) / (row["within"] / d2)
        yield {"f_statistic": f, "df_between": d1, "df_within": d2, "p_value": dist.f_sf(f, d1, d2)}

    return finalize(agg, fn, "f_statistic double, df_between bigint, df_within bigint, p_value double")


def corr_covar_matrix(df, cols):
    """Covariance and correlation of every pair i <= j of ``cols``, one scan."""
    k = len(cols)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    at = {pair: F.col("comoment")[p] for p, pair in enumerate(pairs)}
    n = F.col("n")
    cells = [
        F.struct(
            F.lit(str(cols[i])).alias("x"), F.lit(str(cols[j])).alias("y"),
            F.try_divide(at[i, j], n - 1).alias("covar_samp"), F.try_divide(at[i, j], n).alias("covar_pop"),
            F.try_divide(at[i, j], F.sqrt(at[i, i]) * F.sqrt(at[j, j])).alias("corr"),
        )
        for i, j in pairs
    ]
    return moments(df, cols).select(F.inline(F.array(*cells)))
