"""Experiment report on hashed buckets: two groups, ratio metric x1/x2."""

import math

import numpy as np
from pyspark.sql import functions as F

from estimand.functions import dist
from estimand.functions.columns import as_column, as_double, murmur_bucket
from estimand.functions.formula import read_metric
from estimand.operators.ttest import adjusted_pair, normal_p
from estimand.plans.finalize import finalize
from estimand.plans.moments import Moments

BUCKETS = 128  # fixed value: the top seven hash bits
SCHEMA = (
    "group0 string, group1 string, numerator0 double, numerator1 double, "
    "denominator0 double, denominator1 double, numerator_pre0 double, numerator_pre1 double, "
    "denominator_pre0 double, denominator_pre1 double, mean0 double, mean1 double, "
    "std_samp0 double, std_samp1 double, diff double, diff_relative double, "
    "lower double, upper double, lower_relative double, upper_relative double, "
    "t_statistic double, p_value double, power double, recommend_samplesize double"
)


def power_at(mean0, stderr, mde, alpha):
    shift = abs(mean0 * mde) / stderr
    return (
        dist.norm_sf(dist.norm_ppf(1 - alpha / 2) - shift) + dist.norm_cdf(dist.norm_ppf(alpha / 2) - shift)
    )


def sample_size(std0, std1, den0, den1, mean0, alpha, mde, power):
    ratio = den0 / den1
    z = dist.norm_ppf(1 - alpha / 2) - dist.norm_ppf(1 - power)
    return ((std0 / std1) ** 2 + ratio) / ratio * z**2 * (std1 / mean0) ** 2 / mde**2


def report(b0, b1, rows, metrics, alpha, mde, power):
    """Statistics from two (128, k) arrays of bucket sums."""
    (mean0, var0), (mean1, var1) = adjusted_pair(
        _of_rows(b0), _of_rows(b1), metrics, theta_from=_of_rows(b0 + b1)
    )
    s0, s1 = b0.sum(axis=0), b1.sum(axis=0)
    with np.errstate(all="ignore"):
        std0, std1 = float(np.sqrt(var0 * s0[1])), float(np.sqrt(var1 * s1[1]))
        diff, stderr = mean1 - mean0, float(np.sqrt(var0 + var1))
        t = float(np.float64(diff) / np.float64(stderr))
        half = abs(dist.t_ppf(alpha / 2, rows) * stderr) if alpha > 0 else None
        lower, upper = (diff - half, diff + half) if half is not None else (0.0, 0.0)
        base = np.float64(mean0)
        out = {
            "numerator0": s0[0], "numerator1": s1[0], "denominator0": s0[1], "denominator1": s1[1],
            "mean0": mean0, "mean1": mean1, "std_samp0": std0, "std_samp1": std1,
            "diff": diff, "diff_relative": float(diff / base), "lower": lower, "upper": upper,
            "lower_relative": float(lower / base), "upper_relative": float(upper / base),
            "t_statistic": t, "p_value": normal_p(t, "two-sided"),
        }
    if stderr > 0 and 0 < alpha < 1 and mean0 != 0:
        out["power"] = power_at(mean0, stderr, mde, alpha)
        if mde != 0 and std1 > 0 and 0 < power < 1:
            out["recommend_samplesize"] = float(
                math.floor(sample_size(std0, std1, s0[1], s1[1], mean0, alpha, mde, power))
            )
    if len(s0) >= 4:
        out.update(numerator_pre0=s0[2], numerator_pre1=s1[2], denominator_pre0=s0[3], denominator_pre1=s1[3])
    return out


def _of_rows(x):
    mean = x.mean(axis=0)
    d = x - mean
    return Moments(len(x), mean, d.T @ d)


def xexpt_ttest_2samp(df, args, uin, group, alpha=0.05, mde=0.005, power=0.8, cuped=None, bucket=None):
    """Report for ``args`` = [numerator, denominator, pre-period columns...].

    ``uin`` is hashed into 128 buckets (seed-0 murmur3, top 7 bits); ``bucket``
    replaces the hash by an own 0..127 expression.  The scan reduces to at most
    2 x 128 bucket rows before anything leaves the aggregate.
    """
    if len(args) < 2:
        raise ValueError("needs at least [numerator, denominator]")
    _, metrics = read_metric("x1/x2", args, cuped) if cuped else (None, read_metric("x1/x2", args[:2])[1])
    k = len(args)
    where = as_column(bucket).cast("int") if bucket is not None else murmur_bucket(uin)
    picked = df.select(
        as_column(group).alias("_group"), where.alias("_bucket"),
        *[as_double(a).alias(f"_x{i}") for i, a in enumerate(args)],
    ).dropna()
    sums = [F.sum(f"_x{i}") for i in range(k)]
    buckets = picked.groupBy("_group", "_bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*sums).alias("sums")
    )
    # at most 128 cells per group; a third group is kept only to be refused
    groups = (
        buckets.groupBy("_group")
        .agg(F.sum("rows").alias("rows"), F.collect_list(F.struct("_bucket", "sums")).alias("cells"))
        .orderBy("_group")
        .limit(3)
        .select(F.col("_group"), F.struct("rows", "cells").alias("data"))
    )
    packed = groups.coalesce(1).agg(
        F.sort_array(F.collect_list(F.struct("_group", "data"))).alias("groups")
    )

    def fn(row):
        found = row["groups"]
        if len(found) != 2:
            raise ValueError("exactly two groups are needed")
        tables = []
        for g in found:
            table = np.zeros((BUCKETS, k))
            for cell in g["data"]["cells"]:
                table[cell["_bucket"]] = cell["sums"]
            tables.append(table)
        rows = sum(g["data"]["rows"] for g in found)
        yield {
            "group0": str(found[0]["_group"]), "group1": str(found[1]["_group"]),
            **report(tables[0], tables[1], rows, metrics, alpha, mde, power),
        }

    return finalize(packed, fn, SCHEMA)
