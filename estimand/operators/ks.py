"""Two-sample Kolmogorov-Smirnov test."""

import math

import numpy as np
from pyspark.sql import functions as F

from estimand.functions.columns import as_column, as_double
from estimand.operators.ttest import check_alternative
from estimand.plans.finalize import finalize
from estimand.plans.prefix import partial_frame, sorted_partials
from estimand.plans.segments import Groups, segmented_prefix, with_totals

METHODS = ("exact", "asymp", "asymptotic")
#: Cells of the lattice that the exact method may walk (n1 * n2); beyond it raises.
EXACT_CELLS = 10**9


def exact_p(d, n1, n2, two_sided):
    """Exact tail probability by the lattice-path recursion.

    c(i, j) is the probability that a random path to (i, j) has touched the
    boundary; cells of one anti-diagonal only need the previous one, so each
    diagonal is one vector step.
    """
    big, small = max(n1, n2), min(n1, n2)
    q = (0.5 + math.floor(d * small * big - 1e-7)) / (float(small) * big)
    previous = None
    for s in range(0, big + small + 1):
        i = np.arange(max(0, s - big), min(small, s) + 1)
        j = s - i
        gap = i / small - j / big
        outside = np.abs(gap) >= q if two_sided else gap >= q
        if s == 0:
            current = np.zeros(1)
        else:
            base = max(0, s - 1 - big)
            padded = np.concatenate(([0.0], previous, [0.0]))
            # padded[k + 1] is cell i = base + k of the previous diagonal
            left = padded[np.clip(i - 1 - base + 1, 0, len(padded) - 1)]
            below = padded[np.clip(i - base + 1, 0, len(padded) - 1)]
            current = (i * left + j * below) / s
        previous = np.where(outside, 1.0, current)
    return float(previous[-1])


def asymptotic_p(d, n1, n2, two_sided):
    n, m = float(min(n1, n2)), float(max(n1, n2))
    z = math.sqrt(n * m / (n + m)) * d
    if not two_sided:
        return math.exp(-2 * z * z - 2 * z * (m + 2 * n) / math.sqrt(m * n * (m + n)) / 3.0)
    if z <= 0:
        return 1.0
    if z < 1:
        # theta-function form of the Kolmogorov distribution
        terms = range(1, 21, 2)
        cdf = math.sqrt(2 * math.pi) / z * sum(math.exp(-((k * math.pi) ** 2) / (8 * z * z)) for k in terms)
        return 1.0 - cdf
    return 2.0 * sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * z * z) for k in range(1, 21))


def ks_p_value(d, n1, n2, alternative="two-sided", method="asymptotic"):
    if method == "exact" and n1 * n2 > EXACT_CELLS:
        raise ValueError(f"the exact method walks n1 * n2 cells, at most {EXACT_CELLS}; use method='asymptotic'")
    fn = exact_p if method == "exact" else asymptotic_p
    return min(1.0, max(0.0, fn(d, n1, n2, alternative == "two-sided")))


def _gap_partials(n1, n2):
    """Local extremes of F1 - F2 in one sorted partition of value counts."""

    def run(batches):
        first = None
        c1 = c2 = 0
        high, low = -math.inf, math.inf
        for pdf in batches:
            if not len(pdf):
                continue
            v = pdf["v"].to_numpy(dtype=float)
            first = v[0] if first is None else first
            k1 = c1 + np.cumsum(pdf["c1"].to_numpy())
            k2 = c2 + np.cumsum(pdf["c2"].to_numpy())
            c1, c2 = int(k1[-1]), int(k2[-1])
            gap = k1 / n1 - k2 / n2
            high, low = max(high, gap.max()), min(low, gap.min())
        if first is not None:
            yield partial_frame(first=first, c1=c1, c2=c2, high=float(high), low=float(low))

    return run


def ks_test(df, value, is_second, alternative="two-sided", method="asymptotic"):
    """(d_statistic, p_value) of ``value`` between is_second = 0 and 1.

    Values tie if they are equal as doubles, so D does not depend on the number
    of partitions.  ``exact`` is chosen by the caller and raises where its work
    is too large.  Values are reduced to counts per arm first, so a dominant value costs one
    row; the counts are range-partitioned and each task reports the extremes of
    its part of F1 - F2.  Only one row per partition meets in the finalizer.
    """
    check_alternative(alternative)
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    second = as_column(is_second).cast("bigint") != 0
    rows = df.select(as_double(value).alias("v"), second.alias("s")).dropna()
    totals = rows.agg(F.count_if(~F.col("s")).alias("n1"), F.count_if("s").alias("n2")).first()
    n1, n2 = totals["n1"], totals["n2"]
    if not n1 or not n2:
        raise ValueError("both samples must be non-empty")
    counts = rows.groupBy("v").agg(F.count_if(~F.col("s")).alias("c1"), F.count_if("s").alias("c2"))
    partials = sorted_partials(
        counts, ["v"], _gap_partials(n1, n2), "first double, c1 bigint, c2 bigint, high double, low double"
    )
    packed = partials.agg(
        F.sort_array(F.collect_list(F.struct("first", "c1", "c2", "high", "low"))).alias("parts")
    )

    def fn(row):
        base, high, low = 0.0, 0.0, 0.0
        for p in row["parts"]:
            high, low = max(high, base + p["high"]), min(low, base + p["low"])
            base += p["c1"] / n1 - p["c2"] / n2
        d = {"two-sided": max(high, -low), "less": -low, "greater": high}[alternative]
        yield {"d_statistic": d, "p_value": ks_p_value(d, n1, n2, alternative, method)}

    return finalize(packed, fn, "d_statistic double, p_value double")


def ks_grouped(df, value, is_second, by, alternative="two-sided", method="asymptotic"):
    """(by.., d_statistic, p_value): ``ks_test`` in every group of ``by``, all in one order of (group, value).

    A group with an empty sample gets nulls; ``exact`` gives a null p-value
    where its work is too large.  Group keys stay exact and may be null.
    """
    check_alternative(alternative)
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    groups = Groups(by)
    second = as_column(is_second).cast("bigint") != 0
    rows = df.select(*groups.columns(), as_double(value).alias("_v"), second.alias("_s")).dropna(subset=["_v", "_s"])
    counts = rows.groupBy(*groups.names, "_v").agg(F.count_if(~F.col("_s")).alias("_c1"), F.count_if("_s").alias("_c2"))
    placed = segmented_prefix(counts, groups.names, ["_v"], ["_c1", "_c2"])
    placed = with_totals(placed, groups.names, n1=F.sum("_c1"), n2=F.sum("_c2"))
    gap = F.try_divide(F.col("_c1_before") + F.col("_c1"), F.col("n1")) - F.try_divide(F.col("_c2_before") + F.col("_c2"), F.col("n2"))
    ends = placed.groupBy(*groups.names).agg(F.max("n1").alias("n1"), F.max("n2").alias("n2"), F.max(gap).alias("high"), F.min(gap).alias("low"))

    def fn(row):
        n1, n2 = row["n1"], row["n2"]
        own = {k: row[k] for k in groups.names}
        if n1 and n2:
            high, low = max(0.0, row["high"]), min(0.0, row["low"])
            own["d_statistic"] = d = {"two-sided": max(high, -low), "less": -low, "greater": high}[alternative]
            if method != "exact" or n1 * n2 <= EXACT_CELLS:
                own["p_value"] = ks_p_value(d, n1, n2, alternative, method)
        yield own

    found = finalize(ends, fn, groups.schema(ends) + "d_statistic double, p_value double")
    return found.select(*groups.restored(), "d_statistic", "p_value")
