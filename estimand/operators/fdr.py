"""Benjamini-Hochberg adjustment."""

import numpy as np
from pyspark.sql import functions as F

from estimand.plans.segments import Groups, segmented_max, segmented_prefix, with_totals


def q_values(p):
    """The same adjustment for a short list of p-values on the driver."""
    p = np.asarray(p, dtype=float)
    order = np.argsort(p, kind="stable")[: int(np.sum(~np.isnan(p)))]
    m = len(order)
    q = np.full(len(p), np.nan)
    if m:
        raw = p[order] * m / np.arange(1, m + 1)
        q[order] = np.minimum(1.0, np.minimum.accumulate(raw[::-1])[::-1])
    return q


def fdr_adjust(df, p_cols, by=()):
    """Add a q-value per p column: min over larger p of p * m / rank.

    ``p_cols`` maps p columns to result names.  Equal p share a q, so p-values
    are counted first; ranks and the running minimum from the largest p on come
    from range partitions, so one family may hold all rows.
    """
    groups = Groups(by)
    for p, q in p_cols.items():
        own = df.select(*groups.columns(), F.col(p).cast("double").alias("_p")).where("_p is not null")
        counts = own.groupBy(*groups.names, "_p").agg(F.count(F.lit(1)).alias("_n"))
        ranked = with_totals(segmented_prefix(counts, groups.names, ["_p"], ["_n"]), groups.names, _m=F.sum("_n"))
        # the least of later raw values is the largest of the negated ones before, in falling order of p
        raw = ranked.select(*groups.names, (-F.col("_p")).alias("_down"), (-F.col("_p") * F.col("_m") / (F.col("_n_before") + F.col("_n"))).alias("_raw"))
        least = segmented_max(raw, groups.names, ["_down"], ["_raw"])
        found = least.select(*[F.col(n).alias(f"_g{i}") for i, n in enumerate(groups.names)], (-F.col("_down")).alias("_at"),
                             F.least(F.lit(1.0), -F.greatest("_raw", F.coalesce("_raw_before", "_raw"))).alias("_q"))
        # the user's row travels as one column, so that no name of it can clash
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != q]).alias("_row"), *groups.columns(), F.col(p).cast("double").alias("_p"))
        same = [F.col(n).eqNullSafe(F.col(f"_g{i}")) for i, n in enumerate(groups.names)]
        df = rows.join(found, [*same, F.col("_p") == F.col("_at")], "left").select("_row.*", F.col("_q").alias(q))
    return df
