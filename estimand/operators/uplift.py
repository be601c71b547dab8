"""Cumulative lift and gain curves of an effect score."""

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from estimand.functions.columns import as_column, as_double
from estimand.plans.prefix import global_position
from estimand.plans.segments import Groups, segmented_prefix, with_totals


def lift_gain_curve(df, ite, y, t, key, k=1000, discrete=True):
    """ratio, lift, gain, ate, random_gain at the ends of ``k`` score buckets.

    Rows are ranked by ``ite`` descending, ties by the unique ``key`` columns.
    Discrete treatment (0/1): lift is the cumulative treated mean minus the
    control mean and gain is cumY1 - cumY0 / n0 * n1.  Continuous treatment:
    lift is the cumulative slope of y on t, gain is lift times the rows so far.
    """
    names = [f"_k{i}" for i in range(len(key))]
    rows = df.select(
        as_double(ite).alias("_ite"), as_double(y).alias("_y"), as_double(t).alias("_t"),
        *[as_column(c).alias(n) for c, n in zip(key, names)],
    ).dropna()
    center = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("_t").alias("t"), F.avg("_y").alias("y")).first()
    n = center["n"]
    if not n:
        raise ValueError("no complete rows")
    placed = global_position(rows, [F.col("_ite").desc(), *names], keep=["_y", "_t"])
    bucket = F.expr(f"position * {int(k)}L div {n}L").cast("int") + 1
    if discrete:
        treated, y0 = F.col("_t") == 1, 0.0
        sums = {
            "c1": F.sum(F.when(treated, 1.0).otherwise(0.0)), "c0": F.sum(F.when(F.col("_t") == 0, 1.0).otherwise(0.0)),
            "y1": F.sum(F.when(treated, F.col("_y")).otherwise(0.0)),
            "y0": F.sum(F.when(F.col("_t") == 0, F.col("_y")).otherwise(0.0)),
        }
    else:
        # centred at the overall means so that the running sums keep their digits
        a, b = F.col("_t") - float(center["t"]), F.col("_y") - float(center["y"])
        sums = {"st": F.sum(a), "sy": F.sum(b), "sty": F.sum(a * b), "stt": F.sum(a * a)}
    per_bucket = placed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"),
                                                            *[c.alias(s) for s, c in sums.items()])
    # at most k rows from here on
    upto = W.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    run = per_bucket.select("bucket", *[F.sum(c).over(upto).alias(c) for c in ("cnt", *sums)])
    if discrete:
        m0 = F.try_divide(F.col("y0"), F.col("c0"))
        lift = F.try_divide(F.col("y1"), F.col("c1")) - m0
        gain = F.col("y1") - m0 * F.col("c1")
    else:
        cnt = F.col("cnt")
        lift = F.try_divide(F.col("sty") - F.col("st") * F.col("sy") / cnt,
                            F.col("stt") - F.col("st") * F.col("st") / cnt)
        gain = lift * cnt
    whole = W.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    curve = run.select((F.col("cnt") / F.lit(float(n))).alias("ratio"), "bucket", lift.alias("lift"), gain.alias("gain"))
    return curve.select(
        "ratio", "lift", "gain", F.last("lift").over(whole).alias("ate"),
        (F.col("ratio") * F.last("gain").over(whole)).alias("random_gain"),
    )


def lift_gain_grouped(df, ite, y, t, key, by, k=1000):
    """(by.., ratio, lift, gain, ate, random_gain): ``lift_gain_curve`` of a 0/1 treatment in every group, from one order of (group, score, key)."""
    groups = Groups(by)
    names = [f"_k{i}" for i in range(len(key))]
    rows = df.select(
        *groups.columns(), (-as_double(ite)).alias("_down"), as_double(y).alias("_y"), as_double(t).alias("_t"),
        *[as_column(c).alias(n) for c, n in zip(key, names)]).dropna(subset=["_down", "_y", "_t", *names]).withColumn("_one", F.lit(1))
    placed = segmented_prefix(rows, groups.names, ["_down", *names], ["_one"], keep=["_y", "_t"])
    placed = with_totals(placed, groups.names, n=F.sum("_one")).withColumn("bucket", F.floor(F.col("_one_before") * int(k) / F.col("n")).cast("int") + 1)
    treated, control = F.col("_t") == 1, F.col("_t") == 0
    share = lambda c, v: F.sum(F.when(c, v).otherwise(F.lit(0.0)))
    cells = placed.groupBy(*groups.names, "bucket").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("cnt"), share(treated, F.lit(1.0)).alias("c1"), share(control, F.lit(1.0)).alias("c0"),
        share(treated, F.col("_y")).alias("y1"), share(control, F.col("_y")).alias("y0"))
    # at most k rows of a group from here on
    upto = W.partitionBy(*groups.names).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*groups.names).orderBy("bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    run = cells.select(*groups.names, "bucket", "n", *[F.sum(c).over(upto).alias(c) for c in ("cnt", "c1", "c0", "y1", "y0")])
    m0 = F.try_divide(F.col("y0"), F.col("c0"))
    curve = run.select(*groups.names, "bucket", (F.col("cnt") / F.col("n")).alias("ratio"), (F.try_divide(F.col("y1"), F.col("c1")) - m0).alias("lift"),
                       (F.col("y1") - m0 * F.col("c1")).alias("gain"))
    return curve.select(*groups.restored(), "ratio", "lift", "gain", F.last("lift").over(whole).alias("ate"), (F.col("ratio") * F.last("gain").over(whole)).alias("random_gain"))


def hte_curve_table(curves):
    """Several curves in one table: ``curves`` maps a model label to its curve."""
    labelled = [c.withColumn("model", F.lit(name)) for name, c in curves.items()]
    return reduce(DataFrame.unionByName, labelled)
