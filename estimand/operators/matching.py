"""One-to-one matching of treated and control rows."""

from pyspark.sql import Window as W, functions as F

from estimand.functions.columns import as_column, as_double
from estimand.plans.ranks import HOT_ROWS, ranked

SLICES = 1024


def _match(df, arm, labels, order, key, hot_rows):
    """Pair equal ranks within a stratum.

    The i-th treated and the i-th control row of a stratum form a pair exactly
    when i <= min(#treated, #control), so no treated-control join is needed:
    a rank per (stratum, arm) and the pair count per stratum decide everything.
    """
    names = [f"_l{i}" for i in range(len(labels))]
    orders, keys = [f"_o{i}" for i in range(len(order))], [f"_k{i}" for i in range(len(key))]
    # the user's row travels as one column, so that no name of it can clash
    base = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "match_index"]).alias("_row"), arm.alias("_arm"), *[c.alias(n) for c, n in zip(labels, names)],
                     *[c.alias(n) for c, n in zip(order, orders)], *[F.col(c).alias(n) for c, n in zip(key, keys)])
    usable = F.col("_arm").isin(1, -1)
    for n in names:
        usable = usable & F.col(n).isNotNull()
    usable = F.coalesce(usable, F.lit(False))
    rows = base.where(usable)

    strata = rows.groupBy(*names).agg(
        F.least(F.count_if(F.col("_arm") == 1), F.count_if(F.col("_arm") == -1)).alias("_pairs")
    ).where("_pairs > 0").withColumn("_slice", F.pmod(F.xxhash64(*names), F.lit(SLICES)))
    # dense pair numbers: offset of the hash slice (at most 1024 rows) plus
    # the running count inside it
    before = W.rowsBetween(W.unboundedPreceding, -1)
    slices = strata.groupBy("_slice").agg(F.sum("_pairs").alias("_p")).select(
        "_slice",
        F.coalesce(F.sum("_p").over(before.partitionBy(F.lit(0)).orderBy("_slice")), F.lit(0)).alias("_start"),
    )
    inside = before.partitionBy("_slice").orderBy(*names)
    strata = (
        strata.join(F.broadcast(slices), "_slice")
        .withColumn("_start", F.col("_start") + F.coalesce(F.sum("_pairs").over(inside), F.lit(0)))
        .withColumn("_arm", F.explode(F.array(F.lit(1), F.lit(-1))))
        .drop("_slice")
    )
    # joined on the columns the ranks are partitioned by: the rows are not shuffled again
    placed = ranked(rows, [*names, "_arm"], orders, keys, hot_rows, name="_rank").join(strata, [*names, "_arm"], "left")
    index = F.when(F.col("_rank") <= F.col("_pairs"), F.col("_arm") * (F.col("_start") + F.col("_rank")))
    matched = placed.select("_row.*", F.coalesce(index, F.lit(0)).cast("bigint").alias("match_index"))
    rest = base.where(~usable).select("_row.*", F.lit(0).cast("bigint").alias("match_index"))
    return matched.unionByName(rest)


def _arm(treatment, treated_value, control_value):
    t = as_column(treatment)
    return F.when(t == treated_value, 1).when(t == control_value, -1).otherwise(0)


def exact_matching(df, treatment, labels, key, order=None, seed=0, treated_value=1, control_value=-1,
                   hot_rows=HOT_ROWS):
    """Add ``match_index``: +i / -i for the i-th pair, 0 for unmatched rows.

    Pairs agree on every label (nulls never match) and are formed in random
    order by a seeded hash of ``key``, or in the order of ``order``.
    """
    if not labels:
        raise ValueError("needs at least one label")
    order = [as_column(o) for o in order] if order else [F.xxhash64(F.lit(seed), *[F.col(k) for k in key])]
    return _match(df, _arm(treatment, treated_value, control_value), [as_column(x) for x in labels],
                  order, key, hot_rows)


def caliper_matching(df, treatment, score, bins, key, treated_value=1, control_value=-1, hot_rows=HOT_ROWS):
    """Match by score order inside equal bins ``int(score * bins) + 1``."""
    v = as_double(score)
    return _match(df, _arm(treatment, treated_value, control_value),
                  [(v * F.lit(bins)).cast("bigint") + 1], [v], key, hot_rows)


def matched_pairs(matched, key):
    """(pair, treated, control) keys of a matching result."""
    return (
        matched.where("match_index <> 0")
        .groupBy(F.abs("match_index").alias("pair"))
        .agg(
            F.max(F.when(F.col("match_index") > 0, F.col(key))).alias("treated"),
            F.max(F.when(F.col("match_index") < 0, F.col(key))).alias("control"),
        )
    )
