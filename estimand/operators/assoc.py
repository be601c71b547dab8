"""Association of categorical columns from contingency counts."""

from pyspark.sql import functions as F

from estimand.functions.columns import as_column


def contingency_counts(df, a, b):
    """n per non-empty (a, b) cell."""
    return df.select(as_column(a).alias("a"), as_column(b).alias("b")).dropna().groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n")
    )


def categorical_assoc(df, a, b):
    """One row: chi-square and the coefficients derived from it, Theil's U.

    Only non-empty cells and the two margins are used, all as aggregates of the
    counts, so a high-cardinality column does not build a dense table.
    """
    cells = contingency_counts(df, a, b)
    rows = cells.groupBy("a").agg(F.sum("n").alias("na"))
    cols = cells.groupBy("b").agg(F.sum("n").alias("nb"))
    joined = cells.join(rows, "a").join(cols, "b")
    n = F.col("n").cast("double")
    log_n = F.log("n")
    main = joined.agg(
        F.sum("n").cast("double").alias("n"), F.sum(n * n / (F.col("na") * F.col("nb"))).alias("s"),
        # sum n log(n / nb): the conditional entropy of a given b, times -N
        F.sum(n * (log_n - F.log("nb"))).alias("h_cond"),
        F.sum(n * (F.log("na"))).alias("h_a"),
    ).select(
        "*", rows.agg(F.count(F.lit(1)).cast("double")).scalar().alias("r"),
        cols.agg(F.count(F.lit(1)).cast("double")).scalar().alias("c"),
    )
    phi2 = F.greatest(F.col("s") - 1, F.lit(0.0))
    total = F.col("n")
    fixed = F.greatest(phi2 - (F.col("r") - 1) * (F.col("c") - 1) / (total - 1), F.lit(0.0))
    r2 = F.col("r") - F.pow(F.col("r") - 1, F.lit(2)) / (total - 1)
    c2 = F.col("c") - F.pow(F.col("c") - 1, F.lit(2)) / (total - 1)
    entropy_a = F.log(total) - F.col("h_a") / total
    entropy_cond = -F.col("h_cond") / total
    return main.select(
        total.cast("bigint").alias("n"), (phi2 * total).alias("chisquare"),
        F.sqrt(F.try_divide(phi2, F.least("r", "c") - 1)).alias("cramers_v"),
        F.sqrt(F.try_divide(fixed, F.least(r2, c2) - 1)).alias("cramers_v_bias_corrected"),
        F.sqrt(phi2 / (1 + phi2)).alias("contingency"),
        F.try_divide(entropy_a - entropy_cond, entropy_a).alias("theils_u"),
    )


def entropy(df, c):
    """Shannon entropy in bits of the value distribution."""
    counts = df.select(as_column(c).alias("v")).dropna().groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return counts.agg(
        (F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("entropy")
    )


def categorical_iv(df, category, tag):
    """Weight of evidence and information value of each category for a 0/1 tag."""
    t = as_column(tag).cast("int")
    counts = df.select(as_column(category).cast("string").alias("category"), t.alias("t")).dropna().groupBy(
        "category").agg(F.count_if(F.col("t") == 1).alias("n1"), F.count_if(F.col("t") == 0).alias("n0"))
    d1 = F.try_divide(F.col("n1").cast("double"), counts.agg(F.sum("n1").cast("double")).scalar())
    d0 = F.try_divide(F.col("n0").cast("double"), counts.agg(F.sum("n0").cast("double")).scalar())
    woe = F.when((F.col("n1") > 0) & (F.col("n0") > 0), F.log(d1 / d0))
    return counts.select("category", "n1", "n0", woe.alias("woe"), ((d1 - d0) * woe).alias("iv"))
