"""Connected components of a table of links, by contraction."""

from pyspark.sql import functions as F

from estimand.plans.prefix import release, stored


def components(links, a="a", b="b"):
    """(node, comp) for every node of a link: comp is the smallest node it reaches.

    Each round every node points to its smallest neighbour, links are rewritten
    to the pointed-at nodes and loops go, until no link is left.  Rounds are
    written to the shared folder, so a lost executor costs one round; the result is
    a stored table that the caller may release.
    """
    left = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    left = stored(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label = None
    while left.head(1):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("up"))
        over = parent.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        parent = stored(parent.join(over, F.col("up") == F.col("_n"), "left").select("node", F.coalesce("_u", "up").alias("up")))
        before, earlier = label, left
        if label is None:
            label = stored(parent.select("node", F.col("up").alias("comp")))
        else:
            label = stored(label.join(parent.withColumnRenamed("node", "comp"), "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")))
        ends = left.join(parent.select(F.col("node").alias("a"), F.col("up").alias("ua")), "a").join(parent.select(F.col("node").alias("b"), F.col("up").alias("ub")), "b")
        left = stored(ends.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).where("a <> b").distinct())
        release(parent, earlier, *([before] if before is not None else []))
    if label is None:
        return stored(left.select(F.col("a").alias("node"), F.col("b").alias("comp")))
    release(left)
    return label
