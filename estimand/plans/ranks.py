"""Row numbers within groups that may be hot.

A plain window sorts a whole group in one task.  Rows of groups larger than a
limit are sorted globally by (group, order) in range partitions instead; the
rank is the global position minus that of the first row of the group.
"""

from pyspark.sql import Window as W, functions as F

from estimand.plans.prefix import global_position

HOT_ROWS = 2_000_000


def ranked(df, groups, order, key, hot_rows=HOT_ROWS, name="rank"):
    """Add ``name``: 1-based position by (order, key) inside each group.

    ``key`` columns identify rows.  A group counts as hot when it exceeds
    ``hot_rows`` rows, whatever the size of the table; the list of hot groups is
    a table and stays on the executors.  Repeated order values are split
    by key.
    """
    if name in df.columns:
        raise ValueError(f"the frame has a column {name} already; choose another name")
    order_by = [F.col(o) if isinstance(o, str) else o for o in order] + [F.col(k) for k in key]
    plain = W.partitionBy(*groups).orderBy(*order_by)
    sizes = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_size"))
    if (sizes.agg(F.max("_size")).first()[0] or 0) <= hot_rows:
        return df.withColumn(name, F.row_number().over(plain).cast("bigint"))
    hot_df = sizes.where(F.col("_size") > hot_rows).select(*[F.col(g).alias(f"_hot{i}") for i, g in enumerate(groups)])
    same = [F.col(g).eqNullSafe(F.col(f"_hot{i}")) for i, g in enumerate(groups)]
    cold_rows = df.join(hot_df, same, "left_anti").withColumn(name, F.row_number().over(plain).cast("bigint"))
    hot_rows_df = df.join(hot_df, same, "left_semi")

    # hot groups lie next to each other in one global order, cut wherever a
    # partition is full; the list of group starts is as short as that of hot groups
    placed = global_position(hot_rows_df, [*[F.col(g) for g in groups], *order_by], name="_position")
    starts = placed.groupBy(*groups).agg(F.min("_position").alias("_first")).alias("s")
    placed = placed.alias("p")
    on = [F.col(f"p.{g}").eqNullSafe(F.col(f"s.{g}")) for g in groups]
    hot_ranked = placed.join(starts, on).select(
        *[F.col(f"p.{c}") for c in df.columns], (F.col("_position") - F.col("_first") + 1).alias(name))
    return cold_rows.unionByName(hot_ranked)
