"""Per-value arm statistics for several grouping columns at once."""

from pyspark.sql import functions as F

from estimand.functions.columns import as_column, as_double
from estimand.plans.segments import Groups


def group_set(df, y, treatment, groups, names=None, by=()):
    """cnt, sum, sum2 of ``y`` per (name, treatment 0/1, group_key).

    ``groups`` are grouped independently; keys are bigint if all are whole-number
    expressions, else their text.  Both arms are
    always present (zeros when empty); rows with another treatment value only
    make their group key appear.  With ``by`` all of it holds in every group of
    those columns, which come first in the result (null is a group).
    """
    own = Groups(by)
    names = list(names) if names else [f"col{i + 1}" for i in range(len(groups))]
    if not groups or len(names) != len(groups):
        raise ValueError("needs at least one grouping column and one name per column")
    picked = df.select(
        *own.columns(), as_double(y).alias("_y"), as_column(treatment).cast("bigint").alias("_t"),
        *[as_column(g).alias(f"_g{i}") for i, g in enumerate(groups)],
    ).dropna(subset=["_y", "_t", *[f"_g{i}" for i in range(len(groups))]])
    kinds = {picked.schema[f"_g{i}"].dataType.simpleString() for i in range(len(groups))}
    kind = "bigint" if kinds <= {"tinyint", "smallint", "int", "bigint"} else "string"
    picked = picked.withColumns({f"_g{i}": F.col(f"_g{i}").cast(kind) for i in range(len(groups))})
    keys = F.array(*[
        F.struct(F.lit(n).alias("name"), F.col(f"_g{i}").alias("group_key")) for i, n in enumerate(names)
    ])
    stats = (
        picked.select(*own.names, "_y", "_t", F.inline(keys))
        .groupBy(*own.names, "name", "group_key")
        .agg(*[
            F.struct(
                F.lit(t).alias("treatment"),
                F.count_if(F.col("_t") == t).alias("cnt"),
                F.coalesce(F.sum(F.when(F.col("_t") == t, F.col("_y"))), F.lit(0.0)).alias("sum"),
                F.coalesce(F.sum(F.when(F.col("_t") == t, F.col("_y") * F.col("_y"))), F.lit(0.0)).alias("sum2"),
            ).alias(f"arm{t}")
            for t in (0, 1)
        ])
    )
    return stats.select(*own.names, "name", "group_key", F.inline(F.array("arm0", "arm1"))).select(
        *own.restored(), "name", "treatment", "group_key", "cnt", "sum", "sum2"
    )
