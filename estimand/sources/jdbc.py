"""JDBC transfer, partitioned by disjoint predicates."""

from functools import reduce

from pyspark.sql import DataFrame


def partition_predicates(column, num_partitions, lower=None, upper=None):
    """Disjoint predicates that cover every row once.

    With bounds: ranges (open at both ends, nulls in the first).  Without:
    remainders of an integer column.
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be positive")
    if num_partitions == 1:
        return ["1 = 1"]
    if lower is None or upper is None:
        first = f"(MOD({column}, {num_partitions}) = 0 OR {column} IS NULL)"
        # negative values have negative remainders
        return [first] + [
            f"(MOD({column}, {num_partitions}) = {i} OR MOD({column}, {num_partitions}) = {i - num_partitions})"
            for i in range(1, num_partitions)
        ]
    step = (upper - lower) / num_partitions
    cuts = [lower + step * i for i in range(1, num_partitions)]
    out = [f"({column} < {cuts[0]} OR {column} IS NULL)"]
    out += [f"({column} >= {a} AND {column} < {b})" for a, b in zip(cuts, cuts[1:])]
    return out + [f"{column} >= {cuts[-1]}"]


def read_jdbc(spark, url, table, column, num_partitions=10, lower=None, upper=None, properties=None):
    return spark.read.jdbc(
        url, table, predicates=partition_predicates(column, num_partitions, lower, upper), properties=properties or {}
    )


def read_union(frames):
    """Union of per-source frames by column name."""
    return reduce(DataFrame.unionByName, frames)


def write_jdbc(df, url, table, batchsize=10_000, num_partitions=None, mode="append", properties=None):
    writer = df.write.mode(mode).option("batchsize", batchsize)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    writer.jdbc(url, table, properties=properties or {})
