"""Catalog tables, views and partitions."""

from pyspark.sql import functions as F


def write_bucketed(df, table, bucket_column, num_buckets, partition_column=None, sort_column=None, mode="errorifexists"):
    """Table hashed by ``bucket_column``: equal keys share a bucket file, so
    joins and groupings on it need no shuffle."""
    # one task per bucket file instead of one file per task and bucket
    writer = df.repartition(num_buckets, bucket_column).write.mode(mode).bucketBy(num_buckets, bucket_column)
    if sort_column:
        writer = writer.sortBy(sort_column)
    if partition_column:
        writer = writer.partitionBy(partition_column)
    writer.saveAsTable(table)


def colocated(df, table, key, num_buckets, columns=None):
    """``df`` kept as a table hashed and sorted by ``key``; two of them with one number of buckets join without a shuffle."""
    names = [c for c in (columns or df.columns) if c != key]
    write_bucketed(df.select(key, *names), table, key, num_buckets, sort_column=key, mode="overwrite")
    return df.sparkSession.table(table)


def export_table(df, path):
    """Parquet export that refuses an existing target."""
    df.write.mode("errorifexists").parquet(path)


def append_auto(df, table, partition_by=None, add_day=False):
    """Create the table on first use, append afterwards; ``add_day`` stamps rows
    with ``day_`` for retention."""
    out = df.withColumn("day_", F.current_date()) if add_day else df
    writer = out.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.saveAsTable(table)


def retain_days(df, days=14, column="day_"):
    """Rows inside the retention period (the filter prunes day partitions)."""
    return df.where(F.col(column) >= F.date_sub(F.current_date(), days))


def create_view(spark, name, select, table, where=None, group_by=None, limit=None, bucket_column=None,
                num_buckets=None, materialize=False):
    """View over one table; ``materialize`` stores its rows as a table, bucketed if ``bucket_column`` is given."""
    df = spark.table(table) if isinstance(table, str) else table
    if where:
        df = df.where(where)
    select = [select] if isinstance(select, str) else list(select)
    if group_by:
        keys = [group_by] if isinstance(group_by, str) else list(group_by)
        aggregates = [F.expr(s) for s in select if s not in keys]
        df = df.groupBy(*keys).agg(*aggregates)
    else:
        df = df.selectExpr(*select)
    if limit is not None:
        df = df.limit(limit)
    if bucket_column and bucket_column not in df.columns:
        raise ValueError(f"bucket column {bucket_column} is not in the view")
    if not materialize:
        df.createOrReplaceTempView(name)
    elif bucket_column:
        write_bucketed(df, name, bucket_column, num_buckets or spark.sparkContext.defaultParallelism)
    else:
        df.write.saveAsTable(name)
    return spark.table(name)


def drop_view(spark, name):
    """Drop a temp view or a table of that name."""
    if not spark.catalog.dropTempView(name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_partition(spark, table, column, value):
    """Remove one partition directory; the other partitions are not rewritten."""
    literal = f"'{value}'" if isinstance(value, str) else str(value)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = {literal})")


def describe(df):
    """(column, type, filled) rows of a frame: ``filled`` counts its values that are not null, in one scan."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    cells = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("filled"))
             for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*cells)))


def list_tables(spark, counts=False):
    """Tables and views of the current database, optionally with row counts."""
    rows = [
        (t.name, t.tableType, bool(t.isTemporary), spark.table(t.name).count() if counts else None)
        for t in spark.catalog.listTables()
    ]
    return spark.createDataFrame(rows, "name string, type string, is_temporary boolean, rows bigint")
