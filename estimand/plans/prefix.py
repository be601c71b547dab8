"""Global order without a single-partition window.

Spark range-partitions and sorts the rows, each task emits its local running
totals, and only one row per partition is needed to turn local into global
positions.  Callers aggregate equal keys first (or order by a unique key), so a
value that holds a third of the rows is still one row, or many splittable ones.
"""

import os
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window as W, functions as F


def shared_folder(spark):
    """The cluster's checkpoint folder: ``spark.checkpoint.dir`` of the session;
    a temporary folder only where nothing is configured (local tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            shared = os.path.join(tempfile.gettempdir(), "estimand-checkpoints")
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def reliable_checkpoint(df):
    """``checkpoint()`` in the shared folder; keeps partitions and their order."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark's setting to delete a query's shuffle files when it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of tables that ``stored`` wrote and nothing has released.
_STORED = []


def stored(df):
    """Parquet copy in the shared folder: later reads prune columns.  It stays until it is released; the shuffle files it was made from go at once."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    _STORED.append(path)
    copy = spark.read.schema(df.schema).parquet(path)
    copy.stored_path = path
    return copy


def release(*tables):
    """Delete tables that ``stored`` returned, after their last reader has been written."""
    for table in tables:
        _delete(table.sparkSession, table.stored_path)


def stored_paths():
    """Paths of the tables in the shared folder that nothing has released."""
    return list(_STORED)


def release_all(spark, but=()):
    """Delete every table that ``stored`` wrote, except the paths ``but``: results that read them must have been written."""
    for path in stored_paths():
        if path not in but:
            _delete(spark, path)


def _delete(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if path in _STORED:
        _STORED.remove(path)


def global_position(df, order, keep=None, name="position"):
    """Add ``name``: the number of rows ordered before this one.

    ``order`` must identify rows.  Rows are range-partitioned and sorted; the
    partition and index of a row (``monotonically_increasing_id``) are stored
    with it, and the row counts of earlier partitions are broadcast (one row
    per partition).
    """
    kept = list(df.columns if keep is None else keep)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = stored(ranged.select(*kept, F.monotonically_increasing_id().alias("_mid")))
    fixed = fixed.withColumn("_pid", F.shiftright("_mid", 33))
    upto = W.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    starts = fixed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"))
    inside = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return fixed.join(F.broadcast(starts), "_pid").select(*kept, (F.col("_start") + inside).alias(name))


def sorted_partials(df, order, fn, schema):
    """Range-partition by ``order``, sort, and map each partition to partials.

    ``fn(iterator of pandas batches)`` sees one sorted partition; a single pass,
    nothing is stored.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInPandas(fn, schema)


def prefix_sum(df, order, values, keep=None):
    """Add ``<v>_before``: the sum of ``v`` over all rows ordered before this one.

    ``keep`` limits the other columns carried along (default all).
    ``order`` must identify rows (ties would be ordered arbitrarily).  The
    sorted partitions are checkpointed, so partition numbers are data and not a
    property of one attempt; per-partition totals (one row each) are broadcast.
    """
    kept = list(dict.fromkeys([*(df.columns if keep is None else keep), *values]))
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*kept, F.spark_partition_id().alias("_pid"))
    )
    fixed = reliable_checkpoint(ranged)
    totals = fixed.groupBy("_pid").agg(*[F.sum(v).cast("double").alias(f"_t_{v}") for v in values])
    upto = W.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_t_{v}").over(upto), F.lit(0.0)).alias(f"_o_{v}") for v in values]
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fixed.schema.fields)
    schema += "".join(f", `_l_{v}` double" for v in values)
    local = fixed.mapInArrow(_running(values), schema)
    joined = local.join(F.broadcast(offsets), "_pid")
    return joined.select(
        *kept, *[(F.col(f"_l_{v}") + F.col(f"_o_{v}")).alias(f"{v}_before") for v in values]
    )


def _running(values):
    """Arrow batches, so that the columns carried along stay as they are."""

    def run(batches):
        carry = dict.fromkeys(values, 0.0)
        for batch in batches:
            local = []
            for v in values:
                x = np.asarray(batch.column(v).to_numpy(zero_copy_only=False), float)
                local.append(pa.array(carry[v] + np.cumsum(x) - x))
                carry[v] += float(x.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, *local], names=[*batch.schema.names, *(f"_l_{v}" for v in values)])

    return run


def partial_frame(**cells):
    """One-row pandas frame for ``sorted_partials``."""
    return pd.DataFrame({k: [v] for k, v in cells.items()})
