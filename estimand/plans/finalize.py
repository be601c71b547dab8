"""Turning a few aggregated rows into typed result rows."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def finalize(agg: DataFrame, fn, schema):
    """Apply ``fn(row) -> iterable of dicts`` to every *aggregated* row.

    The columns of ``schema`` come back typed; a row costs one Arrow record, so
    this belongs after a groupBy, never before it.
    """
    wanted = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for batch in batches:
            rows = [r for values in batch.to_pylist() for r in fn({k: _cell(v) for k, v in values.items()})]
            yield pa.RecordBatch.from_pylist([{n: None if _missing(r.get(n)) else r.get(n) for n in wanted.names} for r in rows], schema=wanted)

    return agg.mapInArrow(run, schema)


def _cell(v):
    """Arrays of numbers as NumPy arrays; keys stay exact (a whole number beside nulls is no float)."""
    if isinstance(v, list) and v and all(x is None or isinstance(x, (int, float)) for x in v):
        return np.array([math.nan if x is None else x for x in v])
    return v


def _missing(v):
    return v is None or isinstance(v, float) and math.isnan(v)


def pack(agg, by, key, fields, limit):
    """Collect at most ``limit + 1`` keyed rows per group into one array.

    The rank filter becomes a per-partition group limit, so a mistakenly
    high-cardinality key never builds a big array; callers raise when they see
    more than ``limit`` entries.
    """
    w = W.partitionBy(*by).orderBy(key) if by else W.partitionBy(F.lit(0)).orderBy(key)
    kept = agg.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit + 1)
    cell = F.struct(F.col(key).alias("key"), *[F.col(f) for f in fields])
    return kept.groupBy(*by).agg(F.sort_array(F.collect_list(cell)).alias("cells"))


def by_schema(df, by):
    """DDL of the grouping columns, to be put before a result schema."""
    if not by:
        return ""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return "".join(f"`{b}` {fields[b]}, " for b in by)
