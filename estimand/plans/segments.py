"""Running sums inside groups, with one global order for all groups.

Rows are range-partitioned by (group, order) and sorted, so a huge group is cut
into many tasks and many small groups share one.  A task sums each segment it
meets from zero; only the first segment of a partition can have begun in an
earlier one, and it gets the totals of that group there.  So the state that is
carried has at most two rows for each partition, however many groups there are.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from estimand.plans.prefix import stored


def _starts(columns, before):
    """Whether each row begins a new segment; ``before`` holds the keys of the row in front of the batch, or None."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    for c in columns:
        code = c.dictionary_encode().indices
        code = np.where(np.asarray(code.is_null()), -1, np.asarray(code.fill_null(0)))
        new[1:] |= code[1:] != code[:-1]
    new[0] = before is None or any(not c[0].equals(x) for c, x in zip(columns, before))
    return new


def _sums(x, new, first, carry):
    """Sums in front of each row and up to it; segments begin at the rows ``first``, the open one continues with ``carry``."""
    ahead = np.cumsum(x, axis=1) - x
    base = np.concatenate([-carry[:, None], ahead[:, first]], axis=1)
    local = ahead - base[:, np.cumsum(new)]
    return local, local + x


def _maxima(x, new, first, carry):
    """As ``_sums``, for maxima; nulls do not count."""
    x = np.where(np.isnan(x), -np.inf, x)
    upto = x.copy()
    edges = [0, *first[first > 0].tolist(), x.shape[1]]
    for a, b in zip(edges, edges[1:]):
        upto[:, a:b] = np.maximum.accumulate(x[:, a:b], axis=1)
    open_end = first[0] if len(first) else x.shape[1]
    upto[:, :open_end] = np.maximum(upto[:, :open_end], carry[:, None])
    local = np.concatenate([carry[:, None], upto[:, :-1]], axis=1)
    local[:, first] = -np.inf
    return local, upto


def _scan(by, values, names, kind="sum"):
    """Sums (or maxima) before each row in its segment of the partition; then the totals of the first and of the last segment."""
    fold = _sums if kind == "sum" else _maxima
    zero = 0.0 if kind == "sum" else -np.inf

    def run(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        held, schema, number, head = None, None, -1, None  # keys of the open segment, its number, total of the first segment
        carry = np.full(len(values), zero)
        for batch in batches:
            n, schema = batch.num_rows, batch.schema
            if not n:
                continue
            keys = [batch.column(c) for c in by]
            new = _starts(keys, held) if by else np.arange(n) < (held is None)
            first = np.flatnonzero(new)
            x = np.array([np.asarray(batch.column(v).to_numpy(zero_copy_only=False), float) for v in values])
            local, upto = fold(x, new, first, carry)
            ends = first[1 if held is None else 0 :]
            if head is None and len(ends):
                at = ends[0]
                head = (held if held is not None else [c[0] for c in keys], upto[:, at - 1] if at else carry)
            place = number + np.cumsum(new)
            number, carry, held = int(place[-1]), upto[:, -1], [c[n - 1] for c in keys]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(v) for v in local), pa.array(place == 0), pa.array(np.full(n, pid, np.int32)), pa.array(np.zeros(n, np.int32))], names=names)
        for kind, (own, total) in enumerate([head, (held, carry)] if head is not None else [(held, carry)] if held is not None else [], 1):
            row = dict(zip(by, own))
            cells = [pa.array([row[f.name].as_py()], f.type) if f.name in row else pa.nulls(1, f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(
                [*cells, *(pa.array([float(v)]) for v in total), pa.array([kind == 1]), pa.array([pid], pa.int32()), pa.array([kind], pa.int32())], names=names)

    return run


def segmented_prefix(df, by, order, values, keep=()):
    """Columns ``by``, ``order``, ``keep``, ``values`` and ``<v>_before``: the sum of v over earlier rows of the same group.

    ``order`` identifies rows inside a group (equal values are aggregated
    first); values are numbers without nulls.  Keys stay exact and may be null.
    ``df``'s rows are shuffled once and stored; the scan result is a stored
    table joined with one row for each partition.
    """
    return _scanned(df, by, order, values, keep, "sum")


def segmented_max(df, by, order, values, keep=()):
    """As ``segmented_prefix``, for the largest value (null: none) of earlier rows; meant for few large groups."""
    return _scanned(df, by, order, values, keep, "max")


def _scanned(df, by, order, values, keep, kind):
    kept = list(dict.fromkeys([*by, *order, *keep, *values]))
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    ranged = rows.repartitionByRange(*[F.col(f"`{c}`") for c in [*by, *order]]).sortWithinPartitions(*[F.col(f"`{c}`") for c in [*by, *order]])
    local = [f"_l_{v}" for v in values]
    names = [*kept, *local, "_head", "_pid", "_kind_"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema += "".join(f", `{c}` double" for c in local) + ", _head boolean, _pid int, _kind_ int"
    fixed = stored(ranged.mapInArrow(_scan(list(by), list(values), names, kind), schema))
    # at most two rows for each partition: its first segment (kind 1), which may have rows before it, and its last (kind 2)
    totals = fixed.where("_kind_ > 0").select(*[F.col(f"`{c}`") for c in by], "_pid", "_kind_", *[F.col(f"`{c}`") for c in local])
    earlier = W.partitionBy(*[F.col(f"`{c}`") for c in by] or [F.lit(0)]).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    fold, zero = (F.sum, 0.0) if kind == "sum" else (F.max, float("-inf"))
    carried = totals.select(F.col("_pid").alias("_to"), "_kind_", *[F.coalesce(fold(F.col(f"`{c}`")).over(earlier), F.lit(zero)).alias(f"_carry{i}") for i, c in enumerate(local)])
    carried = carried.where("_kind_ = 1").drop("_kind_")
    joined = fixed.where("_kind_ = 0").join(F.broadcast(carried), F.col("_pid") == F.col("_to"), "left")
    before = []
    for i, (c, v) in enumerate(zip(local, values)):
        own, carry = F.col(f"`{c}`"), F.when(F.col("_head"), F.coalesce(F.col(f"_carry{i}"), F.lit(zero))).otherwise(F.lit(zero))
        before.append((own + carry if kind == "sum" else F.nullif(F.greatest(own, carry), F.lit(zero))).alias(f"{v}_before"))
    return joined.select(*[F.col(f"`{c}`") for c in kept], *before)


def with_totals(scanned, by, **totals):
    """Add totals of each group (aggregate columns by name) to every row; groups are compared null-safe."""
    names = [f"_g{i}" for i in range(len(by))]
    sums = scanned.groupBy(*[F.col(f"`{b}`").alias(n) for b, n in zip(by, names)]).agg(*[c.alias(n) for n, c in totals.items()])
    same = [F.col(f"`{b}`").eqNullSafe(F.col(n)) for b, n in zip(by, names)]
    return scanned.join(sums, same).drop(*names)


class Groups:
    """Group columns under names of their own, so that no column of the user's can clash with those of an operator."""

    def __init__(self, by):
        self.by = list(by)
        self.names = [f"_b{i}" for i in range(len(self.by))] or ["_all"]

    def columns(self):
        return [F.col(b).alias(n) for b, n in zip(self.by, self.names)] if self.by else [F.lit(0).alias("_all")]

    def restored(self):
        """The columns to put first in a result."""
        return [F.col(n).alias(b) for b, n in zip(self.by, self.names)] if self.by else []

    def schema(self, df):
        """DDL of the inner names, to be put before a result schema."""
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        return "".join(f"`{n}` {kinds[n]}, " for n in self.names)
