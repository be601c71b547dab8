"""Mergeable second moments: one native aggregation pass, then tiny algebra.

``moments`` returns one row per group: ``n``, ``mean`` (array) and
``comoment`` (upper triangle of sum (x_i - mean_i)(x_j - mean_j)).  The
built-in covariance aggregates update centred, so digits survive n >> 1e8
where raw sums of squares would cancel.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from estimand.functions.columns import as_column, as_double
from estimand.plans.segments import _starts

MOMENT_FIELDS = "n bigint, mean array<double>, comoment array<double>"

# Built-in covariances hold four buffer fields per pair; six columns (97 fields)
# still fit the default limit of 100 fields of whole-stage code generation.
NATIVE_COLUMNS = 6
# Plain sums of products hold one field per pair: twelve columns.
NATIVE_PRODUCTS = 12
MERGE_SLOTS = 64


def moment_columns(k):
    """Aggregates over columns _m0.._m{k-1}."""
    means = [F.avg(f"_m{i}") for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    rows = F.count(F.lit(1))
    co = [F.covar_pop(f"_m{i}", f"_m{j}") * rows for i, j in pairs]
    return [rows.alias("n"), F.array(*means).alias("mean"), F.array(*co).alias("comoment")]


def moments(df, cols, by=(), required=()):
    """Second moments of ``cols`` per group of ``by``.

    Rows with a null in any of ``cols`` (or ``required`` group columns) are
    dropped first: complete-case deletion, not pairwise.
    """
    by, k = list(by), len(cols)
    picked = df.select(*by, *[as_double(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    picked = picked.dropna(subset=[f"_m{i}" for i in range(k)] + list(required))
    if k <= NATIVE_COLUMNS:
        return picked.groupBy(*by).agg(*moment_columns(k))
    return _block_moments(picked, by, k)


def _runs(columns, n):
    """First rows of the runs of equal keys among ``n`` rows."""
    return np.flatnonzero(_starts(columns, None)) if columns else np.zeros(min(n, 1), np.int64)


def _order(columns, n):
    """An order of ``n`` rows that puts equal keys together."""
    codes = []
    for c in columns:
        code = c.dictionary_encode().indices
        codes.append(np.where(np.asarray(code.is_null()), -1, np.asarray(code.fill_null(0))))
    return np.lexsort(codes) if codes else np.arange(n)


def _as_batch(keys, n, mean, comoment, names):
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())) for x in (mean, comoment)]
    return pa.RecordBatch.from_arrays([*keys, pa.array(n.astype(np.int64)), *lists], names=names)


def _reduced(by, k):
    """One row of moments for each group of an Arrow batch, all groups at once."""
    i, j = np.triu_indices(k)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.take(pa.array(_order([batch.column(b) for b in by], batch.num_rows)))
            keys = [batch.column(b) for b in by]
            first = _runs(keys, batch.num_rows)
            n = np.diff(np.append(first, batch.num_rows))
            x = np.column_stack([np.asarray(batch.column(f"_m{c}").to_numpy(zero_copy_only=False), float) for c in range(k)])
            mean = np.add.reduceat(x, first) / n[:, None]
            d = x - np.repeat(mean, n, axis=0)
            co = np.column_stack([np.add.reduceat(d[:, a] * d[:, b], first) for a, b in zip(i, j)])
            yield _as_batch([c.take(pa.array(first)) for c in keys], n, mean, co, [*by, "n", "mean", "comoment"])

    return run


def _merged(by, k):
    """Rows of moments, sorted by key, merged to one row a group; the last group of a batch stays open for the next one."""
    i, j = np.triu_indices(k)
    names = [*by, "n", "mean", "comoment"]

    def merge(batch):
        keys = [batch.column(b) for b in by]
        first = _runs(keys, batch.num_rows)
        size = np.diff(np.append(first, batch.num_rows))
        n = batch.column("n").to_numpy().astype(float)
        mean = np.asarray(batch.column("mean").flatten()).reshape(-1, k)
        co = np.asarray(batch.column("comoment").flatten()).reshape(-1, len(i))
        total = np.add.reduceat(n, first)
        # centred at the first mean of the group, so that no digits are lost
        base = np.repeat(mean[first], size, axis=0)
        center = mean[first] + np.add.reduceat((mean - base) * n[:, None], first) / total[:, None]
        d = mean - np.repeat(center, size, axis=0)
        return _as_batch([c.take(pa.array(first)) for c in keys], total, center, np.add.reduceat(co + n[:, None] * d[:, i] * d[:, j], first), names)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(names)
            if held is not None:
                both = pa.concat_tables([pa.Table.from_batches([held]), pa.Table.from_batches([batch]).cast(held.schema)])
                batch = both.combine_chunks().to_batches()[0]
            out = merge(batch)
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
            held = out.slice(out.num_rows - 1)
        if held is not None:
            yield held

    return run


def _block_moments(picked, by, k):
    """Moments of many columns: k^2 / 2 aggregate buffers exceed the field limit
    of whole-stage code generation, so each task reduces its Arrow batches to
    centred moments of all their groups and only moment rows are shuffled.

    The rows of one group are merged in two steps, the first one in up to
    ``MERGE_SLOTS`` tasks.  Keys stay Arrow columns, so they stay exact.
    """
    types = {f.name: f.dataType.simpleString() for f in picked.schema.fields}
    schema = "".join(f"`{b}` {types[b]}, " for b in by) + MOMENT_FIELDS
    keys = [F.col(f"`{b}`") for b in by]
    partial = picked.mapInArrow(_reduced(by, k), schema).withColumn("_slot", F.pmod(F.spark_partition_id(), F.lit(MERGE_SLOTS)))
    in_order = lambda rows: rows.sortWithinPartitions(*keys) if keys else rows
    once = in_order(partial.repartition(*keys, "_slot")).drop("_slot").mapInArrow(_merged(by, k), schema)
    last = in_order(once.repartition(*keys)) if keys else once.coalesce(1)
    return last.mapInArrow(_merged(by, k), schema)


def weighted(cols, weight):
    """Columns scaled by sqrt(weight) plus sqrt(weight) itself; negatives fail."""
    w = as_double(weight)
    root = F.when(w < 0, F.raise_error(F.lit("Weights must be non-negative")).cast("double")).otherwise(F.sqrt(w))
    return [as_double(c) * root for c in cols] + [root]


class Moments:
    """Moments of one group with the algebra the finalizers need."""

    def __init__(self, n, mean, comoment):
        self.n = int(n)
        self.mean = np.asarray(mean, dtype=float)
        k = len(self.mean)
        c = np.asarray(comoment, dtype=float)
        if c.ndim == 1:
            full = np.zeros((k, k))
            full[np.triu_indices(k)] = c
            c = full + np.triu(full, 1).T
        self.comoment = c

    @classmethod
    def of(cls, row):
        return cls(row["n"], row["mean"], row["comoment"])

    def merge(self, other):
        if self.n == 0:
            return other
        if other.n == 0:
            return self
        n = self.n + other.n
        d = other.mean - self.mean
        return Moments(
            n,
            self.mean + d * (other.n / n),
            self.comoment + other.comoment + np.outer(d, d) * (self.n * (other.n / n)),
        )

    def cov(self):
        if self.n < 2:
            return np.full_like(self.comoment, np.inf)
        return self.comoment / (self.n - 1)

    def raw(self):
        """Sum of outer products."""
        return self.comoment + self.n * np.outer(self.mean, self.mean)

    def transform(self, a, shift):
        """Moments of ``a @ x + shift``."""
        return Moments(self.n, a @ self.mean + shift, a @ self.comoment @ a.T)

    def take(self, index):
        index = list(index)
        return Moments(self.n, self.mean[index], self.comoment[np.ix_(index, index)])


def merge_all(parts):
    total = parts[0]
    for p in parts[1:]:
        total = total.merge(p)
    return total


def collect_moments(df, cols, by=()):
    """Driver-side moments of a handful of groups: {key tuple: Moments}."""
    rows = moments(df, cols, by=by, required=by).collect()
    return {tuple(r[b] for b in by): Moments.of(r) for r in rows if r["n"]}


def select_by(df, by):
    """Add named group expressions: by = ["g"] or {"name": expr}."""
    if isinstance(by, dict):
        for name, expr in by.items():
            df = df.withColumn(name, as_column(expr))
        return df, list(by)
    return df, list(by)


def invert(matrix, what="design"):
    """Inverse that refuses numerically singular input."""
    m = np.asarray(matrix, dtype=float)
    if m.size == 0:
        return m.copy()
    scale = np.sqrt(np.abs(np.diag(m)))
    if not np.all(np.isfinite(m)) or np.any(scale == 0):
        raise ValueError(f"{what} matrix is singular: some variables are perfectly collinear")
    unit = m / np.outer(scale, scale)
    if np.linalg.cond(unit) > 1e13:
        raise ValueError(f"{what} matrix is singular: some variables are perfectly collinear")
    return np.linalg.inv(unit) / np.outer(scale, scale)
