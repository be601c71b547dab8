"""X'X, or its inverse, as one row per matrix row."""

import numpy as np
from pyspark.sql import functions as F

from estimand.functions.columns import as_double
from estimand.plans.finalize import by_schema, finalize
from estimand.plans.moments import NATIVE_PRODUCTS, invert, moments, select_by


def matrix_multiplication(df, cols, inverse=False, weighted=False, by=()):
    """``row_index``, ``values`` of X'X over ``cols``.

    With ``weighted`` the last column is a weight multiplied into every other
    column (so products carry its square).
    """
    df, by = select_by(df, by)
    xs = [as_double(c) for c in cols]
    if weighted:
        xs = [x * xs[-1] for x in xs[:-1]]
    k = len(xs)
    if not k:
        raise ValueError("needs at least one column")
    if k <= NATIVE_PRODUCTS:
        names = [f"_x{i}" for i in range(k)]
        picked = df.select(*by, *[x.alias(n) for x, n in zip(xs, names)]).dropna(subset=names)
        products = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")) for i in range(k) for j in range(i, k)]
        agg = picked.groupBy(*by).agg(F.array(*products).alias("products"))
    else:
        n, mean = F.col("n"), F.col("mean")
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        agg = moments(df, xs, by).select(*by, F.array(*[
            F.col("comoment")[p] + n * mean[i] * mean[j] for p, (i, j) in enumerate(pairs)]).alias("products"))

    def fn(row):
        upper = row["products"]
        if upper is None or any(v is None for v in upper):
            return
        m = np.zeros((k, k))
        m[np.triu_indices(k)] = upper
        m = m + np.triu(m, 1).T
        if inverse:
            try:
                m = invert(m, "product")
            except ValueError:
                if not by:
                    raise
                m = [None] * k
        for i in range(k):
            yield {**row, "row_index": i + 1, "values": None if m[i] is None else [float(v) for v in m[i]]}

    return finalize(agg, fn, by_schema(df, by) + "row_index int, values array<double>")
