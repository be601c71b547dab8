"""Bootstrap with an exact total sample size, as mergeable moments.

Equal argument rows are collapsed to (row, copies) first: a resample only
depends on how often each distinct row is drawn, so this is exact, removes any
hot value and needs no row key.  Draws are nested multinomials: super-bucket on
the driver (at most 1024 counts), bucket in one task per super-bucket, row
inside the bucket.  Seeds derive from (seed, replicate, bucket) and rows are
sorted inside a bucket, so a retried task repeats its draws.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from estimand.functions.columns import as_column, as_double, stable_bucket
from estimand.functions.formula import read_metric
from estimand.operators.regress import LinearModel, ols_from_moments, read_model, solve
from estimand.operators.ttest import TTEST_SCHEMA, MetricStats, t_tail, ttest_2samp_from_moments
from estimand.plans.finalize import finalize
from estimand.plans.moments import Moments
from estimand.plans.segments import segmented_prefix

ROWS_PER_BUCKET = 250_000
SUPER = 1024
MIN_BUCKETS = 64  # fixed, so that results do not depend on the cluster


def row_census(df, key, buckets, bucket=None):
    """Rows per stable bucket (hash of ``key``, or an own ``bucket`` expression)."""
    where = as_column(bucket).cast("int") if bucket is not None else stable_bucket(key, buckets)
    return df.groupBy(where.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def _sample_size(sample, total):
    if isinstance(sample, float):
        if not 0.0 <= sample <= 1.0:
            raise ValueError("the ratio must be in [0, 1]")
        return int(sample * total)
    if sample < 0:
        raise ValueError("sample_num must not be negative")
    return int(sample)


def _row_drawer(copies):
    """Function (rng, count) -> how often each distinct row is drawn."""
    total = int(copies.sum())
    # one entry per original row; only worth holding while copies are few
    slots = np.repeat(np.arange(len(copies)), copies) if total <= 4 * len(copies) + 1_000_000 else None

    def draw(rng, count):
        if slots is None or count > 20 * len(copies):
            return rng.multinomial(count, copies / total).astype(float)
        picks = rng.integers(0, total, size=count, dtype=np.int32)
        return np.bincount(slots[picks], minlength=len(copies)).astype(float)

    return draw


def bootstrap_moments(df, cols, sample, bs_num, seed=0, index=None, where=None, rows_per_bucket=ROWS_PER_BUCKET):
    """Moments per replicate: (replicate[, _index], n, mean, comoment).

    ``sample`` is a row count or a ratio (float).  ``index`` keeps groups apart
    and ``where`` restricts the statistic; both apply after resampling.
    """
    if bs_num < 1:
        raise ValueError("bs_num must be at least 1")
    k = len(cols)
    names = [f"_x{i}" for i in range(k)]
    group = as_column(index).cast("bigint") if index is not None else F.lit(0).cast("bigint")
    flag = as_column(where).cast("boolean") if where is not None else F.lit(True)
    rows = df.select(
        *[as_double(c).alias(n) for c, n in zip(cols, names)],
        group.alias("_index"), F.coalesce(flag, F.lit(False)).alias("_flag"),
    ).dropna()
    center_row = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(n).alias(n) for n in names]).first()
    total = center_row["n"]
    if not total:
        raise ValueError("nothing to resample")
    center = np.array([center_row[n] for n in names])
    size = _sample_size(sample, total)
    buckets = max(MIN_BUCKETS, -(-total // rows_per_bucket))

    hashed = rows.withColumn("_bucket", stable_bucket([*names, "_index", "_flag"], buckets, seed))
    distinct = hashed.groupBy(*names, "_index", "_flag", "_bucket").agg(F.count(F.lit(1)).alias("_copies"))

    # draws per super-bucket, on the driver; with few buckets these are the buckets
    single = buckets <= SUPER
    census = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"))
    census = census.withColumn("_super", F.pmod("_bucket", F.lit(SUPER)))
    supers = {r["_super"]: r["rows"] for r in census.groupBy("_super").agg(F.sum("rows").alias("rows")).collect()}
    order = sorted(supers)
    weights = np.array([supers[s] for s in order], dtype=float)
    share = weights / weights.sum()
    drawn = np.array([np.random.default_rng([seed, r]).multinomial(size, share) for r in range(bs_num)])
    per_super = dict(zip(order, drawn.T))

    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [f"s{i}" for i in range(k)]
    products = [f"q{i}_{j}" for i, j in pairs]

    def resample(bucket, data, draws):
        data = data.sort_values([*names, "_index", "_flag"], kind="stable")
        copies = data["_copies"].to_numpy(dtype=np.int64)
        draw = _row_drawer(copies)
        x = data[names].to_numpy(dtype=float) - center
        features = np.column_stack([np.ones(len(x)), x, *[x[:, i] * x[:, j] for i, j in pairs]])
        keep = data["_flag"].to_numpy(dtype=bool)
        idx = data["_index"].to_numpy()
        masks = [(g, keep & (idx == g)) for g in np.unique(idx[keep])]
        out = [pd.DataFrame(columns=["replicate", "_index", "n", *sums, *products])] if not masks else []
        for start in range(0, bs_num, 16):
            chunk = range(start, min(start + 16, bs_num))
            w = np.vstack([
                draw(np.random.default_rng([seed, r, bucket, 2]), int(draws[r])) for r in chunk
            ])
            for g, mask in masks:
                table = w[:, mask] @ features[mask]
                frame = pd.DataFrame(table, columns=["n", *sums, *products])
                frame.insert(0, "_index", int(g))
                frame.insert(0, "replicate", list(chunk))
                out.append(frame)
        return pd.concat(out)

    schema = "replicate int, _index bigint, n double, " + ", ".join(f"{c} double" for c in [*sums, *products])
    if single:
        parts = distinct.groupBy("_bucket").applyInPandas(
            lambda key, data: resample(int(key[0]), data, per_super[int(key[0])]), schema)
    else:
        def allocate(key, pdf):
            pdf = pdf.sort_values("_bucket")
            inner = pdf["rows"].to_numpy(dtype=float)
            draws = np.array([
                np.random.default_rng([seed, r, int(key[0]), 1]).multinomial(c, inner / inner.sum())
                for r, c in enumerate(per_super[int(key[0])])
            ])
            return pd.DataFrame({"_bucket": pdf["_bucket"].to_numpy(), "draws": list(draws.T.astype("int64"))})

        plan = census.groupBy("_super").applyInPandas(allocate, "_bucket int, draws array<bigint>")
        parts = distinct.groupBy("_bucket").cogroup(plan.groupBy("_bucket")).applyInPandas(
            lambda key, data, alloc: resample(int(key[0]), data, alloc["draws"].iloc[0]), schema)
    by = ["replicate"] + (["_index"] if index is not None else [])
    merged = parts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ["n", *sums, *products]]).where("n > 0")
    mean = [F.lit(float(c)) + F.col(s) / F.col("n") for c, s in zip(center, sums)]
    co = [F.col(q) - F.col(sums[i]) * F.col(sums[j]) / F.col("n") for q, (i, j) in zip(products, pairs)]
    return merged.select(*by, F.col("n").cast("bigint").alias("n"), F.array(*mean).alias("mean"),
                         F.array(*co).alias("comoment"))


def bootstrap(df, statistic, sample, bs_num, args=None, seed=0, where=None, is_std=True):
    """(replicate, n, result) of an inner aggregate.

    ``statistic`` is ``count``, ``sum`` or ``avg`` over ``args[0]``, or
    ``deltamethod`` with ``args`` = [metric formula], or one of
    ``bootstrap_values`` (``quantile`` with ``args`` = [column, p]).
    """
    if statistic in (*ORDERED, "distinct"):
        return bootstrap_values(df, statistic, args[0], sample, bs_num, *args[1:], seed=seed, where=where)
    if statistic == "deltamethod":
        cols, metrics = read_metric(args[0], args[1:] or None)
    elif statistic in ("count", "sum", "avg"):
        cols, metrics = list(args), None
    else:
        raise ValueError(f"unknown inner statistic {statistic!r}")
    m = bootstrap_moments(df, cols, sample, bs_num, seed, where=where)
    if metrics is None:
        mean, n = F.element_at("mean", 1), F.col("n").cast("double")
        return m.select("replicate", "n", {"count": n, "avg": mean, "sum": mean * n}[statistic].alias("result"))

    def fn(row):
        var = float(MetricStats.of(Moments.of(row), metrics).cov[0, 0])
        yield {**row, "result": float(np.sqrt(var)) if is_std else var}

    return finalize(m, fn, "replicate int, n bigint, result double")


def bootstrap_ols(df, formula, sample, bs_num, bias=True, seed=0, where=None):
    """OLS coefficient rows per replicate."""
    y, xs = read_model(formula)
    m = bootstrap_moments(df, [y, *xs], sample, bs_num, seed, where=where)
    return ols_from_moments(m, m, ["replicate"], xs, bias)


def bootstrap_predict(df, formula, sample, bs_num, replicate, bias=True, seed=0, train=None, xs=None):
    """Predict every row of ``df`` with the coefficients of one replicate."""
    y, terms = read_model(formula)
    if not 0 <= replicate < bs_num:
        raise ValueError("replicate is out of range")
    source = df if train is None else train
    m = bootstrap_moments(source, [y, *terms], sample, bs_num, seed).where(F.col("replicate") == replicate)
    fit = solve(Moments.of(m.first()), terms, bias)
    return LinearModel(fit, terms).predict(df, xs)


def bootstrap_ttest_table(df, g, sample, bs_num, index=None, alternative="two-sided", mu=0.0, alpha=0.05,
                          cuped=None, args=None, seed=0):
    """(replicate, estimate, stderr, t_statistic, p_value, lower, upper) in one job."""
    cols, metrics = read_metric(g, args, cuped)
    m = bootstrap_moments(df, cols, sample, bs_num, seed, index=index)
    if index is not None:
        return ttest_2samp_from_moments(m, m.where("_index in (0, 1)"), ["replicate"], metrics, alternative, alpha)

    def fn(row):
        moments = Moments.of(row)
        s = MetricStats.of(moments, metrics)
        theta = s.theta() if len(metrics) > 1 else np.zeros(0)
        stderr = float(np.sqrt(s.adjusted_var(theta)))
        yield {**row, **t_tail(float(s.values[0]) - mu, stderr, moments.n, alternative, alpha)}

    return finalize(m, fn, "replicate int, " + TTEST_SCHEMA)


# ---- statistics of order and of distinct values --------------------------------

ORDERED = ("min", "max", "quantile")


def _targets(statistic, p, drawn):
    """[(place, share)] of the order statistics that make the result of a resample of ``drawn`` rows."""
    if statistic == "min":
        return [(0, 1.0)]
    if statistic == "max":
        return [(drawn - 1, 1.0)]
    at = (drawn - 1) * p
    low = int(np.floor(at))
    return [(low, 1.0)] if at == low else [(low, 1.0 - (at - low)), (low + 1, at - low)]


def bootstrap_values(df, statistic, column, sample, bs_num, p=0.5, seed=0, where=None, rows_per_block=ROWS_PER_BUCKET):
    """(replicate, n, result) of ``min``, ``max``, ``quantile`` (at ``p``, interpolated) or ``distinct`` of ``column`` in resamples of exact size.

    The input is read once, into counts per value in their order.  Blocks of
    values draw nested multinomials (super-block on the driver, block, value).
    A replicate's order statistics lie in one or two blocks, and only those draw
    its values; distinct values are counted in every block and added.  Blocks
    follow from the data alone, so neither the cluster nor a retry changes a draw.

    ``where`` restricts the statistic after resampling; n counts the rows that
    are left.  A replicate without such rows has no row.
    """
    if statistic not in (*ORDERED, "distinct"):
        raise ValueError(f"unknown statistic {statistic!r}")
    if bs_num < 1 or not 0.0 <= p <= 1.0:
        raise ValueError("bs_num must be at least 1 and p in [0, 1]")
    value = as_column(column) if statistic == "distinct" else as_double(column)
    flag = as_column(where).cast("boolean") if where is not None else F.lit(True)
    rows = df.select(value.alias("_v"), F.coalesce(flag, F.lit(False)).alias("_flag")).where("_v is not null")
    counts = rows.groupBy("_v").agg(F.count_if("_flag").alias("_n"), F.count_if(~F.col("_flag")).alias("_out"))
    placed = segmented_prefix(counts, [], ["_v"], ["_n"], keep=["_out"])
    whole = placed.agg(F.sum("_n").alias("n"), F.sum("_out").alias("out")).first()
    inside, outside = int(whole["n"] or 0), int(whole["out"] or 0)
    if not inside + outside:
        raise ValueError("nothing to resample")
    size = _sample_size(sample, inside + outside)
    per_super = -(-max(1, -(-inside // rows_per_block)) // SUPER)
    block = F.floor(F.col("_n_before") / rows_per_block)
    placed = placed.where("_n > 0").select("_v", "_n", block.alias("_block"), F.floor(block / per_super).alias("_super"))
    blocks = placed.groupBy("_super", "_block").agg(F.sum("_n").alias("rows"))
    supers = sorted((r["_super"], r["rows"]) for r in blocks.groupBy("_super").agg(F.sum("rows").alias("rows")).collect())
    weights = np.array([outside, *(w for _, w in supers)], float)
    drawn = np.array([np.random.default_rng([seed, r]).multinomial(size, weights / weights.sum())[1:] for r in range(bs_num)])
    totals = {r: int(n) for r, n in enumerate(drawn.sum(axis=1)) if n}
    ordered = statistic in ORDERED
    wanted = {}  # by super-block: (replicate, rows drawn there, place in it, share of the result)
    for r, n in totals.items():
        upto = np.cumsum(drawn[r])
        for place, share in _targets(statistic, p, n) if ordered else [(None, 1.0)]:
            at = [int(np.searchsorted(upto, place, "right"))] if ordered else np.flatnonzero(drawn[r]).tolist()
            for s in at:
                wanted.setdefault(supers[s][0], []).append((r, int(drawn[r][s]), place - int(upto[s] - drawn[r][s]) if ordered else 0, share))
    plan_schema = "_block bigint, replicate int, draws bigint, place bigint, share double"

    def allocate(key, pdf):
        pdf = pdf.sort_values("_block")
        inner = pdf["rows"].to_numpy(float)
        numbers, out = pdf["_block"].tolist(), []
        for r, n, place, share in wanted.get(int(key[0]), []):
            own = np.random.default_rng([seed, r, int(key[0]), 1]).multinomial(n, inner / inner.sum())
            upto = np.cumsum(own)
            for b in [int(np.searchsorted(upto, place, "right"))] if ordered else np.flatnonzero(own).tolist():
                out.append((numbers[b], r, int(own[b]), place - int(upto[b] - own[b]) if ordered else 0, share))
        return pd.DataFrame(out, columns=["_block", "replicate", "draws", "place", "share"])

    def draw(key, data, plan):
        data = data.sort_values("_v", kind="stable")
        copies, values = data["_n"].to_numpy(np.int64), data["_v"].to_numpy()
        out = []
        for r, n, place, share in zip(*(plan[c].tolist() for c in ("replicate", "draws", "place", "share"))):
            own = np.random.default_rng([seed, r, int(key[0]), 2]).multinomial(n, copies / copies.sum())
            out.append((r, share * float(values[np.searchsorted(np.cumsum(own), place, "right")]) if ordered else float((own > 0).sum())))
        return pd.DataFrame(out, columns=["replicate", "part"])

    plan = blocks.groupBy("_super").applyInPandas(allocate, plan_schema)
    parts = placed.groupBy("_block").cogroup(plan.groupBy("_block")).applyInPandas(draw, "replicate int, part double")
    sizes = F.create_map(*[x for r, n in totals.items() for x in (F.lit(r), F.lit(n).cast("bigint"))]) if totals else F.lit(None).cast("map<int,bigint>")
    return parts.groupBy("replicate").agg(F.sum("part").alias("result")).select("replicate", F.element_at(sizes, F.col("replicate")).alias("n"), "result")
