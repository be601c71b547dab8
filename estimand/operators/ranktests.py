"""Rank statistics and exact quantiles on value counts."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from estimand.functions import dist
from estimand.functions.columns import as_column, as_double
from estimand.operators.ttest import check_alternative
from estimand.plans.finalize import finalize
from estimand.plans.prefix import partial_frame, prefix_sum, sorted_partials
from estimand.plans.segments import Groups, _starts, segmented_prefix, with_totals


def _rank_partials(batches):
    """Rank sum of the first sample inside one sorted partition of counts."""
    first, c1, c, s1, ties = None, 0.0, 0.0, 0.0, 0.0
    for pdf in batches:
        if not len(pdf):
            continue
        first = float(pdf["v"].iloc[0]) if first is None else first
        k1, k = pdf["c1"].to_numpy(float), pdf["c"].to_numpy(float)
        before = c + np.cumsum(k) - k
        s1 += float((k1 * (before + (k + 1) / 2)).sum())
        ties += float((k**3 - k).sum())
        c1, c = c1 + float(k1.sum()), c + float(k.sum())
    if first is not None:
        yield partial_frame(first=first, c1=c1, c=c, s1=s1, ties=ties)


def mann_whitney(df, value, is_second, alternative="two-sided", continuity=True):
    """U of both samples and the tie-corrected normal p-value."""
    check_alternative(alternative)
    second = as_column(is_second).cast("bigint") != 0
    counts = df.select(as_double(value).alias("v"), second.alias("s")).dropna().groupBy("v").agg(
        F.count_if(~F.col("s")).alias("c1"), F.count(F.lit(1)).alias("c"))
    parts = sorted_partials(counts, ["v"], _rank_partials,
                            "first double, c1 double, c double, s1 double, ties double")
    packed = parts.agg(F.sort_array(F.collect_list(F.struct("first", "c1", "c", "s1", "ties"))).alias("parts"))

    def fn(row):
        n = n1 = ranks = ties = 0.0
        for p in row["parts"]:
            ranks += p["s1"] + n * p["c1"]
            n1, n, ties = n1 + p["c1"], n + p["c"], ties + p["ties"]
        n2 = n - n1
        if not n1 or not n2:
            raise ValueError("both samples must be non-empty")
        u1 = ranks - n1 * (n1 + 1) / 2
        u2 = n1 * n2 - u1
        sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
        u = {"two-sided": max(u1, u2), "greater": u1, "less": u2}[alternative]
        z = (u - n1 * n2 / 2 - (0.5 if continuity else 0.0)) / sd if sd > 0 else math.nan
        p = dist.norm_sf(z) * (2 if alternative == "two-sided" else 1)
        yield {"u1": u1, "u2": u2, "p_value": min(1.0, p)}

    return finalize(packed, fn, "u1 double, u2 double, p_value double")


def value_ranks(counts, value, cnt):
    """Average rank of each distinct value from a (value, count) table."""
    ranked = prefix_sum(counts, [value], [cnt])
    return ranked.withColumn("avg_rank", F.col(f"{cnt}_before") + (F.col(cnt) + 1) / 2).drop(f"{cnt}_before")


def rank_corr(df, x, y):
    """Spearman's rank correlation with average ranks for ties.

    Rows collapse to (x, y) counts, ranks are looked up per distinct value.
    """
    cells = df.select(as_double(x).alias("x"), as_double(y).alias("y")).dropna().groupBy("x", "y").agg(
        F.count(F.lit(1)).alias("n"))
    rx = value_ranks(cells.groupBy("x").agg(F.sum("n").alias("cx")), "x", "cx").select("x", F.col("avg_rank").alias("rx"))
    ry = value_ranks(cells.groupBy("y").agg(F.sum("n").alias("cy")), "y", "cy").select("y", F.col("avg_rank").alias("ry"))
    total = cells.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        raise ValueError("no complete rows")
    mid = (total + 1) / 2
    a, b, n = F.col("rx") - F.lit(mid), F.col("ry") - F.lit(mid), F.col("n")
    return cells.join(rx, "x").join(ry, "y").agg(
        F.try_divide(F.sum(n * a * b), F.sqrt(F.sum(n * a * a)) * F.sqrt(F.sum(n * b * b))).alias("rank_corr")
    )


def exact_quantiles(df, c, probs):
    """(p, value) with linear interpolation between order statistics.

    Counts per value are prefix-summed in range partitions, and only the (at
    most two) values around each requested position are kept.
    """
    counts = df.select(as_double(c).alias("v")).dropna().groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = prefix_sum(counts, ["v"], ["n"])
    total = df.select(as_double(c).alias("v")).dropna().count()
    if not total:
        raise ValueError("no complete rows")
    points = [(float(p), math.floor((total - 1) * p), math.ceil((total - 1) * p)) for p in probs]
    holds = F.array(*[
        F.struct(F.lit(p).alias("p"), F.lit((total - 1) * p - lo).alias("w"),
                 ((F.col("n_before") <= lo) & (F.col("n_before") + F.col("n") > lo)).alias("is_lo"),
                 ((F.col("n_before") <= hi) & (F.col("n_before") + F.col("n") > hi)).alias("is_hi"))
        for p, lo, hi in points
    ])
    hits = placed.select("v", F.inline(F.filter(holds, lambda h: h["is_lo"] | h["is_hi"])))
    return hits.groupBy("p", "w").agg(
        F.max(F.when(F.col("is_lo"), F.col("v"))).alias("lo"), F.max(F.when(F.col("is_hi"), F.col("v"))).alias("hi")
    ).select("p", (F.col("lo") + F.col("w") * (F.col("hi") - F.col("lo"))).alias("value"))


#: Accuracy of the sketches that bracket a quantile, and values of a bracket that are counted one by one.
SKETCH, BRACKET_ROWS = 10_000, 50_000


def discrete_quantiles(df, columns, probs):
    """{column: values}: the least value with a share p of the non-null values at or below it; no values where all are null.

    A bounded sketch of every column brackets each quantile, and counts of the
    rows below and inside the bracket make it exact.  A bracket that still holds
    many values is narrowed by a sketch of its own rows, a few thousand times a
    scan, so no order of all values is ever made.  One row a scan and the value
    counts of small brackets reach the driver.  NaN is larger than any number.
    """
    spans = {(i, k): (None, None, p) for i in range(len(columns)) for k, p in enumerate(probs)}  # bracket and the share looked for in it
    values, found = [as_double(c) for c in columns], {}
    sizes = None
    while spans:
        keys = list(spans)

        def inside(key):
            lo, hi, _ = spans[key]
            v = values[key[0]]
            return v if lo is None else F.when((v > F.lit(lo)) & (v < F.lit(hi)), v)

        margin = 2.0 / SKETCH
        asked = []
        for j, key in enumerate(keys):
            p = spans[key][2]
            asked.append(F.percentile_approx(inside(key), [max(0.0, p - margin), min(1.0, p + margin)], SKETCH).alias(f"q{j}"))
        row = df.agg(*[F.count(v).alias(f"n{i}") for i, v in enumerate(values)], *asked).first()
        sizes = sizes or [row[f"n{i}"] for i in range(len(columns))]
        brackets = {key: row[f"q{j}"] for j, key in enumerate(keys) if row[f"q{j}"]}
        counted = [x for j, (key, (lo, hi)) in enumerate(brackets.items()) for v in [values[key[0]]] for x in (
            F.count_if(v < F.lit(lo)).alias(f"b{j}"), F.count_if(v == F.lit(lo)).alias(f"l{j}"), F.count_if(v == F.lit(hi)).alias(f"h{j}"),
            F.count_if((v > F.lit(lo)) & (v < F.lit(hi))).alias(f"m{j}"))]
        if not counted:
            break
        counts, spans, small = df.agg(*counted).first(), {}, {}
        for j, (key, (lo, hi)) in enumerate(brackets.items()):
            # the ends are counted by themselves, so that a frequent value never keeps a bracket from shrinking
            place, below, low, many = max(1, math.ceil(sizes[key[0]] * probs[key[1]])), counts[f"b{j}"], counts[f"l{j}"], counts[f"m{j}"]
            place -= below + low
            if not -low < place <= many + (counts[f"h{j}"] if hi > lo else 0):
                raise ArithmeticError("a quantile sketch missed its bracket")
            if place <= 0:
                found[key] = lo
            elif place > many:
                found[key] = hi
            elif many <= BRACKET_ROWS:
                small[key] = (lo, hi, place)
            else:
                spans[key] = (lo, hi, place / many)
        if small:
            held = F.array(*[F.when((values[i] > F.lit(lo)) & (values[i] < F.lit(hi)), F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), values[i].alias("v"))) for (i, k), (lo, hi, _) in small.items()])
            rows = df.select(F.inline(F.filter(held, lambda x: x.isNotNull()))).groupBy("i", "k", "v").agg(F.count(F.lit(1)).alias("n")).collect()
            for key, (_, _, place) in small.items():
                upto = 0
                for r in sorted((r for r in rows if (r["i"], r["k"]) == key), key=lambda r: r["v"]):
                    upto += r["n"]
                    if upto >= place:
                        found[key] = r["v"]
                        break
    return {c: [found[i, k] for k in range(len(probs)) if (i, k) in found] for i, c in enumerate(columns)}


def mann_whitney_grouped(df, value, is_second, by, alternative="two-sided", continuity=True):
    """(by.., u1, u2, p_value): ``mann_whitney`` in every group of ``by``, all in one order of (group, value); nulls where a sample is empty."""
    check_alternative(alternative)
    groups = Groups(by)
    second = as_column(is_second).cast("bigint") != 0
    rows = df.select(*groups.columns(), as_double(value).alias("_v"), second.alias("_s")).dropna(subset=["_v", "_s"])
    counts = rows.groupBy(*groups.names, "_v").agg(F.count_if(~F.col("_s")).alias("_c1"), F.count(F.lit(1)).alias("_c"))
    placed = segmented_prefix(counts, groups.names, ["_v"], ["_c"], keep=["_c1"])
    c = F.col("_c").cast("double")
    sums = placed.groupBy(*groups.names).agg(
        F.sum("_c1").cast("double").alias("n1"), F.sum(c).alias("n"), F.sum(F.col("_c1") * (F.col("_c_before") + (c + 1) / 2)).alias("ranks"), F.sum(c * c * c - c).alias("ties"))

    def fn(row):
        own = {k: row[k] for k in groups.names}
        n1, n = row["n1"], row["n"]
        n2 = n - n1
        if n1 and n2:
            own["u1"] = u1 = row["ranks"] - n1 * (n1 + 1) / 2
            own["u2"] = u2 = n1 * n2 - u1
            sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - row["ties"] / (n * (n - 1))))
            u = {"two-sided": max(u1, u2), "greater": u1, "less": u2}[alternative]
            z = (u - n1 * n2 / 2 - (0.5 if continuity else 0.0)) / sd if sd > 0 else math.nan
            own["p_value"] = min(1.0, dist.norm_sf(z) * (2 if alternative == "two-sided" else 1))
        yield own

    found = finalize(sums, fn, groups.schema(sums) + "u1 double, u2 double, p_value double")
    return found.select(*groups.restored(), "u1", "u2", "p_value")


def quantiles_grouped(df, c, probs, by, weight=None):
    """(by.., p, value): exact quantiles of every group, all in one order of (group, value).

    Without ``weight`` values are interpolated between order statistics, as in
    ``exact_quantiles``.  With it the value is the least one with a share p of
    the group's weight at or below it; rows whose weight is null or not
    positive do not count.
    """
    groups = Groups(by)
    own = F.lit(1.0) if weight is None else as_double(weight)
    rows = df.select(*groups.columns(), as_double(c).alias("_v"), own.alias("_w")).dropna(subset=["_v", "_w"]).where("_w > 0")
    counts = rows.groupBy(*groups.names, "_v").agg(F.sum("_w").alias("_n"))
    placed = with_totals(segmented_prefix(counts, groups.names, ["_v"], ["_n"]), groups.names, total=F.sum("_n"), least=F.min("_v"))
    n, before, total = F.col("_n"), F.col("_n_before"), F.col("total")
    keys = [*groups.names, "p"]
    points = F.array(*[F.lit(float(p)) for p in probs])
    if weight is not None:
        # sums of weights may differ from the total in their last digits: a share of all is the largest value
        reached = placed.select(*groups.names, "_v", F.explode(F.filter(points, lambda p: (before + n >= p * total * (1 - 1e-12)))).alias("p"))
        return reached.groupBy(*keys).agg(F.min("_v").alias("value")).select(*groups.restored(), "p", "value")
    holds = F.transform(points, lambda p: F.struct(
        p.alias("p"), ((total - 1) * p - F.floor((total - 1) * p)).alias("w"),
        ((before <= F.floor((total - 1) * p)) & (before + n > F.floor((total - 1) * p))).alias("lo"),
        ((before <= F.ceil((total - 1) * p)) & (before + n > F.ceil((total - 1) * p))).alias("hi")))
    hits = placed.select(*groups.names, "_v", F.inline(F.filter(holds, lambda h: h["lo"] | h["hi"])))
    ends = hits.groupBy(*keys).agg(F.max("w").alias("w"), F.max(F.when(F.col("lo"), F.col("_v"))).alias("a"), F.max(F.when(F.col("hi"), F.col("_v"))).alias("b"))
    return ends.select(*groups.restored(), "p", (F.col("a") + F.col("w") * (F.col("b") - F.col("a"))).alias("value"))


# ---- bounded sketches ------------------------------------------------------------

#: Halvings that any table is allowed (2^40 buffers of rows).
HALVINGS = 40
#: Tasks that merge the sketches of a group first.
SKETCH_SLOTS = 64


class Sketch:
    """Mergeable summary of numbers: buffers of at most ``size`` sorted values, those of level h standing for 2^h rows each.

    Two full buffers of a level become one of the next by keeping every other
    value, from the first and from the second one in turn.  That moves no rank by
    more than 2^h, so after all halvings ranks are off by at most
    n * HALVINGS / (2 * size), whatever the order of rows and merges.
    """

    def __init__(self, size):
        self.size, self.levels = size, {}

    def add(self, values, level=0):
        held, turn = self.levels.get(level, (np.zeros(0), 0))
        held = np.concatenate([held, values])
        if len(held) >= 2 * self.size:
            held = np.sort(held)
            even = len(held) // 2 * 2
            self.levels[level] = (held[even:], 1 - turn)
            self.add(held[turn:even:2], level + 1)
        else:
            self.levels[level] = (held, turn)

    def take(self, level, values):
        self.add(values, level)

    def rows(self):
        return [(h, v.tolist()) for h, (v, _) in sorted(self.levels.items()) if len(v)]

    def quantiles(self, probs):
        """The least value with a share p of the weight at or below it."""
        values = np.concatenate([v for v, _ in self.levels.values()])
        weights = np.concatenate([np.full(len(v), float(1 << h)) for h, (v, _) in self.levels.items()])
        order = np.argsort(values, kind="stable")
        upto = np.cumsum(weights[order])
        return [float(values[order][min(len(order) - 1, int(np.searchsorted(upto, p * upto[-1] * (1 - 1e-12))))]) for p in probs]


def _sketched(df, c, groups, make, fields):
    """One row for each group of ``groups``: its keys and ``parts``, the rows of its merged sketch.

    ``make()`` is an empty sketch with ``add(values)``, ``take(*row)`` and
    ``rows()``; ``fields`` is the DDL of its rows.  Tasks reduce their values to
    sketches, which alone are shuffled and merged in two steps.
    """
    names = groups.names
    rows = df.select(*groups.columns(), as_double(c).alias("_v")).where("_v is not null")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", " + fields
    own = [f.split()[0] for f in fields.split(", ")]
    types = [f.type for f in to_arrow_schema(StructType.fromDDL(fields))]

    def batch_of(keys, sketch):
        found = sketch.rows()
        cells = [pa.array([k.as_py()] * len(found), k.type) for k in keys]
        return pa.RecordBatch.from_arrays([*cells, *(pa.array([r[i] for r in found], t) for i, t in enumerate(types))], names=[*names, *own])

    def folded(add):
        """One sketch for each run of equal keys; only the open run's is held."""

        def run(batches):
            held, sketch = None, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [batch.column(n) for n in names]
                starts = np.flatnonzero(_starts(columns, held))
                edges = [0, *starts[starts > 0].tolist(), batch.num_rows]
                fresh = set(starts.tolist())
                for a, b in zip(edges, edges[1:]):
                    if a in fresh:
                        if sketch is not None:
                            yield batch_of(held, sketch)
                        sketch = make()
                    held = [x[a] for x in columns]
                    add(sketch, batch.slice(a, b - a))
            if sketch is not None:
                yield batch_of(held, sketch)

        return run

    def add_values(sketch, part):
        sketch.add(part.column("_v").to_numpy())

    def add_rows(sketch, part):
        for row in zip(*(part.column(f) for f in own)):
            sketch.take(*(np.asarray(x.values) if hasattr(x, "values") else x.as_py() for x in row))

    keys = [F.col(n) for n in names]
    parts = (rows.sortWithinPartitions(*keys) if groups.by else rows).mapInArrow(folded(add_values), schema)
    slot = F.pmod(F.spark_partition_id(), F.lit(SKETCH_SLOTS)).alias("_slot")
    some = parts.select("*", slot).repartition(*keys, "_slot").sortWithinPartitions(*keys, "_slot").drop("_slot").mapInArrow(folded(add_rows), schema)
    whole = some.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(folded(add_rows), schema)
    return whole.groupBy(*names).agg(F.collect_list(F.struct(*own)).alias("parts"))  # the rows of one sketch


def quantile_sketch(df, c, probs, by=(), error=0.01):
    """(by.., p, value): quantiles whose rank is off by at most ``error`` of the group's rows, from one scan and bounded memory.

    Keys stay exact; null values do not count.
    """
    if not 0 < error < 1:
        raise ValueError("error must be in (0, 1)")
    size = math.ceil(HALVINGS / (2 * error))
    groups = Groups(by)
    packed = _sketched(df, c, groups, lambda: Sketch(size), "level int, items array<double>")

    def fn(row):
        sketch = Sketch(size)
        sketch.levels = {p["level"]: (np.asarray(p["items"], float), 0) for p in row["parts"]}
        for p, v in zip(probs, sketch.quantiles(probs)):
            yield {**{n: row[n] for n in groups.names}, "p": float(p), "value": v}

    found = finalize(packed, fn, groups.schema(packed) + "p double, value double")
    return found.select(*groups.restored(), "p", "value")


class DyadicBins:
    """Mergeable histogram of at most ``most`` bins [i 2^e, (i + 1) 2^e), e as small as that allows.

    A coarser grid puts two neighbouring bins together, so the bins depend on the
    values alone and not on the order of rows or merges.  e is never below the
    last binary digit of the largest value.
    """

    def __init__(self, most):
        self.most, self.e, self.index, self.count = most, None, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _fit(self, e, index, count):
        if self.e is None:
            self.e = e
        top = max(self.e, e)
        index = np.concatenate([self.index >> min(62, top - self.e), index >> min(62, top - e)])
        count = np.concatenate([self.count, count])
        while True:
            index, at = np.unique(index, return_inverse=True)
            count = np.bincount(at, count).astype(np.int64)
            if len(index) <= self.most:
                break
            index, top = index >> 1, top + 1
        self.e, self.index, self.count = top, index, count

    def add(self, values):
        values = values[np.isfinite(values)]
        if len(values):
            e = int(np.frexp(np.abs(values).max())[1]) - 53
            self._fit(e, np.floor(np.ldexp(values, -e)).astype(np.int64), np.ones(len(values), np.int64))

    def take(self, e, index, count):
        self._fit(e, index, count)

    def rows(self):
        return [(self.e, self.index.tolist(), self.count.tolist())] if self.e is not None else []


def histogram(df, c, bins, by=()):
    """(by.., low, high, rows) of the non-empty bins [low, high) of an adaptive histogram: at most ``bins`` of one width, a power of two.

    The width is the least that needs no more bins, so the result follows from
    the values alone.  Null, infinite and NaN values do not count.
    """
    if bins < 2:
        raise ValueError("needs two bins at least")
    groups = Groups(by)
    packed = _sketched(df, c, groups, lambda: DyadicBins(bins), "e int, index array<bigint>, count array<bigint>")

    def fn(row):
        for p in row["parts"]:
            for i, n in zip(p["index"], p["count"]):
                yield {**{k: row[k] for k in groups.names}, "low": math.ldexp(float(i), p["e"]), "high": math.ldexp(float(i + 1), p["e"]), "rows": int(n)}

    found = finalize(packed, fn, groups.schema(packed) + "low double, high double, rows bigint")
    return found.select(*groups.restored(), "low", "high", "rows")
