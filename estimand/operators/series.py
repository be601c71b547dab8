"""Ordered aggregates: deltas, moving windows, decay, intervals."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W, functions as F

from estimand.functions.columns import as_column, as_double
from estimand.plans.finalize import finalize
from estimand.plans.prefix import partial_frame, prefix_sum, sorted_partials
from estimand.plans.ranks import HOT_ROWS, ranked
from estimand.plans.segments import Groups, _starts, segmented_prefix


def _steps(by, keys):
    """(keys and order of the first row, first, last, total) of the segments of sorted rows; keys stay Arrow columns."""

    def run(batches):
        held = None  # the open segment: its first row, first value, last value, total
        names = [*by, *keys, "first", "last", "total"]

        def closed(row, first, last, total):
            return pa.RecordBatch.from_arrays([*row.columns, pa.array([first]), pa.array([last]), pa.array([total])], names=names)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(b) for b in by]
            v = np.asarray(batch.column("_v").to_numpy(zero_copy_only=False), float)
            new = _starts(columns, [held[0].column(b)[0] for b in by] if held else None)
            starts = np.flatnonzero(new)
            step = np.maximum(0.0, np.diff(v, prepend=held[2] if held else v[0]))
            step[starts] = 0.0
            open_end = int(starts[0]) if len(starts) else n
            if held and open_end:
                held = (held[0], held[1], float(v[open_end - 1]), held[3] + float(step[:open_end].sum()))
            if not len(starts):
                continue
            if held:
                yield closed(*held)
            ends = np.append(starts[1:], n)
            rows = batch.select([*by, *keys]).take(pa.array(starts))
            total = np.add.reduceat(step, starts)
            done = len(starts) - 1
            if done:
                yield pa.RecordBatch.from_arrays([*rows.slice(0, done).columns, pa.array(v[starts[:-1]]), pa.array(v[ends[:-1] - 1]), pa.array(total[:-1])], names=names)
            held = (rows.slice(done), float(v[starts[-1]]), float(v[-1]), float(total[-1]))
        if held:
            yield closed(*held)

    return run


def delta_sum(df, value, order, by):
    """Sum of the positive steps between consecutive rows of each group.

    Range partitions of (by, order) report first, last and local sum per group;
    a group cut by partition borders contributes the steps across the cuts.
    ``order`` columns must identify rows inside a group.  Group keys stay exact.
    """
    groups = Groups(by)
    keys = [f"_o{i}" for i in range(len(order))]
    rows = df.select(*groups.columns(), *[F.col(o).alias(k) for o, k in zip(order, keys)], as_double(value).alias("_v")).dropna(subset=["_v", *keys])
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    names = groups.names
    schema = ", ".join([f"`{c}` {types[c]}" for c in names + keys] + ["first double", "last double", "total double"])
    ranged = rows.repartitionByRange(*names, *keys).sortWithinPartitions(*names, *keys)
    parts = ranged.mapInArrow(_steps(names, keys), schema)
    cells = parts.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct(*keys, "first", "last", "total"))).alias("p"))
    cuts = F.zip_with(
        F.slice("p", F.lit(2), F.greatest(F.size("p") - 1, F.lit(0))), F.slice("p", F.lit(1), F.greatest(F.size("p") - 1, F.lit(0))),
        lambda nxt, cur: F.greatest(F.lit(0.0), nxt["first"] - cur["last"]),
    )
    add = lambda acc, x: acc + x
    return cells.select(
        *groups.restored(), (F.aggregate(F.transform("p", lambda c: c["total"]), F.lit(0.0), add)
                             + F.aggregate(cuts, F.lit(0.0), add)).alias("delta_sum"),
    )


def moving(df, value, size, order, by, key=(), kind="sum", hot_rows=HOT_ROWS):
    """Add ``moving_<kind>`` over the last ``size`` rows of each group.

    ``avg`` divides by ``size`` also at the start of a group.  Groups are walked
    in blocks of rank; the last size-1 rows of a block are repeated in the next
    one, so a huge group is many tasks and every window still sees its rows.
    """
    if kind not in ("sum", "avg"):
        raise ValueError("kind must be 'sum' or 'avg'")
    kept = [c for c in df.columns if c != f"moving_{kind}"]
    groups = Groups(by)
    names, keys = [f"_o{i}" for i in range(len(order))], [f"_k{i}" for i in range(len(key))]
    # the user's row travels as one column, so that no name of it can clash
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), *groups.columns(), as_double(value).alias("_v"),
                      *[as_column(o).alias(n) for o, n in zip(order, names)], *[F.col(c).alias(n) for c, n in zip(key, keys)])
    placed = ranked(inner, groups.names, names, keys, hot_rows, name="_rank")
    block = max(hot_rows, 2 * size)
    home = F.floor((F.col("_rank") - 1) / F.lit(block))
    spill = F.col("_rank") - home * F.lit(block) > F.lit(block - size + 1)
    blocks = F.when(spill, F.array(home, home + 1)).otherwise(F.array(home))
    halo = placed.withColumn("_home", home).withColumn("_block", F.explode(blocks))
    w = W.partitionBy(*groups.names, "_block").orderBy("_rank").rowsBetween(-(size - 1), 0)
    total = F.sum("_v").over(w)
    out = halo.withColumn("_out", total if kind == "sum" else total / F.lit(float(size)))
    return out.where(F.col("_home") == F.col("_block")).select("_row.*", F.col("_out").alias(f"moving_{kind}"))


def exponential_moving_average(df, value, time, half_life, by):
    """Average with weights 2 ** -((t_last - t) / half_life), scaled by
    1 - 2 ** (-1 / half_life).

    Values are first decayed to the end of their time bin (map-side combined),
    then bins to the last time of the group.
    """
    x = float(half_life)
    width = 32.0 * x
    rows = df.select(*by, as_double(value).alias("_v"), as_double(time).alias("_t")).dropna(subset=["_v", "_t"])
    bins = rows.withColumn("_bin", F.floor(F.col("_t") / width)).groupBy(*by, "_bin").agg(
        F.max("_t").alias("_last"),
        F.sum(F.col("_v") * F.pow(F.lit(2.0), (F.col("_t") - (F.col("_bin") + 1) * width) / x)).alias("_s"),
    )
    last = F.max("_last").over(W.partitionBy(*by))
    decayed = bins.withColumn("_w", F.pow(F.lit(2.0), ((F.col("_bin") + 1) * width - last) / x))
    return decayed.groupBy(*by).agg((F.sum(F.col("_s") * F.col("_w")) * F.lit(1 - 2 ** (-1 / x))).alias("ema"))


def _borders(df, start, end):
    """Net number of intervals opening (+) or closing (-) at each position."""
    rows = df.select(as_double(start).alias("s"), as_double(end).alias("e")).dropna().where("s < e")
    ends = F.array(F.struct(F.col("s").alias("pos"), F.lit(1).alias("d")),
                   F.struct(F.col("e").alias("pos"), F.lit(-1).alias("d")))
    return rows.select(F.inline(ends)).groupBy("pos").agg(F.sum("d").alias("d"))


def _depth_partials(batches):
    first, total, high, where = None, 0.0, -math.inf, None
    for pdf in batches:
        if not len(pdf):
            continue
        pos = pdf["pos"].to_numpy(float)
        first = float(pos[0]) if first is None else first
        run = total + np.cumsum(pdf["d"].to_numpy(float))
        i = int(run.argmax())
        if run[i] > high:
            high, where = float(run[i]), float(pos[i])
        total = float(run[-1])
    if first is not None:
        yield partial_frame(first=first, total=total, high=high, at=where)


def max_intersections(df, start, end):
    """Largest number of half-open intervals open at once, and its first position."""
    parts = sorted_partials(_borders(df, start, end), ["pos"], _depth_partials,
                            "first double, total double, high double, at double")
    packed = parts.agg(F.sort_array(F.collect_list(F.struct("first", "total", "high", "at"))).alias("parts"))

    def fn(row):
        base, best, at = 0.0, 0.0, None
        for p in row["parts"]:
            if base + p["high"] > best:
                best, at = base + p["high"], p["at"]
            base += p["total"]
        yield {"max_intersections": int(best), "position": at}

    return finalize(packed, fn, "max_intersections bigint, position double")


def interval_length_sum(df, start, end):
    """Length of the union of intervals: where coverage leaves zero minus where
    it enters."""
    covered = prefix_sum(_borders(df, start, end), ["pos"], ["d"])
    after = F.col("d_before") + F.col("d")
    sign = F.when((F.col("d_before") == 0) & (after > 0), -1.0).when((F.col("d_before") > 0) & (after == 0), 1.0)
    return covered.agg(F.coalesce(F.sum(sign * F.col("pos")), F.lit(0.0)).alias("interval_length_sum"))


def intervals_grouped(df, start, end, by):
    """(by.., max_intersections, position, interval_length_sum) of the half-open intervals of every group, from one order of (group, position)."""
    groups = Groups(by)
    rows = df.select(*groups.columns(), as_double(start).alias("_s"), as_double(end).alias("_e")).dropna(subset=["_s", "_e"]).where("_s < _e")
    ends = F.array(F.struct(F.col("_s").alias("_pos"), F.lit(1).alias("_d")), F.struct(F.col("_e").alias("_pos"), F.lit(-1).alias("_d")))
    borders = rows.select(*groups.names, F.inline(ends)).groupBy(*groups.names, "_pos").agg(F.sum("_d").alias("_d"))
    placed = segmented_prefix(borders, groups.names, ["_pos"], ["_d"])
    after = F.col("_d_before") + F.col("_d")
    sign = F.when((F.col("_d_before") == 0) & (after > 0), -1.0).when((F.col("_d_before") > 0) & (after == 0), 1.0)
    found = placed.groupBy(*groups.names).agg(
        F.max(F.struct(after.cast("bigint").alias("n"), (-F.col("_pos")).alias("at"))).alias("top"), F.coalesce(F.sum(sign * F.col("_pos")), F.lit(0.0)).alias("interval_length_sum"))
    return found.select(*groups.restored(), F.col("top.n").alias("max_intersections"), (-F.col("top.at")).alias("position"), "interval_length_sum")
