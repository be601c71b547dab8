"""Event-stream aggregates per user: funnel, retention, sequences."""

import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Window as W, functions as F

from estimand.functions.columns import as_column, epoch_seconds
from estimand.plans.prefix import sorted_partials, stored
from estimand.plans.ranks import ranked
from estimand.plans.segments import segmented_max


def _step_flags(steps):
    return [F.coalesce(as_column(c), F.lit(False)).alias(f"_m{i + 1}") for i, c in enumerate(steps)]


def _any_step(k):
    return F.expr(" or ".join(f"_m{i}" for i in range(1, k + 1)))


def window_funnel(df, user, ts, window, steps, tie=(), slices=8):
    """Deepest step of the chain 1, 2, .. reached within ``window`` seconds.

    A chain never outlives the window, so a user's history is cut into time
    slices of ``slices`` windows; rows of the following window are repeated so
    that a chain started in a slice is finished there.  The state per step is a
    running maximum of the chain start, all over one sort.  Users without a
    step-1 event get level 0.
    """
    length = float(window) * slices
    k, keys = len(steps), [f"_k{i}" for i in range(len(tie))]
    rows = df.select(
        F.col(user), epoch_seconds(df, ts).alias("_t"), *[F.col(c).alias(n) for c, n in zip(tie, keys)],
        *_step_flags(steps),
    ).where(F.col(user).isNotNull() & F.col("_t").isNotNull())
    home = F.floor(F.col("_t") / length)
    repeat = (F.col("_t") - home * length <= F.lit(float(window))) & F.greatest(
        F.lit(False), *[F.col(f"_m{i}") for i in range(2, k + 1)])
    cut = rows.where(_any_step(k)).withColumn("_home", home).withColumn(
        "_slice", F.explode(F.when(repeat, F.array(F.col("_home"), F.col("_home") - 1)).otherwise(F.array("_home"))))
    order = W.partitionBy(user, "_slice").orderBy("_t", *keys)
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    started = F.when(F.col("_m1") & (F.col("_home") == F.col("_slice")), F.col("_t"))
    cut = cut.withColumn("_s1", F.max(started).over(upto))
    for i in range(2, k + 1):
        # the latest start that had reached step i-1 before this row
        cut = cut.withColumn("_before", F.lag(f"_s{i - 1}").over(order))
        alive = F.col(f"_m{i}") & (F.col("_t") <= F.col("_before") + F.lit(float(window)))
        cut = cut.withColumn(f"_s{i}", F.max(F.when(alive, F.col("_before"))).over(upto))
    reached = F.lit(0)
    for i in range(1, k + 1):
        reached = F.when(F.col(f"_s{i}").isNotNull(), i).otherwise(reached)
    levels = cut.groupBy(user).agg(F.max(reached).alias("level"))
    everyone = rows.groupBy(user).agg(F.lit(0).alias("_zero"))
    return everyone.join(levels, user, "left").select(user, F.coalesce("level", F.lit(0)).alias("level"))


def retention(df, user, conditions):
    """r1..rn per user: condition 1 met, and condition i met together with it."""
    met = df.groupBy(user).agg(*[
        F.coalesce(F.max(F.when(as_column(c), 1).otherwise(0)), F.lit(0)).alias(f"_c{i}")
        for i, c in enumerate(conditions)
    ])
    return met.select(user, *[(F.col("_c0") * F.col(f"_c{i}")).alias(f"r{i + 1}") for i in range(len(conditions))])


def _segment_levels(pdf, user, k):
    """For every user segment of sorted rows: the level after it for every
    level before it, by greedy earliest matches (all segments at once)."""
    users = pdf[user].to_numpy()
    starts = np.flatnonzero(np.append(True, users[1:] != users[:-1]))
    ends = np.append(starts[1:], len(users))
    where = [np.flatnonzero(pdf[f"_m{i}"].to_numpy(dtype=bool)) for i in range(1, k + 1)]
    levels = []
    for entry in range(k + 1):
        level, pos, live = np.full(len(starts), entry), starts.copy(), np.ones(len(starts), dtype=bool)
        for s in range(entry + 1, k + 1):
            hit = np.append(where[s - 1], len(users))[np.searchsorted(where[s - 1], pos)]
            live = live & (hit < ends)
            level = np.where(live, s, level)
            pos = np.where(live, hit + 1, pos)
        levels.append(level)
    return starts, np.array(levels).T


def sequence_match(df, user, ts, steps, tie=()):
    """Level of the ordered chain step 1 .. step n (any gaps) and whether all
    of it occurred.

    Each sorted range partition reports one level map per user; only users cut
    by partition borders have several maps, which are chained in order.
    """
    k = len(steps)
    order = [user, ts, *tie]
    rows = df.select(*order, *_step_flags(steps)).where(F.col(user).isNotNull() & _any_step(k))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        held = None  # the open last segment of the previous batch
        for pdf in batches:
            if not len(pdf):
                continue
            starts, maps = _segment_levels(pdf, user, k)
            out = pdf.iloc[starts][order].reset_index(drop=True)
            out["_f"] = list(maps.astype("int32"))
            if held is not None:
                if held[user].iloc[0] == out[user].iloc[0]:
                    chained = out["_f"].iloc[0][held["_f"].iloc[0]]
                    out.loc[0, order] = held.iloc[0][order]
                    out.at[0, "_f"] = chained
                else:
                    yield held
            held = out.iloc[-1:].reset_index(drop=True)
            if len(out) > 1:
                yield out.iloc[:-1]
        if held is not None:
            yield held

    schema = ", ".join(f"`{c}` {types[c]}" for c in order) + ", _f array<int>"
    parts = sorted_partials(rows, order, run, schema)
    chained = parts.groupBy(user).agg(F.sort_array(F.collect_list(F.struct(*order[1:], "_f"))).alias("p"))
    level = F.aggregate("p", F.lit(0), lambda acc, c: F.element_at(c["_f"], acc + 1))
    return chained.select(user, level.alias("level")).withColumn("matched", F.col("level") == k)


def next_event(df, user, ts, event, base, tie=()):
    """The event following the first event that satisfies ``base``, per user.

    Two combinable aggregates instead of a per-user sort: the earliest match,
    then the earliest later event.
    """
    order = F.struct(F.col(ts), *[F.col(c) for c in tie])
    rows = df.select(F.col(user), order.alias("_order"), F.col(event).alias("_event"), as_column(base).alias("_base"))
    rows = rows.where(F.col(user).isNotNull())
    first = rows.where("_base").groupBy(user).agg(F.min("_order").alias("_from"))
    return rows.join(first, user).groupBy(user).agg(
        F.min_by("_event", F.when(F.col("_order") > F.col("_from"), F.col("_order"))).alias("next_event")
    )


# ---- patterns -------------------------------------------------------------------

#: Rows of a user from which its pattern is matched over shared orders instead of one window.
PATTERN_ROWS = 2_000_000
_TOKEN = re.compile(r"\(\?(\d+)\)|\(\?t\s*(<=|>=|==|<|>)\s*(\d+(?:\.\d+)?)\)|(\.\*)|(\.)")


def parse_pattern(pattern, n):
    """[(condition number or 0 for any event, gap to the event before)] of a sequence pattern.

    ``(?N)`` is an event with condition N, ``.`` any event, ``.*`` any number of
    events, ``(?t op seconds)`` any number of events with that time between the
    events on both sides (op: <= < >= > ==).  Other neighbours are adjacent.  A
    gap is None (adjacent), "any" or (op, microseconds) with op <=, >= or ==; the
    first event may be anywhere.
    """
    steps, gap, at = [], "any", 0
    for m in _TOKEN.finditer(pattern):
        if m.start() != at:
            break
        at = m.end()
        number, op, seconds, star, dot = m.groups()
        if star or op:
            if gap is not None and steps:
                raise ValueError(f"two gaps in a row in {pattern!r}")
            if op and not steps:
                raise ValueError(f"{pattern!r} begins with a time")
            gap = "any" if star else _time_gap(op, round(float(seconds) * 1_000_000))
            continue
        if number and not 1 <= int(number) <= n:
            raise ValueError(f"condition {number} of {n} in {pattern!r}")
        steps.append((int(number) if number else 0, gap))
        gap = None
    if at != len(pattern) or not steps:
        raise ValueError(f"cannot read the pattern {pattern!r}")
    if isinstance(gap, tuple):
        raise ValueError(f"{pattern!r} ends with a time")
    return steps


def _time_gap(op, micros):
    """Times are whole microseconds, so strict bounds are the neighbouring ones; later events are never earlier in time."""
    op, micros = {"<": ("<=", micros - 1), ">": (">=", micros + 1)}.get(op, (op, micros))
    if op == ">=" and micros <= 0:
        return "any"
    return ("<=", 0) if op == "==" and micros == 0 else (op, micros)


def _step_starts(rows, keys, steps):
    """Add ``_s``: the latest first event (number in the user's order) of a match that ends at the row, for users of one window each.

    The latest start never falls along a user's rows, so every gap needs only
    the last earlier row at which the steps so far end: one sort for all steps.
    """
    order = W.partitionBy(*keys).orderBy("_i")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    timed = W.partitionBy(*keys).orderBy("_t")
    for k, (number, gap) in enumerate(steps):
        fits = F.col(f"_m{number}") if number else F.lit(True)
        if k == 0:
            found = F.col("_i")
        elif gap is None:
            found = F.lag("_s").over(order)
        elif gap == "any":
            found = F.max("_s").over(before)
        else:
            op, micros = gap
            if op == "<=":
                last = F.max(F.when(F.col("_s").isNotNull(), F.struct("_i", "_t", "_s"))).over(before)
                found = F.when(F.col("_t") - last["_t"] <= micros, last["_s"])
            else:
                found = F.max("_s").over(timed.rangeBetween(-micros if op == "==" else W.unboundedPreceding, -micros))
        rows = rows.withColumn("_s", F.when(fits, found))
    return rows


def _hot_starts(rows, steps):
    """``_step_starts`` for users that no task could hold: each gap is a join or a running maximum over the order of all rows."""
    for k, (number, gap) in enumerate(steps):
        fits = F.col(f"_m{number}") if number else F.lit(True)
        if k == 0:
            rows = rows.withColumn("_s", F.when(fits, F.col("_i")))
            continue
        ends = rows.where("_s is not null")
        if gap is None:
            other = ends.select(F.col("_u").alias("_ou"), (F.col("_i") + 1).alias("_oi"), F.col("_s").alias("_from"))
            rows = rows.join(other, (F.col("_u") == F.col("_ou")) & (F.col("_i") == F.col("_oi")), "left").drop("_ou", "_oi")
        elif gap != "any" and gap[0] == "==":
            other = ends.groupBy(F.col("_u").alias("_ou"), (F.col("_t") + gap[1]).alias("_ot")).agg(F.max("_s").alias("_from"))
            rows = rows.join(other, (F.col("_u") == F.col("_ou")) & (F.col("_t") == F.col("_ot")), "left").drop("_ou", "_ot")
        else:
            # every row asks, and gives what ends there: at its own place, or `later` microseconds after its time and then before the rows that ask
            later = gap[1] if gap != "any" and gap[0] == ">=" else None
            at = lambda c: F.lit(0).cast("bigint") if later is None else c
            none = F.lit(None).cast("double")
            asks = rows.select("_u", at(F.col("_t")).alias("_at"), F.lit(1).alias("_kind"), F.col("_i").cast("double").alias("_place"),
                               none.alias("_last"), none.alias("_from"), F.struct(*rows.columns).alias("_row"))
            gives = ends.select("_u", at(F.col("_t") + F.lit(later or 0)).alias("_at"), F.lit(1 if later is None else 0).alias("_kind"), (F.col("_i") + F.lit(0.5)).alias("_place"),
                                F.col("_t").cast("double").alias("_last"), F.col("_s").cast("double").alias("_from"), F.lit(None).alias("_row"))
            seen = segmented_max(asks.unionByName(gives), ["_u"], ["_at", "_kind", "_place"], ["_last", "_from"], keep=["_row"]).where("_row is not null")
            found = F.col("_from_before")
            if later is None and gap != "any":
                found = F.when(F.col("_row._t") - F.col("_last_before") <= gap[1], found)
            rows = seen.select(F.col("_row.*"), found.cast("bigint").alias("_from"))
        rows = stored(rows.withColumn("_s", F.when(fits, F.col("_from"))).drop("_from"))
    return rows


def _chain_table(size):
    """For the match ends of a block of ``size`` rows of a user: the matches taken one after the other, for every last end taken before the block.

    Starts never fall, so only the starts before the block and the first one in
    it tell cases apart.
    """

    def solve(pdf):
        pdf = pdf.sort_values("_i")
        end, start = pdf["_i"].to_numpy(), pdf["_s"].to_numpy()
        after = np.searchsorted(start, end, "right")
        count, last = np.ones(len(end), np.int64), end.copy()
        for k in range(len(end) - 1, -1, -1):
            if after[k] < len(end):
                count[k], last[k] = 1 + count[after[k]], last[after[k]]
        edge = np.flatnonzero(np.append(True, start[1:] != start[:-1]))
        edge = edge[: np.searchsorted(start[edge], end[0] // size * size) + 1]
        return pd.DataFrame({"_u": [pdf["_u"].iloc[0]], "_first": [int(end[0])], "_edges": [start[edge].tolist()], "_counts": [count[edge].tolist()], "_lasts": [last[edge].tolist()]})

    return solve


def sequence_pattern(df, user, ts, pattern, conditions, tie=(), pattern_rows=PATTERN_ROWS):
    """(user, matched, matches): whether a user's events hold the pattern, and how often without overlap.

    Events that meet no condition are left out first.  Events are ordered by
    time (seconds) and ``tie``; matches are taken from the front, each the one
    that ends first after the last taken.  See ``parse_pattern``.  Every user
    with an event gets a row; rows with a null user or time are left out.
    """
    steps = parse_pattern(pattern, len(conditions))
    keys = [f"_k{i}" for i in range(len(tie))]
    rows = df.select(F.col(user).alias("_u"), F.round(epoch_seconds(df, ts) * 1_000_000).cast("bigint").alias("_t"), *[F.col(c).alias(n) for c, n in zip(tie, keys)], *_step_flags(conditions))
    rows = rows.where("_u is not null and _t is not null")
    own = rows.where(_any_step(len(conditions)))
    sizes = own.groupBy("_u").agg(F.count(F.lit(1)).alias("_size"))
    hot = (sizes.agg(F.max("_size")).first()[0] or 0) > pattern_rows
    used = ["_u", "_t", "_i", *[f"_m{i + 1}" for i in range(len(conditions))]]
    if hot:
        placed = stored(ranked(own, ["_u"], ["_t", *keys], [], pattern_rows, name="_i").select(*used))
        large = sizes.where(F.col("_size") > pattern_rows).select("_u")
        cold = placed.join(large, "_u", "left_anti")
    else:
        cold = own.withColumn("_i", F.row_number().over(W.partitionBy("_u").orderBy("_t", *keys)).cast("bigint")).select(*used)
    ends = _step_starts(cold, ["_u"], steps).where("_s is not null")
    taken = F.aggregate(
        F.array_sort(F.collect_list(F.struct("_i", "_s"))), F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("last")),
        lambda acc, e: F.when(e["_s"] > acc["last"], F.struct((acc["n"] + 1).alias("n"), e["_i"].cast("bigint").alias("last"))).otherwise(acc), lambda acc: acc["n"])
    counts = ends.groupBy("_u").agg(taken.alias("matches"))
    if hot:
        ends = _hot_starts(placed.join(large, "_u", "left_semi"), steps).where("_s is not null").select("_u", "_i", "_s")
        kind = ends.schema["_u"].dataType.simpleString()
        blocks = ends.groupBy("_u", F.floor(F.col("_i") / pattern_rows).alias("_block")).applyInPandas(
            _chain_table(pattern_rows), f"_u {kind}, _first bigint, _edges array<bigint>, _counts array<bigint>, _lasts array<bigint>")
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("last"))

        def go_on(acc, b):
            # the place of the first start after the last taken end
            at = F.size(F.filter(b["_edges"], lambda s: s <= acc["last"])) + 1
            more = at <= F.size(b["_edges"])
            return F.when(more, F.struct((acc["n"] + F.element_at(b["_counts"], F.when(more, at).otherwise(1))).alias("n"),
                                         F.element_at(b["_lasts"], F.when(more, at).otherwise(1)).alias("last"))).otherwise(acc)

        tables = F.array_sort(F.collect_list(F.struct("_first", "_edges", "_counts", "_lasts")))
        counts = counts.unionByName(blocks.groupBy("_u").agg(F.aggregate(tables, zero, go_on, lambda acc: acc["n"]).alias("matches")))
    everyone = rows.groupBy("_u").agg(F.lit(0).cast("bigint").alias("_zero"))
    n = F.coalesce("matches", "_zero")
    return everyone.join(counts, "_u", "left").select(F.col("_u").alias(user), (n > 0).alias("matched"), n.alias("matches"))
