"""Interaction audit of corpus filters: what each filter removes after every other set of filters.

1. A document becomes a bit mask of the filters that it fails; (part, mask) is counted.
2. The counts give the removals v(S) of every coalition S of filters: documents that fail at least one of S.
3. Differences of two coalitions are the counts of one filter at one step of one order.
4. Shapley values solve the constrained least squares problem

       min  sum over S of w(S) (v(S) - sum of phi_i in S)^2   with   sum of all phi_i = v(all),
       w(S) = (m - 1) / (C(m, |S|) |S| (m - |S|)),

   whose normal equations are solved once in rationals, for every unit table v, so that a part needs whole-number sums only.
"""

import itertools
import math
from fractions import Fraction

from pyspark.sql import functions as F

from estimand.plans.prefix import release, stored

#: The five filters of the registered audit, in the order of their bits.
WORD_BREAK = r"[\x20\x09-\x0D]+"
CAPITALS, SIGNS = "[^A-Z]", "[#$%&*|]"
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 50, 65, 5


def text_filters(text):
    """Failure conditions by name of a text column without nulls: few words, repeated words, capitals, signs."""
    words = F.filter(F.split(text, WORD_BREAK, -1), lambda w: w != "")
    n = F.size(words)
    return {
        "A": n < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n,
        "C": 100 * F.length(F.regexp_replace(text, CAPITALS, "")).cast("long") > MAX_CAPITALS * F.length(text).cast("long"),
        "D": text.rlike(SIGNS),
    }


def shapley_weights(m):
    """Integers c[i][S] with sum over S of c[i][S] v(S) = m! phi_i, from the least squares problem of ``m`` filters; v(empty) = 0."""
    every = (1 << m) - 1
    rows = [[Fraction(0)] * (m + 1 + (1 << m)) for _ in range(m + 1)]  # normal equations with a multiplier, beside them one unit table v a column
    for s in range(1, every):
        k = s.bit_count()
        weight = Fraction(m - 1, math.comb(m, k) * k * (m - k))
        for i in range(m):
            if s >> i & 1:
                rows[i][m + 1 + s] += weight
                for j in range(m):
                    if s >> j & 1:
                        rows[i][j] += weight
    for i in range(m):
        rows[i][m] = rows[m][i] = Fraction(1)
    rows[m][m + 1 + every] = Fraction(1)
    for i in range(m + 1):
        at = next(r for r in range(i, m + 1) if rows[r][i])
        rows[i], rows[at] = rows[at], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(m + 1):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    scaled = [[x * math.factorial(m) for x in row[m + 1 :]] for row in rows[:m]]
    assert all(x.denominator == 1 for row in scaled for x in row)
    return [[int(x) for x in row] for row in scaled]


def failures(docs, labels, text="text", key="doc_id", part="source", filters=text_filters, repeated="E"):
    """Stored (part, mask, good, toxic, n), counts of documents by the filters they fail, and the names of all filters.

    ``filters`` gives conditions of one text; the last bit is ``repeated``: the
    same text has a smaller key somewhere in the table.  Texts are compared by
    SHA-256, so that a hot text is one row in each task and no text is shuffled.
    Rows with a null key repeat nothing and are repeated by nothing.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    conditions = filters(body)
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(conditions.values())), F.lit(0))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(body, 256)).alias("digest"), mask.alias("mask"))
    own = stored(rows.groupBy("key", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n")))
    first = own.groupBy("digest").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("digest", "lo")
    rows = own.join(first, "digest", "left")
    again = F.coalesce(F.col("lo") < F.col("key"), F.lit(False))
    rows = rows.withColumn("mask", F.col("mask") + F.when(again, F.lit(1 << len(conditions))).otherwise(F.lit(0))).groupBy("key", "part", "mask").agg(F.sum("n").alias("n"))
    marked = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).where("good or toxic")
    rows = rows.join(marked, "key", "left").select("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    counts = stored(rows.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")))
    release(own)
    return counts, [*conditions, repeated]


def coalitions(counts, m):
    """(part, s, total, removed, good, toxic, fails) for all 2^m coalitions ``s``: documents that fail at least one filter of s."""
    hit = lambda value: F.sum(F.when(F.col("mask").bitwiseAND(F.col("s")) != 0, value).otherwise(F.lit(0)))
    n = F.col("n")
    table = counts.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit((1 << m) - 1))))
    return table.groupBy("part", "s").agg(
        F.sum("n").alias("total"), hit(n).alias("removed"), hit(F.when(F.col("good"), n).otherwise(F.lit(0))).alias("good"), hit(F.when(F.col("toxic"), n).otherwise(F.lit(0))).alias("toxic"))


def audit(docs, labels, text="text", key="doc_id", part="source", filters=text_filters, repeated="E"):
    """One row for each part, each order of the filters and each step of it, with the counts of the filter of that step.

    part: null is the empty string.  Columns: filter_order (names joined), step
    (from 1), kept, removed, redundant (failing it, removed earlier),
    unique_fails (failing it alone), good_lost and toxic_lost (removed here with
    that label on any label row of the key), shapley (its removals summed over
    all orders).  A null text is empty; repeated rows count as often as they
    occur; an empty table gives no row.
    """
    counts, names = failures(docs, labels, text, key, part, filters, repeated)
    m = len(names)
    every = (1 << m) - 1
    weights = shapley_weights(m)
    table = coalitions(counts, m)
    phi = [F.sum(F.element_at(F.expr(f"array({', '.join(map(str, weights[i]))})"), F.col("s") + 1) * F.col("removed")).alias(f"phi{i}") for i in range(m)]
    # exactly 2^m rows of a part: a bounded list
    v = table.groupBy("part").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("s", "removed", "good", "toxic"))).alias("v"), *phi)
    orders = F.split(F.lit(" ".join("".join(chr(48 + i) for i in order) for order in itertools.permutations(range(m)))), " ")
    steps = v.withColumn("order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(m))))
    steps = steps.withColumn("i", F.ascii(F.expr("substring(order, step, 1)")) - 48).withColumn("bit", F.expr("shiftleft(1, i)"))
    earlier = sum((F.when(F.instr("order", chr(48 + i)) < F.col("step"), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(m)), F.lit(0))
    steps = steps.withColumn("before", earlier)
    at = lambda s, field: F.element_at("v", s + 1)[field]
    both = F.col("before") + F.col("bit")
    gain = lambda field: at(both, field) - at(F.col("before"), field)
    letters = F.array(*[F.lit(x) for x in names])
    return steps.select(
        "part", F.array_join(F.transform(F.split("order", ""), lambda i: F.element_at(letters, F.ascii(i) - 47)), "").alias("filter_order"), "step",
        (F.col("total") - at(both, "removed")).alias("kept"), gain("removed").alias("removed"), (at(F.col("bit"), "removed") - gain("removed")).alias("redundant"),
        (at(F.lit(every), "removed") - at(F.lit(every) - F.col("bit"), "removed")).alias("unique_fails"), gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"),
        F.element_at(F.array(*[f"phi{i}" for i in range(m)]), F.col("i") + 1).alias("shapley"))
