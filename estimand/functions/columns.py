"""Column expressions shared by the operators."""

from pyspark.sql import Column, functions as F

# murmur3-32 of this integer under Spark's seed 42 is 0, so
# hash(SEED_ZERO_PREFIX, x) is murmur3-32 of x under seed 0.
SEED_ZERO_PREFIX = -1693959553

# Cut points of numeric tree features (fixed by the reference behaviour).
TREE_QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def as_column(c):
    """Accept a Column or a SQL expression string."""
    return c if isinstance(c, Column) else F.expr(c)


def as_double(c):
    return as_column(c).cast("double")


def epoch_seconds(df, c):
    """Seconds since 1970 as double from a timestamp or a number column.

    Timestamps without time zone are measured without the session time zone.
    """
    kind = df.select(as_column(c).alias("c")).schema["c"].dataType.typeName()
    if kind == "timestamp_ntz":
        gap = as_column(c) - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        parts = (("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1))
        return sum((F.extract(F.lit(u), gap).cast("double") * s for u, s in parts), F.lit(0.0))
    return as_column(c).cast("double")


def wrap_int32(c):
    """Low 32 bits as a signed int, without the ANSI overflow error."""
    low = as_column(c).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 2**31, low - 2**32).otherwise(low).cast("int")


def murmur_bucket(c, bits=7):
    """Top ``bits`` of seed-0 murmur3-32 of the int32 value: 0 .. 2**bits - 1."""
    h = F.hash(F.lit(SEED_ZERO_PREFIX).cast("int"), wrap_int32(c)).cast("bigint")
    return F.shiftright(h.bitwiseAND(F.lit(0xFFFFFFFF)), 32 - bits).cast("int")


def stable_bucket(keys, buckets, seed=0):
    """Deterministic bucket of a row key; survives retries and re-reads."""
    return F.pmod(F.xxhash64(F.lit(seed), *[as_column(k) for k in keys]), F.lit(buckets)).cast("int")


def split_random(keys, seed=0):
    """0/1 split flag per row key."""
    return stable_bucket(keys, 2, seed)


def cut_bins(c, edges):
    """1-based bucket of half-open intervals [e(i-1), e(i)), padded by infinities."""
    x = as_column(c)
    steps = [F.when(x >= F.lit(float(e)), 1).otherwise(0) for e in sorted(set(edges))]
    total = F.lit(1)
    for s in steps:
        total = total + s
    return F.when(x.isNotNull(), total)


def bin_labels(edges):
    """Interval labels of ``cut_bins``: label of bucket i is element i-1."""
    points = [float("-inf"), *sorted({float(e) for e in edges}), float("inf")]
    return [f"[{round(a, 4)},{round(b, 4)})" for a, b in zip(points, points[1:])]


def poly_features(c, degree):
    """x, x**2, .. x**degree as SQL text, usable as a treatment featurizer."""
    return [f"pow({c},{i})" for i in range(1, degree + 1)]


def case_chain(cases, default=None):
    """First matching condition wins; NULL (or ``default``) when none does."""
    chain = F
    for cond, value in cases:
        chain = chain.when(as_column(cond), F.lit(value))
    return chain.otherwise(F.lit(default)) if cases else F.lit(default)


def null_fill(df):
    """Import-time null policy: numbers become 0, strings become 'null'."""
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    out = df.na.fill(0, numeric) if numeric else df
    return out.na.fill("null", text) if text else out
