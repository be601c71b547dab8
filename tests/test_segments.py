"""Running sums inside groups and the statistics that are built on them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estimand.operators import ks, ranktests, series
from estimand.plans.segments import segmented_prefix

BIG = 2**53 + 1  # not a double


def rows(seed, groups=40, hot=3000):
    """Many small groups, a group with a third of the rows, a null key and a key that no double holds; values tie."""
    rng = np.random.default_rng(seed)
    keys = [*rng.integers(0, groups, hot), *[BIG] * hot, *[None] * 300, *[BIG - 1] * 200]
    return [(k if k is None else int(k), f"s{i % 2}", int(rng.integers(0, 60)), float(rng.integers(0, 50)), int(rng.integers(0, 2)), i) for i, k in enumerate(keys)]


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_sums_before_a_row(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        data = rows(parts)
        df = spark.createDataFrame(data, "k long, s string, o long, v double, w int, id long")
        got = {r.id: (r.k, r.s, r.v_before, r.w_before) for r in segmented_prefix(df, ["k", "s"], ["o", "id"], ["v", "w"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    seen = {}
    for k, s, o, v, w, i in sorted(data, key=lambda r: (r[2], r[5])):
        a, b = seen.get((k, s), (0.0, 0.0))
        assert got[i] == (k, s, a, b)
        seen[k, s] = a + v, b + w
    assert len(got) == len(data)


def test_no_rows_and_no_groups(spark):
    df = spark.createDataFrame(rows(1), "k long, s string, o long, v double, w int, id long")
    assert segmented_prefix(df.limit(0), ["k"], ["o", "id"], ["v"]).count() == 0
    total = segmented_prefix(df, [], ["o", "id"], ["w"]).agg(F.max("w_before")).first()[0]
    assert total >= df.agg(F.sum("w")).first()[0] - 1


def test_groups_equal_the_ungrouped_operators(spark):
    data = rows(3, groups=3, hot=400)
    df = spark.createDataFrame(data, "k long, s string, o long, v double, w int, id long").withColumns({c: F.lit("own") for c in ("_v", "_s", "n1", "total")})
    tests = {r.k: (r.d_statistic, r.p_value) for r in ks.ks_grouped(df, "v", "w", ["k"]).collect()}
    ranks = {r.k: (r.u1, r.u2, r.p_value) for r in ranktests.mann_whitney_grouped(df, "v", "w", ["k"]).collect()}
    middle = {(r.k, r.p): r.value for r in ranktests.quantiles_grouped(df, "v", [0.0, 0.3, 1.0], ["k"]).collect()}
    depth = {r.k: r for r in series.intervals_grouped(df, "v", "v + o", ["k"]).collect()}
    for k in {r[0] for r in data}:
        own = df.where(F.col("k").eqNullSafe(F.lit(k)))
        assert tests[k] == pytest.approx(tuple(ks.ks_test(own, "v", "w").first()), abs=1e-12)
        assert ranks[k] == pytest.approx(tuple(ranktests.mann_whitney(own, "v", "w").first()), abs=1e-9)
        for r in ranktests.exact_quantiles(own, "v", [0.0, 0.3, 1.0]).collect():
            assert middle[k, r.p] == pytest.approx(r.value)
        assert (depth[k].max_intersections, depth[k].position) == tuple(series.max_intersections(own, "v", "v + o").first())
        assert depth[k].interval_length_sum == pytest.approx(series.interval_length_sum(own, "v", "v + o").first()[0])


def test_group_with_an_empty_sample_gets_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 2.0, 0), ("b", 1.0, 0), ("b", 3.0, 1), ("c", None, 1)], "k string, v double, w int")
    assert {r.k: r.d_statistic for r in ks.ks_grouped(df, "v", "w", ["k"]).collect()} == {"a": None, "b": 1.0}
    assert {r.k: r.u1 for r in ranktests.mann_whitney_grouped(df, "v", "w", ["k"]).collect()} == {"a": None, "b": 0.0}


def test_weighted_quantiles(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.integers(0, 4, 900), "v": rng.integers(0, 40, 900).astype(float), "w": rng.integers(-1, 6, 900)})
    got = {(r.k, r.p): r.value for r in ranktests.quantiles_grouped(spark.createDataFrame(pdf), "v", [0.1, 0.5, 1.0], ["k"], "w").collect()}
    for k, own in pdf[pdf.w > 0].groupby("k"):
        whole = np.sort(np.repeat(own.v, own.w))
        for p in (0.1, 0.5, 1.0):
            assert got[k, p] == whole[max(1, int(np.ceil(len(whole) * p - 1e-9))) - 1]
