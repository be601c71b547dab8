"""Group keys that no double holds, beside null ones; user columns of any name."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estimand.operators import matching, regress, series
from estimand.plans.moments import moments

BIG = 2**53 + 1


@pytest.fixture(scope="module")
def keyed(spark):
    rng = np.random.default_rng(0)
    rows = [((BIG, BIG - 1, None, 4)[i % 4], "ab"[i % 2], i, *(float(x) for x in rng.normal(5, 2, 8))) for i in range(4000)]
    return spark.createDataFrame(rows, "k long, s string, id long, " + ", ".join(f"x{j} double" for j in range(8))).repartition(7).cache()


def test_moments_of_many_columns(spark, keyed):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 300)
    got = {(r.k, r.s): r for r in moments(keyed, [f"x{j}" for j in range(8)], ["k", "s"]).collect()}
    whole = moments(keyed, [f"x{j}" for j in range(8)]).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10000)
    rows = [tuple(r) for r in keyed.collect()]
    for key, own in [(k, [r for r in rows if r[:2] == k]) for k in got] + [((), rows)]:
        x = np.array([r[3:] for r in own])
        r = got[key] if key else whole[0]
        assert r.n == len(x) and np.allclose(r.mean, x.mean(axis=0))
        assert np.allclose(r.comoment, (np.cov(x.T) * (len(x) - 1))[np.triu_indices(8)])
    assert set(got) == {(BIG, "a"), (BIG - 1, "b"), (None, "a"), (4, "b")} and len(whole) == 1
    assert moments(keyed.limit(0), [f"x{j}" for j in range(8)], ["k"]).count() == 0


def test_wide_regression_by_exact_keys(keyed):
    df = keyed.withColumn("y", F.expr("1 + x0 - 2 * x1 + 3 * x2 + x3 + x4 - x5 + coalesce(k % 5, 2) * x6"))
    got = regress.ols(df, "y ~ x0 + x1 + x2 + x3 + x4 + x5 + x6", by=["k"]).collect()
    assert {r.k for r in got} == {BIG, BIG - 1, None, 4}


def test_delta_sum_keeps_keys(spark, keyed):
    got = {r.k: r.delta_sum for r in series.delta_sum(keyed, "x0", ["id"], ["k"]).collect()}
    pdf = pd.DataFrame([(str(r.k), r.id, r.x0) for r in keyed.collect()], columns=["k", "id", "x"]).sort_values("id")
    want = pdf.groupby("k").x.apply(lambda x: np.maximum(0, x.diff()).sum())
    assert {str(k): v for k, v in got.items()} == pytest.approx(want.to_dict())


def test_columns_of_any_name_stay(spark):
    rows = [(i, i % 2 * 2 - 1, "g", 99, 7, 5, 6, "r") for i in range(20)]
    df = spark.createDataFrame(rows, "id long, t int, g string, _arm int, _l0 int, _rank int, _pairs int, _row string")
    for limit in (1000, 5):
        out = matching.exact_matching(df, "t", ["g"], ["id"], hot_rows=limit)
        assert out.columns == [*df.columns, "match_index"]
        assert sorted(tuple(r)[:-1] for r in out.collect()) == rows and out.where("match_index = 0").count() == 0
    df = df.withColumnsRenamed({"_arm": "_home", "_l0": "_block"})
    out = series.moving(df, "id", 3, ["id"], ["g"], ["id"], "sum", hot_rows=5)
    assert out.columns == [*df.columns, "moving_sum"] and sorted(tuple(r)[:-1] for r in out.collect()) == rows
    assert {r.id: r.moving_sum for r in out.collect()} == {i: sum(range(max(0, i - 2), i + 1)) for i in range(20)}
