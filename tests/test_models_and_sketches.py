"""Models by group, logistic fits, one-family FDR, sketches and bucketed joins."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estimand.operators import dml, fdr, penalized, ranktests, regress
from estimand.sources import tables


def test_predictions_by_group_equal_single_fits(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": ["a", "b", None, "c"] * 100, "x": rng.normal(size=400), "_d0": 9, "_row": "own"})
    pdf["y"] = pdf.x * 2 + rng.normal(size=400)
    pdf.loc[pdf.g == "c", "x"] = 1.0  # a singular group
    df = spark.createDataFrame(pdf)
    out = regress.predict_grouped(df, "y ~ x", ["g"], interval="prediction", level=0.9)
    assert out.columns == [*df.columns, "fit", "lower", "upper"]
    assert out.where("g = 'c' and fit is not null").count() == 0
    for g in ("a", "b", None):
        own = df.where(F.col("g").eqNullSafe(F.lit(g)))
        one = regress.fit_linear(own, "y ~ x").predict_interval(own, "prediction", 0.9).select("x", "fit", "lower", "upper")
        many = out.where(F.col("g").eqNullSafe(F.lit(g))).select("x", "fit", "lower", "upper")
        np.testing.assert_allclose(np.array(sorted(map(tuple, many.collect()))), np.array(sorted(map(tuple, one.collect()))), rtol=1e-9)
    other = regress.predict_grouped(df.where("g = 'a'"), "y ~ x", ["g"], train=df.where("g = 'b'"))
    assert other.where("predict is not null").count() == 0


def test_logistic_lasso_meets_its_conditions(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 3)) * [1, 5, 0.2]
    y = (rng.random(3000) < 1 / (1 + np.exp(-(x[:, 0] - 0.3 * x[:, 1])))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    model = penalized.logistic_lasso(df, "y ~ a + b + c", 0.05)
    w = model.coef
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    g = x.T @ (y - p) / len(y)
    assert abs((y - p).mean()) < 1e-7
    for gi, wi in zip(g, w[:-1]):
        assert abs(gi - 0.05 * np.sign(wi)) < 1e-6 if wi else abs(gi) <= 0.05 + 1e-7
    assert w[2] == 0 and w[0] > 0 > w[1]
    with pytest.raises(ValueError):
        penalized.logistic_lasso(df.limit(0), "y ~ a", 0.1)


def test_logistic_propensity_needs_a_binary_treatment(spark):
    rng = np.random.default_rng(2)
    n = 4000
    x = rng.normal(size=n)
    t = (rng.random(n) < 1 / (1 + np.exp(-2 * x))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"i": range(n), "x": x, "t": t, "y": 3.0 * t + x + rng.normal(size=n)}))
    model = dml.LinearDML("y", "t", ["x"], model_t="logistic", fold="i % 3").fit(df)
    assert model.summary().where("term = 'cate_intercept'").first()["estimate"] == pytest.approx(3.0, abs=0.25)
    with pytest.raises(ValueError):
        dml.LinearDML("y", "x", ["t"], model_t="logistic", fold="i % 3").fit(df)


def test_fdr_over_many_rows(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(100_000) ** 2, 4)
    pdf = pd.DataFrame({"i": np.arange(len(p)), "p": p, "_p": 1, "_q": 2})
    pdf.loc[5, "p"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("p", F.when(~F.isnan("p"), F.col("p"))).repartition(6)
    got = fdr.fdr_adjust(df, {"p": "q"})
    assert got.columns == ["i", "p", "_p", "_q", "q"]
    out = got.toPandas().sort_values("i")
    np.testing.assert_allclose(out.q.to_numpy(float), fdr.q_values(pdf.p.to_numpy()), rtol=1e-9)


@pytest.mark.parametrize("parts", [1, 200])
def test_sketch_error_is_below_its_bound(spark, parts):
    rng = np.random.default_rng(parts)
    v = np.concatenate([rng.normal(size=40_000), np.full(20_000, 0.5)])
    df = spark.createDataFrame(pd.DataFrame({"k": [2**53 + 1] * len(v), "v": v})).repartition(parts).unionByName(
        spark.createDataFrame([(None, float(i)) for i in range(9)] + [(2**53, None)], "k long, v double"))
    probs = [0.0, 0.01, 0.3, 0.5, 0.75, 0.999, 1.0]
    got = {(r.k, r.p): r.value for r in ranktests.quantile_sketch(df, "v", probs, ["k"], 0.02).collect()}
    order = np.sort(v)
    for p in probs:
        x = got[2**53 + 1, p]
        assert np.searchsorted(order, x, "left") / len(v) <= p + 0.02 and np.searchsorted(order, x, "right") / len(v) >= p - 0.02
    assert got[None, 0.5] == 4.0 and (2**53, 0.5) not in got and len(got) == 2 * len(probs)
    assert len(ranktests.quantile_sketch(df, "v", [0.5]).collect()) == 1


def test_bucketed_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = tables.colocated(spark.range(1000).select((F.col("id") % 50).alias("k"), "id"), "estimand_left_test", "k", 4)
        right = tables.colocated(spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "estimand_right_test", "k", 4)
        joined = left.join(right, "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.where("v = 2 * k").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
        for name in ("estimand_left_test", "estimand_right_test"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("parts", [1, 60])
def test_histograms_do_not_depend_on_partitions(spark, parts):
    rng = np.random.default_rng(9)
    v = np.concatenate([rng.normal(0, 100, 20_000), np.full(5_000, -3.5), [1e6, np.inf, np.nan]])
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "v": v})).unionByName(spark.createDataFrame([(None, 2.0), (None, 2.0), ("z", None)], "k string, v double")).repartition(parts)
    got = ranktests.histogram(df, "v", 50, ["k"]).collect()
    own = sorted((r.low, r.high, r.rows) for r in got if r.k == "a")
    fin = v[np.isfinite(v)]
    width = next(w for w in (2.0**e for e in range(-40, 40)) if len(np.unique(np.floor(fin / w))) <= 50)
    index, count = np.unique(np.floor(fin / width), return_counts=True)
    assert own == [(i * width, (i + 1) * width, c) for i, c in zip(index, count)]
    assert [(r.low, r.rows) for r in got if r.k is None] == [(2.0, 2)] and {r.k for r in got} == {"a", None}
    assert sum(r.rows for r in ranktests.histogram(df, "v", 2).collect()) == len(fin) + 2


def test_grouped_statistics_at_their_edges(spark):
    from estimand.operators import srm
    from estimand.operators.groupset import group_set

    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), (None, "x", 1.0), (None, "y", 3.0), (None, "z", 1.0)], "k string, g string, v double")
    out = {(r.k, r.groupname): r for r in srm.srm_grouped(df, "v", "g", [1, 1], ["k"]).collect()}
    assert out["a", "x"].chisquare == pytest.approx(1 / 3) and out[None, "z"].chisquare is None and out[None, "x"].message
    sets = {(r.k, r.group_key, r.treatment): r.cnt for r in group_set(df.withColumn("t", F.lit(1)), "v", "t", ["g"], by=["k"]).collect()}
    assert sets["a", "x", 1] == 1 and sets[None, "z", 0] == 0 and len(sets) == 10
    rows = spark.createDataFrame([("s", 1.0, 1.0), ("s", 1.0, 2.0), *[("f", float(i % 7), float(i)) for i in range(30)]], "k string, x double, y double")
    fits = regress.ols_sandwich_grouped(rows, "y ~ x", ["k"])
    one = regress.ols_sandwich(rows.where("k = 'f'"), "y ~ x").select("term", "estimate", "std_error").collect()
    for a, b in zip(fits.where("k = 'f'").collect(), one):
        assert a.term == b.term and a.estimate == pytest.approx(b.estimate) and a.std_error == pytest.approx(b.std_error)
    assert [r.estimate for r in fits.where("k = 's'").collect()] == [None]
