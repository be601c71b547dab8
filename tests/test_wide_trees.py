"""Trees on features of many values, and the quantiles that cut numeric ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estimand.operators import ranktests, tree


def experiment(spark, n, values, seed=4):
    rng = np.random.default_rng(seed)
    city = rng.integers(0, values, n)
    t = rng.integers(0, 2, n)
    kind = rng.integers(0, 3, n)
    y = rng.normal(0, 1, n) + t * np.where(city % 2 == 0, 2.0, 0.0) + t * (kind == 1) * 1.0
    return spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "city": [None if c == 7 else f"c{c}" for c in city], "kind": kind, "t": t, "y": y, "_node": 5, "_value": "own"}))


def test_wide_splits_equal_listed_ones(spark, monkeypatch):
    df = experiment(spark, 20000, 40)
    def fit():
        model = tree.CausalTree(depth=2, min_arm=20).fit(df, "y", "t", ["city", "kind"], key=["id"])
        return model, model.nodes().drop("split_values", "rule").toPandas(), model.effect(df).select("id", "effect").toPandas().sort_values("id")
    _, listed, effects = fit()
    monkeypatch.setattr(tree, "LISTED_VALUES", 5)
    monkeypatch.setattr(tree, "WALKED_VALUES", 10)
    model, wide, again = fit()
    pd.testing.assert_frame_equal(listed, wide, check_exact=False, rtol=1e-9)
    np.testing.assert_allclose(effects.effect.to_numpy(), again.effect.to_numpy(), rtol=1e-9)
    assert model.wide_splits().where("node_id = 1").count() == 39 and "values)" in model.nodes().where("node_id = 2").first()["rule"]
    assert model.effect(df).columns == [*df.columns, "effect"]


def test_a_hundred_thousand_categories(spark):
    """No list of the categories reaches the driver, and the split is that of the effects."""
    df = spark.range(800_000).select(
        "id", F.concat(F.lit("c"), F.col("id") % 100_000).alias("city"), (F.floor(F.col("id") / 100_000) % 2).cast("int").alias("t"),
        (F.floor(F.col("id") / 200_000) % 2).cast("int").alias("half"))
    df = df.withColumn("y", F.col("t") * (F.col("id") % 100_000 % 2) + F.col("id") % 100_000 % 5 / 100 + F.col("id") % 3 / 10)
    model = tree.CausalTree(depth=1).fit(df, "y", "t", ["city"], split="half")
    root = model.nodes_by_id[1]
    assert root.left_values == [] and model.wide_splits().count() == 100_000
    sides = model.wide_splits().groupBy((F.substring("value", 2, 10).cast("int") % 2).alias("odd"), "is_left").count().collect()
    assert {(r.odd, r.is_left) for r in sides} == {(1, True), (0, False)}
    assert model.effect(df).groupBy("effect").count().count() == 2


@pytest.mark.parametrize("rows", [1, 50_000])
def test_discrete_quantiles(spark, monkeypatch, rows):
    """With small sketches and brackets every path is taken; ties, nulls and an empty column."""
    monkeypatch.setattr(ranktests, "SKETCH", 20)
    monkeypatch.setattr(ranktests, "BRACKET_ROWS", rows)
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 5000), "b": rng.integers(0, 4, 5000).astype(float), "c": np.round(rng.exponential(1, 5000), 2)})
    df = spark.createDataFrame(pdf).withColumns({"a": F.when(F.col("b") > 0, F.col("a")), "d": F.lit(None).cast("double")})
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ranktests.discrete_quantiles(df, ["a", "b", "c", "d"], probs)
    for c, own in (("a", pdf.a[pdf.b > 0]), ("b", pdf.b), ("c", pdf.c)):
        order = np.sort(own.to_numpy())
        assert got[c] == [order[max(1, int(np.ceil(len(order) * p))) - 1] for p in probs]
    assert got["d"] == []
