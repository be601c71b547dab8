"""Edges where groups, keys or columns once went wrong."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estimand.operators import dml, iv, ks, matching, matrix, regress, series, srm, tree, ttest
from estimand.operators.groupset import group_set
from estimand.plans.moments import Moments


@pytest.mark.parametrize("parts", [1, 7])
def test_ks_same_for_any_partitioning(spark, parts):
    df = spark.range(2000).select((F.col("id") * 4e-8).alias("v"), (F.col("id") >= 1000).cast("int").alias("s"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert ks.ks_test(df, "v", "s").first()["d_statistic"] == 1.0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ks_exact_raises_beyond_its_work():
    with pytest.raises(ValueError, match="exact"):
        ks.ks_p_value(0.1, 10**6, 10**6, method="exact")


def test_whole_number_keys_stay_exact_beside_null(spark):
    df = spark.createDataFrame([(k, float(i), float(i * i)) for k in (2**53 + 1, 2**53 + 2, None) for i in range(6)], "g bigint, x double, y double")
    assert {r["g"] for r in regress.ols(df, "y ~ x", by=["g"]).collect()} == {2**53 + 1, 2**53 + 2, None}


def test_matching_keeps_a_column_named_rank(spark):
    rows = [(i, i % 2, i % 3, i * 100, -i) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, t int, g int, rank int, position int")
    for hot in (5, 10**6):
        got = matching.exact_matching(df, "t", ["g"], ["id"], treated_value=1, control_value=0, hot_rows=hot).collect()
        assert sorted((r["id"], r["rank"], r["position"]) for r in got) == [(i, i * 100, -i) for i in range(60)]


def test_singular_group_gives_null_elsewhere_results(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=80)
    pdf = pd.DataFrame({"g": np.repeat(["a", "b"], 40), "y": 2 * x + rng.normal(size=80), "x": x, "z": x + rng.normal(size=80), "i": np.tile([0, 1], 40)})
    pdf.loc[pdf.g == "b", ["x", "z"]] = 1.0
    df = spark.createDataFrame(pdf)
    estimates = {r["g"]: r for r in iv.iv_2sls(df, "y ~ (x ~ z)", by=["g"]).collect()}
    assert set(estimates) == {"a", "b"} and estimates["b"]["estimate"] is None
    tested = {r["g"]: r["estimate"] for r in ttest.ttest_2samp(df, "avg(y)", "i", cuped="avg(x)+avg(z)", by=["g"]).collect()}
    assert tested["a"] is not None and set(tested) == {"a", "b"}
    values = {(r["g"], r["row_index"]): r["values"] for r in matrix.matrix_multiplication(df, ["x", "z"], inverse=True, by=["g"]).collect()}
    assert values["b", 1] is None and len(values["a", 1]) == 2


def test_many_index_values_and_groups(spark):
    df = spark.range(6000).select((F.col("id") % 150).alias("i"), F.rand(1).alias("x"))
    assert ttest.ttests_2samp(df, "avg(x)", "i").count() == 150 * 149 // 2
    found = srm.srm(spark.range(2400).select((F.col("id") % 1200).alias("g"), F.lit(1.0).alias("v")), "v", "g", [1.0] * 1200)
    assert found.count() == 1200
    wrong = srm.srm(spark.range(10).select("id", F.lit(1.0).alias("v")), "v", "id", [1.0, 2.0]).collect()
    assert len(wrong) == 10 and all("number of groups" in r["message"] for r in wrong)


def test_index_must_be_whole(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.5, 2.0), (1.0, 3.0)], "i double, x double")
    with pytest.raises(Exception, match="whole numbers"):
        ttest.ttest_2samp(df, "avg(x)", "i").collect()


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(None, i, float(i % 3)) for i in range(6)] + [("a", i, float(i)) for i in range(4)], "g string, o int, v double")
    assert {r["g"]: r["delta_sum"] for r in series.delta_sum(df, "v", ["o"], ["g"]).collect()} == {None: 4.0, "a": 3.0}


def test_group_set_keys_by_value(spark):
    df = spark.createDataFrame([(1.0, 0, 0.25, "p"), (2.0, 1, 0.5, "q"), (3.0, 0, 0.75, "p")], "y double, t int, f double, s string")
    assert {r["group_key"] for r in group_set(df, "y", "t", ["f", "s"]).collect()} == {"0.25", "0.5", "0.75", "p", "q"}


def test_zero_arm_mean_keeps_its_effect():
    arm = lambda mean: Moments(10, [mean], [9.0])
    out = tree.node_inference(arm(0.0), arm(2.0), 0.0, False)
    assert out["est_point1"] == -2.0 and out["pvalue1"] < 0.05
    assert math.isnan(tree.node_inference(arm(2.0), arm(0.0), 0.0, False)["est_point3"])
