"""Operators on small frames against brute force, with skewed groups."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from estimand.functions import columns as fx
from estimand.operators import bootstrap as bs
from estimand.operators import dml, iv, ks, matching, matrix, penalized, ranktests, regress, series, tree, ttest, uplift
from estimand.operators import events as ev
from estimand.operators import xexpt
from estimand.operators.groupset import group_set
from estimand.plans.prefix import prefix_sum
from estimand.plans.ranks import ranked


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    n = 4000
    x1, x2 = rng.normal(3, 1, n), rng.integers(0, 6, n).astype(float)
    t = rng.integers(0, 2, n)
    pdf = pd.DataFrame({
        "id": np.arange(n), "x1": x1, "x2": x2, "t": t, "w": rng.uniform(0.5, 2, n),
        "y": 2 * x1 - x2 + t * (1 + x2) + rng.normal(0, 1, n),
        # one group holds a third of the rows
        "g": np.where(rng.random(n) < 0.34, 0, rng.integers(1, 40, n)),
    })
    df = spark.createDataFrame(pdf).repartition(8, "id").cache()
    df.count()
    return df, pdf


# ---- hashing, bins ----

def murmur(x, seed=0):
    m = 0xFFFFFFFF
    rot = lambda a, r: ((a << r) | (a >> (32 - r))) & m
    k = rot((x & m) * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
    h = (rot(seed ^ k, 13) * 5 + 0xE6546B64) & m
    h ^= 4
    h = (h ^ (h >> 16)) * 0x85EBCA6B & m
    h = (h ^ (h >> 13)) * 0xC2B2AE35 & m
    return h ^ (h >> 16)


def test_murmur_bucket(spark):
    values = [0, 1, -1, 7, 123456789, 2**31 - 1, -(2**31), 2**31, 2**32 + 5, -(2**40) - 3]
    got = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", fx.murmur_bucket("v").alias("b")).collect()
    assert {r["v"]: r["b"] for r in got} == {v: murmur(v) >> 25 for v in values}


def test_bin_labels():
    assert fx.bin_labels([5, 1.5, 5]) == ["[-inf,1.5)", "[1.5,5.0)", "[5.0,inf)"]


# ---- t-tests, report ----

def test_nulls_are_complete_case(spark):
    rows = [(1.0, 2.0, 0), (None, 3.0, 0), (4.0, None, 1), (2.0, 1.0, 1), (5.0, 2.0, 1), (3.0, 4.0, 0), (1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, g int")
    full = df.dropna()
    a = ttest.ttest_2samp(df, "avg(a)/avg(b)", "g").first()
    assert a == ttest.ttest_2samp(full, "avg(a)/avg(b)", "g").first()


def test_missing_arm(spark, sample):
    df, _ = sample
    with pytest.raises(Exception, match="at least 2 groups"):
        ttest.ttest_2samp(df.where("t = 0"), "avg(y)", "t").collect()
    rows = ttest.ttest_2samp(df.where("t = 0 or g = 1"), "avg(y)", "t", by=["g"]).collect()
    assert all((r["estimate"] is not None) == (r["g"] == 1) for r in rows)
    with pytest.raises(ValueError):
        ttest.ttest_2samp(df, "avg(y)", "t", "sideways")


def test_xexpt_needs_two_groups(sample):
    df, _ = sample
    with pytest.raises(Exception, match="exactly two groups"):
        xexpt.xexpt_ttest_2samp(df, ["y", "w"], "id", "id % 3").collect()
    row = xexpt.xexpt_ttest_2samp(df, ["y", "w"], "id", F.when(F.col("t") == 1, "b").otherwise("a")).first()
    assert (row["group0"], row["group1"]) == ("a", "b")


def test_group_set_counts(sample):
    df, pdf = sample
    out = group_set(df, "y", "t", ["g", "cast(x2 as int)"]).toPandas()
    assert out.groupby("name")["cnt"].sum().eq(len(pdf)).all()
    assert set(out["name"]) == {"col1", "col2"} and (out.groupby(["name", "group_key"]).size() == 2).all()


# ---- regression ----

def test_noiseless_ols(sample):
    df, _ = sample
    exact = df.withColumn("z", 1.5 + 2 * F.col("x1") - 3 * F.col("x2"))
    est = {r["term"]: r["estimate"] for r in regress.ols(exact, "z ~ x1 + x2").collect()}
    assert est == pytest.approx({"(Intercept)": 1.5, "x1": 2.0, "x2": -3.0}, abs=1e-9)


def test_collinear(sample):
    df, _ = sample
    twin = df.withColumn("x3", F.col("x1") * 2)
    with pytest.raises(ValueError, match="collinear"):
        regress.fit_linear(twin, "y ~ x1 + x3")
    assert all(r["estimate"] is None for r in regress.ols(twin, "y ~ x1 + x3", by=["t"]).collect())


def test_given_sandwich_matrices(sample):
    df, _ = sample
    robust = {r["term"]: r["std_error"] for r in regress.ols_sandwich(df, "y ~ x1 + x2").collect()}
    design = ["x1", "x2", "1.0"]
    a = [r["values"] for r in matrix.matrix_multiplication(df, design, inverse=True).orderBy("row_index").collect()]
    model = regress.fit_linear(df, "y ~ x1 + x2")
    b = regress.score_products(df, [fx.as_double(c) for c in design], F.col("y") - model.column())
    got = {r["term"]: r["std_error"] for r in regress.ols(df, "y ~ x1 + x2", xx_inverse=a, xx_weighted=b).collect()}
    assert got == pytest.approx(robust, rel=1e-9)


@pytest.mark.parametrize("by", [[], ["x2", "label"]])
def test_wide_moments_match_native(sample, monkeypatch, by):
    from estimand.plans import moments as pm

    df, _ = sample
    df = df.withColumn("label", F.when(F.col("id") % 5 != 0, (F.col("id") % 3).cast("string")))
    cols = ["y", "x1", "x1 * w", "if(id % 50 = 0, null, w)", "y + w"]
    native = {k: m for k, m in pm.collect_moments(df.dropna(subset=["label"]), cols, by).items()}
    monkeypatch.setattr(pm, "NATIVE_COLUMNS", 2)
    wide = pm.collect_moments(df.dropna(subset=["label"]), cols, by)
    assert set(wide) == set(native)
    for k in native:
        assert wide[k].n == native[k].n
        np.testing.assert_allclose(wide[k].mean, native[k].mean, rtol=1e-10)
        np.testing.assert_allclose(wide[k].comoment, native[k].comoment, rtol=1e-8, atol=1e-8)
    if by:
        # a null group key stays a group
        assert len(pm.moments(df, cols, by).collect()) > len(native)


def test_wide_regression(spark):
    rng = np.random.default_rng(21)
    k = 20
    x = rng.normal(100, 1, (3000, k))
    beta = rng.normal(0, 1, k)
    pdf = pd.DataFrame(x, columns=[f"v{i}" for i in range(k)])
    pdf["y"] = x @ beta + 3 + rng.normal(0, 0.1, 3000)
    df = spark.createDataFrame(pdf).repartition(5)
    model = regress.fit_linear(df, "y ~ " + " + ".join(pdf.columns[:-1]))
    want = np.linalg.lstsq(np.c_[x, np.ones(3000)], pdf.y, rcond=None)[0]
    np.testing.assert_allclose(model.fit.coef, want, rtol=1e-6)
    design = np.c_[x, np.ones(3000)]
    e = pdf.y.to_numpy() - design @ want
    middle = regress.score_products(df, model._design(None), F.col("y") - model.column())
    np.testing.assert_allclose(middle, (design * e[:, None]).T @ (design * e[:, None]), rtol=1e-5)
    rows = matrix.matrix_multiplication(df, list(pdf.columns[:-1])).orderBy("row_index").collect()
    np.testing.assert_allclose([r["values"] for r in rows], x.T @ x, rtol=1e-10)


def test_negative_weight(sample):
    df, _ = sample
    with pytest.raises(Exception, match="non-negative"):
        regress.wls(df, "y ~ x1", "w - 1").collect()


def test_iv_matches_two_steps(sample):
    df, pdf = sample
    got = {r["term"]: r["estimate"] for r in iv.iv_2sls(df, "y ~ (x1 ~ (x1 + w)) + (t ~ (t + x1)) + x2").collect()}
    one, lstsq = np.ones(len(pdf)), lambda a, b: np.linalg.lstsq(a, b, rcond=None)[0]
    s1, s2 = np.c_[pdf.x1 + pdf.w, pdf.x2, one], np.c_[pdf.t + pdf.x1, pdf.x2, one]
    design = np.c_[s1 @ lstsq(s1, pdf.x1), s2 @ lstsq(s2, pdf.t), pdf.x2, one]
    want = dict(zip(["x1", "t", "x2", "(Intercept)"], lstsq(design, pdf.y)))
    assert got == pytest.approx(want, rel=1e-6)


# ---- penalized ----

def test_zero_penalty_is_ols(sample):
    df, _ = sample
    ols = regress.fit_linear(df, "y ~ x1 + x2").fit.coef
    for model in (penalized.sgd_linear(df, "y ~ x1 + x2", l2=0.0), penalized.lasso(df, "y ~ x1 + x2", 0.0)):
        np.testing.assert_allclose(model.coef, ols, rtol=1e-6)


@pytest.mark.parametrize("shrink_bias", [True, False])
def test_lasso_optimality(sample, shrink_bias):
    df, pdf = sample
    penalty = 1.5
    c = penalized.lasso(df, "y ~ x1 + x2", penalty, shrink_bias).coef
    x = np.c_[pdf.x1, pdf.x2, np.ones(len(pdf))]
    g = 2 * x.T @ (pdf.y - x @ c) / len(pdf)
    limit = np.array([penalty, penalty, penalty if shrink_bias else 0.0])
    for gi, ci, li in zip(g, c, limit):
        assert gi == pytest.approx(li * np.sign(ci), abs=1e-6) if ci else abs(gi) <= li + 1e-6


def test_lasso_rule_reaches_the_same_point(sample):
    df, _ = sample
    a = penalized.lasso(df, "y ~ x1 + x2", 0.4).coef
    b = penalized.sgd_linear(df, "y ~ x1 + x2", lr=0.02, l2=0.4, optimizer="Lasso", iterations=20_000).coef
    np.testing.assert_allclose(a, b, atol=1e-6)


def test_logistic_gradient_vanishes(sample):
    df, pdf = sample
    m = penalized.sgd_logistic(df, "t ~ y + x1", l2=0.01)
    x = np.c_[pdf.y, pdf.x1, np.ones(len(pdf))]
    p = 1 / (1 + np.exp(-x @ m.coef))
    g = x.T @ (pdf.t - p) / len(pdf) - np.array([0.02, 0.02, 0]) * m.coef
    assert np.abs(g).max() < 1e-7
    rule = penalized.sgd_logistic(df, "t ~ y + x1", l2=0.01, optimizer="Adam", lr=0.1, iterations=40)
    assert np.sign(rule.coef[0]) == np.sign(m.coef[0])


# ---- order: KS, ranks, quantiles, prefix sums ----

def test_prefix_sum(sample):
    df, pdf = sample
    got = prefix_sum(df.select("id", "w"), [F.col("w").desc(), "id"], ["w"]).toPandas().set_index("id")["w_before"]
    ordered = pdf.sort_values(["w", "id"], ascending=[False, True])
    want = pd.Series(ordered.w.cumsum() - ordered.w, dtype=float)
    np.testing.assert_allclose(got.loc[ordered.id].to_numpy(), want.to_numpy(), atol=1e-6)


@pytest.mark.parametrize("hot_rows", [10**6, 200])
def test_ranked_hot_groups(sample, hot_rows):
    df, pdf = sample
    got = ranked(df.select("id", "g", "x2"), ["g"], ["x2"], ["id"], hot_rows).toPandas().set_index("id")["rank"]
    want = pdf.sort_values(["g", "x2", "id"]).groupby("g").cumcount() + 1
    assert (got.sort_index().to_numpy() == want.sort_index().to_numpy()).all()


@pytest.mark.parametrize("column", ["x1", "x2"])
def test_ks_brute(sample, column):
    df, pdf = sample
    a, b = pdf[column][pdf.t == 0], pdf[column][pdf.t == 1]
    grid = np.unique(pdf[column])
    gap = np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / len(b)
    for alternative, want in (("two-sided", np.abs(gap).max()), ("less", -gap.min()), ("greater", gap.max())):
        assert ks.ks_test(df, column, "t", alternative).first()["d_statistic"] == pytest.approx(want, abs=1e-12)


def test_ks_empty(sample):
    with pytest.raises(ValueError, match="non-empty"):
        ks.ks_test(sample[0].where("t = 0"), "x1", "t")


def test_exact_quantiles(sample):
    df, pdf = sample
    got = {r["p"]: r["value"] for r in ranktests.exact_quantiles(df, "x2", [0, 0.1, 0.5, 0.77, 1]).collect()}
    assert got == pytest.approx({p: np.quantile(pdf.x2, p) for p in (0, 0.1, 0.5, 0.77, 1)})


# ---- matching ----

@pytest.mark.parametrize("hot_rows", [10**6, 100])
def test_matching_properties(spark, sample, hot_rows):
    df, pdf = sample
    df = df.withColumn("arm", F.when(F.col("t") == 1, 1).when(F.col("id") % 10 != 0, -1))
    df = df.withColumn("label", F.when(F.col("id") % 7 != 0, F.col("g")))
    out = matching.exact_matching(df, "arm", ["label"], ["id"], seed=3, hot_rows=hot_rows).toPandas()
    assert len(out) == len(pdf) and (out.match_index[out.label.isna() | out.arm.isna()] == 0).all()
    used = out[out.match_index != 0]
    assert ((used.match_index > 0) == (used.arm == 1)).all()
    pairs = used.groupby(used.match_index.abs())
    assert (pairs.size() == 2).all() and (pairs["match_index"].sum() == 0).all() and (pairs["label"].nunique() == 1).all()
    assert sorted(pairs.groups) == list(range(1, len(pairs) + 1))
    by = out.dropna(subset=["label", "arm"]).groupby("label")["arm"]
    assert len(pairs) == by.apply(lambda a: min((a == 1).sum(), (a == -1).sum())).sum()


def test_caliper_order(spark):
    rows = [(i, 1 if i % 3 == 0 else -1, (i * 37 % 100) / 100) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, arm int, score double")
    pairs = matching.matched_pairs(matching.caliper_matching(df, "arm", "score", 4, ["id"]), "id").collect()
    pdf = pd.DataFrame(rows, columns=["id", "arm", "score"])
    pdf["bin"] = (pdf.score * 4).astype(int)
    pdf["rn"] = pdf.sort_values(["score", "id"]).groupby(["bin", "arm"]).cumcount()
    want = pdf[pdf.arm == 1].merge(pdf[pdf.arm == -1], on=["bin", "rn"])
    assert {(r["treated"], r["control"]) for r in pairs} == set(zip(want.id_x, want.id_y))


# ---- bootstrap ----

@pytest.mark.parametrize("rows_per_bucket", [250_000, 3])
def test_bootstrap_exact_size(sample, rows_per_bucket):
    df, pdf = sample
    run = lambda: bs.bootstrap_moments(df, ["y", "x2"], 12345, 6, seed=9, rows_per_bucket=rows_per_bucket).toPandas()
    a, b = run().sort_values("replicate"), run().sort_values("replicate")
    assert (a.n == 12345).all() and len(a) == 6
    assert [list(m) for m in a["mean"]] == [list(m) for m in b["mean"]]
    means = np.array([m[0] for m in a["mean"]])
    se = pdf.y.std() / np.sqrt(12345)
    assert np.abs(means - pdf.y.mean()).max() < 6 * se and means.std() > 0.2 * se


def test_bootstrap_hot_row(spark):
    # one distinct row holds 90 percent of the table
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id") % 100).otherwise(7).cast("double").alias("v"))
    out = bs.bootstrap(df, "sum", 1.0, 40, args=["v"], seed=4).toPandas()
    truth = df.agg(F.sum("v")).first()[0]
    sd = df.agg(F.stddev_pop("v")).first()[0] * np.sqrt(20_000)
    assert (out.n == 20_000).all() and abs(out.result.mean() - truth) < 5 * sd / np.sqrt(40)
    assert 0.6 * sd < out.result.std() < 1.6 * sd


def test_bootstrap_arguments(sample):
    df, _ = sample
    for bad in (dict(bs_num=0), dict(sample=1.5), dict(sample=-1)):
        with pytest.raises(ValueError):
            bs.bootstrap(df, "avg", **{"sample": 10, "bs_num": 2, "args": ["y"], **bad})


# ---- double machine learning, uplift ----

def test_linear_dml_recovers_effect(sample):
    df, pdf = sample
    model = dml.LinearDML("y", "t", ["x2"], ["x1"], key=["id"], cv=4, seed=1).fit(df)
    est = {r["term"]: r["estimate"] for r in model.summary().collect()}
    assert est == pytest.approx({"x2": 1.0, "cate_intercept": 1.0}, abs=0.15)
    row = model.effect_interval(df.where("x2 = 2")).first()
    assert row["lower"] < row["fit"] < row["upper"]
    assert model.ate(df).first()["ate"] == pytest.approx(1 + pdf.x2.mean(), abs=0.1)
    lasso = dml.LinearDML("y", "t", ["x2"], ["x1"], "lasso", "lasso", key=["id"], penalty=1e-9).fit(df)
    assert lasso.fit_result.coef == pytest.approx(dml.LinearDML("y", "t", ["x2"], ["x1"], key=["id"]).fit(df).fit_result.coef, rel=1e-4)


def test_dml_featurized_treatment(spark):
    rng = np.random.default_rng(8)
    n = 6000
    x, d = rng.normal(0, 1, n), rng.uniform(0, 2, n)
    y = (1 + x) * d + 0.5 * d**2 + rng.normal(0, 0.1, n)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x, "d": d, "y": y}))
    model = dml.LinearDML("y", "d", ["x"], key=["id"], treatment_featurizer=fx.poly_features("d", 2)).fit(df)
    got = model.effect(df, 1, 2).select("x", "effect").toPandas()
    # d^2 carries no x-dependence, d carries 1 + x; nuisances are linear only
    np.testing.assert_allclose(got.effect, (1 + got.x) + 1.5, atol=0.3)
    const = model.const_marginal_effect(df).select("effect_1", "effect_2").toPandas()
    marginal = model.marginal_effect(df).select("effect").toPandas()
    np.testing.assert_allclose(const.effect_1 + const.effect_2, marginal.effect)


def test_lift_curve_ties(sample):
    df, pdf = sample
    got = uplift.lift_gain_curve(df, "x2", "y", "t", ["id"], k=50).orderBy("ratio").toPandas()
    o = pdf.sort_values(["x2", "id"], ascending=[False, True]).reset_index(drop=True)
    bucket = (np.arange(len(o)) * 50 // len(o))
    last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
    y1, y0 = (o.y * o.t).cumsum(), (o.y * (1 - o.t)).cumsum()
    n1, n0 = o.t.cumsum(), (1 - o.t).cumsum()
    np.testing.assert_allclose(got.lift, (y1 / n1 - y0 / n0)[last], rtol=1e-9)
    np.testing.assert_allclose(got.gain, (y1 - y0 / n0 * n1)[last], rtol=1e-9)
    slope = uplift.lift_gain_curve(df, "x2", "y", "x1", ["id"], k=10, discrete=False).orderBy("ratio").toPandas()
    assert slope.lift.iloc[-1] == pytest.approx(np.cov(pdf.y, pdf.x1)[0, 1] / pdf.x1.var())


# ---- tree ----

def brute_best(pdf, feats, total, n_node, impurity, ratio):
    def e(d):
        a, b = d.y[d.t == 1], d.y[d.t == 0]
        tau, n = a.mean() - b.mean(), len(d)
        return 0.5 * tau**2 * n - n * (a.var(ddof=0) / len(a) + b.var(ddof=0) / len(b))

    best = None
    for f in sorted(feats):
        tau = pdf.groupby(f).apply(lambda d: d.y[d.t == 1].mean() - d.y[d.t == 0].mean())
        order = sorted(tau.index, key=lambda v: (-tau[v], str(v)))
        for i in range(1, len(order)):
            left = pdf[pdf[f].isin(order[:i])]
            right = pdf[~pdf[f].isin(order[:i])]
            if (left.t == 0).sum() <= 100 or (left.t == 1).sum() <= 100:
                continue
            if len(left) <= ratio * total or n_node - len(left) <= ratio * total:
                continue
            gain = e(left) + e(right) - (e(pdf) if impurity is None else impurity)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, set(map(str, order[:i])), e(left), e(right))
    return best


@pytest.mark.parametrize("collapse", [1e-9, 1e9])
def test_tree_against_brute_force(sample, monkeypatch, collapse):
    df, pdf = sample
    # both the collapsed and the row-level plan must give the same tree
    monkeypatch.setattr(tree, "COLLAPSE_FACTOR", collapse)
    df = df.withColumns({"a": F.col("x2").cast("int"), "b": F.col("id") % 5})
    pdf = pdf.assign(a=pdf.x2.astype(int), b=pdf.id % 5)
    model = tree.CausalTree(2, 0.01).fit(df, "y", "t", ["a", "b"], split="cast(floor(id / 5) % 2 as int)")
    train = pdf[(pdf.id // 5) % 2 == 0]
    root = brute_best(train, ["a", "b"], len(train), len(train), None, 0.01)
    got = model.nodes_by_id[1]
    assert got.feature == root[1] and set(got.left_values) == root[2] and got.gain == pytest.approx(root[0], rel=1e-6)
    for child, impurity, rows in ((2, root[3], train[train[root[1]].astype(str).isin(root[2])]),
                                  (3, root[4], train[~train[root[1]].astype(str).isin(root[2])])):
        want = brute_best(rows, ["a", "b"], len(train), len(rows), impurity, 0.01)
        node = model.nodes_by_id[child]
        assert (node.feature is None) == (want is None)
        if want:
            assert node.feature == want[1] and node.gain == pytest.approx(want[0], rel=1e-6)
    # honest estimates come from the other half only, leaves partition it
    nodes = model.nodes().toPandas()
    leaves = nodes[nodes.is_leaf]
    assert (leaves.treated_count + leaves.control_count).sum() == ((pdf.id // 5) % 2 == 1).sum()
    scored = model.effect(df).select("a", "b", "effect").toPandas()
    assert scored.effect.notna().all() and set(scored.effect.round(9)) <= set(leaves.prediction.round(9))


def test_tree_edges_are_exact(spark):
    # 70,001 values in shuffled order: more than a sketch of 10,000 holds
    df = spark.range(70_001).select((F.col("id") * 7919 % 70_001).cast("double").alias("a"), F.expr("if(id % 5 = 0, null, id % 7)").alias("b"), F.lit(None).cast("int").alias("c"))
    pdf = df.toPandas()
    want = {c: sorted(set(np.quantile(pdf[c].dropna().astype(float), tree.TREE_QUANTILES, method="inverted_cdf"))) for c in ("a", "b")}
    for parts in (1, 5):
        assert tree.CausalTree()._edges(df.repartition(parts), ["a", "b", "c"]) == {**want, "c": [0.0]}
    assert tree.CausalTree()._edges(df.limit(0), ["a"]) == {"a": [0.0]}


def test_tree_null_features_and_validation(spark, sample):
    df, _ = sample
    df = df.withColumn("a", F.when(F.col("id") % 9 != 0, F.col("x2").cast("int")))
    model = tree.CausalTree(1).fit(df, "y", "t", ["a"], key=["id"])
    assert model.effect(df).where("a is null and effect is not null").count() == 0
    assert model.effect(df, default=4294967295).where("effect = 4294967295").count() == df.where("a is null").count()
    for bad in (dict(Y=""), dict(T="x2"), dict(X=["nope"]), dict(X=[])):
        with pytest.raises(ValueError):
            tree.CausalTree(1).fit(df, **{"Y": "y", "T": "t", "X": ["a"], "key": ["id"], **bad})
    text = df.withColumn("s", F.lit("a"))
    with pytest.raises(ValueError, match="numeric"):
        tree.validate_inputs(text, "s", "t", ["a"])
    with pytest.raises(ValueError, match="0 and 1"):
        tree.validate_inputs(df.where("t = 1"), "y", "t", ["a"])


# ---- series, events ----

@pytest.mark.parametrize("hot_rows", [10**6, 50])
def test_moving_blocks(sample, hot_rows):
    df, pdf = sample
    got = series.moving(df, "y", 7, ["w"], ["g"], ["id"], "sum", hot_rows).toPandas().set_index("id")["moving_sum"]
    want = pdf.sort_values(["g", "w", "id"]).groupby("g")["y"].rolling(7, min_periods=1).sum().droplevel(0)
    np.testing.assert_allclose(got.sort_index(), want.sort_index(), atol=1e-9)


def test_delta_sum_across_partitions(spark, sample):
    df, pdf = sample
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = series.delta_sum(df, "y", ["id"], ["g"]).toPandas().set_index("g")["delta_sum"]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = pdf.sort_values("id").groupby("g")["y"].apply(lambda v: v.diff().clip(lower=0).sum())
    np.testing.assert_allclose(got.sort_index(), want.sort_index(), atol=1e-9)


def greedy_level(codes, k):
    level = 0
    for c in codes:
        level += level < k and c == level + 1
    return level


def test_sequence_across_partitions(spark, sample):
    df, pdf = sample
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "29")
    steps = [f"id % 83 = {i}" for i in range(4)]
    try:
        got = ev.sequence_match(df, "g", "w", steps, ["id"]).toPandas().set_index("g")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    code = pdf.assign(c=pdf.id % 83 + 1)
    code = code[code.c <= 4].sort_values(["g", "w", "id"])
    want = code.groupby("g")["c"].apply(lambda c: greedy_level(c, 4))
    assert got["level"].to_dict() == want.to_dict() and (got["matched"] == (got["level"] == 4)).all()


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_funnel_brute(spark, slices):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": np.arange(1500), "u": np.where(rng.random(1500) < 0.4, 0, rng.integers(1, 60, 1500)),
                        "s": rng.integers(0, 20_000, 1500), "e": rng.integers(1, 5, 1500)})
    window, steps = 400, ["e = 1", "e in (2, 3)", "e = 3"]
    got = ev.window_funnel(spark.createDataFrame(pdf), "u", "s", window, steps, ["id"], slices).toPandas()
    match = {1: [1], 2: [2], 3: [2, 3], 4: []}

    def level(d):
        d = d.sort_values(["s", "id"])
        rows, best = list(zip(d.s, d.e)), 0
        for i, (s, e) in enumerate(rows):
            if e != 1:
                continue
            at = 1
            for s2, e2 in rows[i + 1:]:
                if s2 > s + window or at == 3:
                    break
                at += at + 1 in match[e2]
            best = max(best, at)
        return best

    want = pdf.groupby("u")[["id", "s", "e"]].apply(level)
    assert got.set_index("u")["level"].to_dict() == want.to_dict()


def test_interval_depth(spark):
    rng = np.random.default_rng(12)
    s = rng.integers(0, 3000, 400)
    e = s + rng.integers(1, 20, 400)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "e": e}))
    cover = np.zeros(3100, dtype=int)
    for a, b in zip(s, e):
        cover[a:b] += 1
    row = series.max_intersections(df, "s", "e").first()
    assert row["max_intersections"] == cover.max() and row["position"] == cover.argmax()
    assert series.interval_length_sum(df, "s", "e").first()[0] == (cover > 0).sum()
