"""Resampled order statistics and distinct counts."""

import numpy as np
import pandas as pd
import pytest

from estimand.operators import bootstrap as bs


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"v": np.append(rng.integers(0, 60, 300), [17] * 150).astype(float), "f": rng.integers(0, 3, 450)})
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("statistic,p", [("quantile", 0.5), ("quantile", 0.9), ("min", 0.5), ("max", 0.5), ("distinct", 0.5)])
def test_replicates_follow_the_resampling_distribution(sample, statistic, p):
    """Small blocks, several to a super-block: the mean over replicates is that of plain resampling."""
    pdf, df = sample
    got = bs.bootstrap_values(df, statistic, "v", 90, 600, p, seed=3, rows_per_block=20).toPandas()
    rng = np.random.default_rng(1)
    fn = {"quantile": lambda x: np.quantile(x, p), "min": np.min, "max": np.max, "distinct": lambda x: len(np.unique(x))}[statistic]
    plain = np.array([fn(rng.choice(pdf.v.to_numpy(), 90)) for _ in range(4000)])
    assert len(got) == 600 and (got.n == 90).all()
    assert abs(got.result.mean() - plain.mean()) <= 5 * plain.std() / np.sqrt(600) + 1e-9
    assert got.result.std() == pytest.approx(plain.std(), rel=0.25)


def test_a_filter_applies_after_resampling(sample):
    pdf, df = sample
    got = bs.bootstrap_values(df, "distinct", "v", 1.0, 200, seed=3, where="f = 0", rows_per_block=20).toPandas()
    share = (pdf.f == 0).mean()
    assert abs(got.n.mean() - 450 * share) < 5 * np.sqrt(450 * share * (1 - share) / 200)
    assert (got.result <= pdf[pdf.f == 0].v.nunique()).all() and got.n.nunique() > 1


def test_draws_do_not_depend_on_partitions(spark, sample):
    _, df = sample
    runs = []
    for parts in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        runs.append(sorted(map(tuple, bs.bootstrap(df.repartition(parts), "quantile", 1.0, 9, args=["v", 0.4], seed=6).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert runs[0] == runs[1]


def test_text_values_and_nothing_left(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), (None, 1)], "v string, f int")
    assert [r.n for r in bs.bootstrap_values(df, "distinct", "v", 5, 3).collect()] == [5, 5, 5]
    assert bs.bootstrap_values(df, "distinct", "v", 5, 3, where="f = 1").count() == 0
    with pytest.raises(ValueError):
        bs.bootstrap_values(df.where("v is null"), "distinct", "v", 5, 3)
