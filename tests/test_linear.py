"""Linear fits of all folds, strengths and shares in the same passes."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import linear as L
from tessera.operators import models as MD
from tessera.operators.folds import hash_fraction, kfold


def table(spark, n=400, d=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1.0, 3.0, 0.2][:d]
    y = (x @ [0.8, -0.3, 2.0][:d] + 0.5 + rng.logistic(size=n) > 0).astype(float)
    rows = [(i, [float(v) for v in a], float(t), float(1 + i % 3)) for i, (a, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, v array<double>, target double, weight double").repartition(5)
    return kfold(df.withColumn("features", array_to_vector("v")), "id", 4, seed=3)


def rows_of(df):
    return [(r.id, np.array(r.v), r.target, r.weight, r.fold) for r in df.collect()]


def test_ridge_solves_the_normal_equations_of_every_fit(spark):
    df = table(spark)
    share = F.when(hash_fraction(1, "id") < 0.5, 0).otherwise(1)
    fits = [L.Fit(a, f, s) for a in (0.1, 50.0) for f in (None, 0, 3) for s in (0, 1)]
    got = L.fit_all("ridge", df, fits, weight="weight", fold="fold", share=share)
    rows = [(r.id, np.array(r.v), r.target, r.weight, r.fold, r.s) for r in df.withColumn("s", share).collect()]
    for fit, b in zip(fits, got):
        use = [r for r in rows if r[4] != fit.fold and r[5] <= fit.share]
        x = np.array([[*r[1], 1.0] for r in use])
        y, w = np.array([r[2] for r in use]), np.array([r[3] for r in use])
        exact = np.linalg.solve((x * w[:, None]).T @ x + np.diag([fit.strength] * 3 + [0]), (x * w[:, None]).T @ y)
        assert np.allclose(b, exact, rtol=1e-9, atol=1e-11)


def test_logistic_reaches_the_minimum_of_every_fit(spark):
    df = table(spark)
    fits = [L.Fit(c, f) for c in (0.01, 1.0, 1e4) for f in (None, 1)]
    got = L.fit_all("logistic", df, fits, weight="weight", fold="fold")
    rows = rows_of(df)
    for fit, b in zip(fits, got):
        use = [r for r in rows if r[4] != fit.fold]
        x = np.array([[*r[1], 1.0] for r in use])
        y, w = np.array([r[2] for r in use]), np.array([r[3] for r in use])
        slope = x.T @ (w * (1 / (1 + np.exp(-x @ b)) - y)) + np.append(b[:-1] / fit.strength, 0)
        assert np.abs(slope).max() < 1e-5


@pytest.mark.parametrize("est", [MD.logistic(0.5), MD.logistic(0.5, weight="weight"), MD.ridge(2.0)])
def test_batched_scores_equal_single_fits(spark, est):
    df = table(spark)
    test = df.filter("id % 10 = 0").select("id", "features")
    scores = MD.oof_scores(df, test, est, "id")
    assert scores.columns == ["id", "model", "fold", "split", "score"]
    got = {(r.id, r.fold, r.split): r.score for r in scores.collect()}
    assert len(got) == 400 + 4 * 40
    for f in (0, 2):
        m = est.fit(df.filter(F.col("fold") != f))
        for split, part in (("oof", df.filter(F.col("fold") == f)), ("test", test)):
            for r in MD.score(m, part, "id").collect():
                assert abs(got[r.id, f, split] - r.score) < 2e-4


def test_grid_and_curves_equal_one_by_one(spark):
    df = table(spark)

    def alone(est):
        """The estimator without the batched path."""
        return MD.PerRows(est.make, est.weight)

    def make(C):
        return MD.logistic(C)

    df = df.withColumn("fold", F.col("fold") % 2)
    grid = {"C": [0.05, 5.0]}
    a = MD.grid_search(df, make, grid, "id").orderBy("params").collect()
    b = MD.grid_search(df, lambda C: alone(make(C)), grid, "id").orderBy("params").collect()
    assert [(r.params, r["rank"]) for r in a] == [(r.params, r["rank"]) for r in b]
    assert np.allclose([r[1:3] for r in a], [r[1:3] for r in b], atol=1e-3)
    curve = MD.validation_curve(df, make, "C", [0.05, 5.0], "id").collect()
    assert [r.valid_score for r in curve] == [r.mean_score for r in a] and all(r.train_score > 0.5 for r in curve)
    part = MD.learning_curve(df, make(1.0), [1.0, 0.4], "id").collect()
    alone_part = MD.learning_curve(df, alone(make(1.0)), [0.4], "id").collect()
    assert [r[0] for r in part] == [1.0, 0.4] and abs(part[1][1] - alone_part[0][1]) < 1e-3


def test_degenerate_rows(spark):
    df = table(spark)
    nulls = df.limit(3).withColumn("target", F.lit(None).cast("double"))
    assert np.allclose(L.fit_all("ridge", df.unionByName(nulls), [L.Fit(1.0)])[0], L.fit_all("ridge", df, [L.Fit(1.0)])[0])
    assert L.fit_all("logistic", df.limit(0), [L.Fit(1.0)]) == [None] and L.fit_all("ridge", df.limit(0), [L.Fit(1.0)]) == [None]
    one = L.fit_all("logistic", df.filter("target = 1"), [L.Fit(1.0)])[0]     # one class only
    assert one is not None and np.isfinite(one).all() and one[-1] > 5
    flat = df.withColumn("features", array_to_vector(F.array(F.lit(0.0), F.lit(1.0))))
    assert np.isfinite(L.fit_all("logistic", flat, [L.Fit(1.0)])[0]).all() and np.isfinite(L.fit_all("ridge", flat, [L.Fit(0.0)])[0]).all()


def test_a_pass_does_not_grow_with_the_partitions_on_the_driver(spark):
    """Sums of many partitions come together sixteen at a time."""
    df = table(spark).repartition(40)
    plan_rows = L.fit_all("ridge", df, [L.Fit(1.0)])[0]
    assert np.allclose(plan_rows, L.fit_all("ridge", df.coalesce(1), [L.Fit(1.0)])[0], rtol=1e-9)
