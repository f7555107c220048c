"""Model fitting, validation and ensembling on Spark ML (E4-E22, E24; M10, M11).

Tables in, tables out: every scorer returns ``(key, score)`` rows keyed by the
entity id, never arrays aligned by position. Ridge and logistic models fit all
folds, strengths and training shares in the same passes (``linear``); for other
estimators loops run on the driver over folds, seeds or grid points, each step a
distributed fit or transform. Randomness comes from hashes of (seed, key).
"""

from __future__ import annotations

import itertools
import math

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.folds import hash_fraction, stratified_kfold
from tessera.operators.svd import truncated_svd
from tessera.session import cut_lineage

__all__ = ["logistic", "ridge", "linear_l1l2", "gbt", "random_forest", "factorization_machine", "score",
           "oof_scores", "cross_val_score", "grid_metric", "grid_search", "validation_curve", "learning_curve", "simple_blend",
           "average_blend", "concatenate_blend", "stack", "noise_stack", "stack_tables", "feature_importance",
           "class_weights", "truncated_svd", "pca_by_variance", "knn_regress"]


# ---- estimators (E4-E8, E10): parameters in the reference's terms ----

class PerRows:
    """An estimator whose penalty depends on the rows it is fitted on: ``make(total weight)``.

    Spark ML minimises the mean loss plus regParam, the reference the summed loss plus its own
    penalty; the two agree when regParam is divided by the rows (or weights) of this very fit."""

    def __init__(self, make, weight: str | None = None):
        self.make, self.weight = make, weight

    def fit(self, df: DataFrame):
        total = df.agg(F.sum(self.weight) if self.weight else F.count(F.lit(1))).first()[0]
        return self.make(float(total or 1.0)).fit(df)


class Linear(PerRows):
    """A linear model that can be fitted alone (Spark ML) or, in the validation functions below, for all folds,
    strengths and training shares in the same passes (``linear.fit_all``). ``strength``: C or alpha."""

    def __init__(self, kind: str, strength: float, features: str, label: str, make, weight: str | None = None):
        super().__init__(make, weight)
        self.kind, self.strength, self.features, self.label = kind, float(strength), features, label

    def fit(self, df: DataFrame):
        if self.kind != "ridge":
            return super().fit(df)
        # Spark ML divides a linear model's penalty by the label's standard deviation
        n, sd = df.agg(F.count(self.label), F.stddev_pop(self.label)).first()
        return self.make(float(n or 1) / (sd or 1.0)).fit(df)

    def family(self):
        """Fits of one family can share their passes."""
        return self.kind, self.features, self.label, self.weight


def logistic(C: float, features: str = "features", label: str = "target", weight: str | None = None):
    """L2 logistic regression with the objective C * sum(loss) + ||w||^2 / 2."""
    from pyspark.ml.classification import LogisticRegression
    kw = {"weightCol": weight} if weight else {}
    return Linear("logistic", C, features, label, lambda n: LogisticRegression(
        featuresCol=features, labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False, maxIter=100, **kw), weight)


def ridge(alpha: float, features: str = "features", label: str = "target"):
    """||y - Xw||^2 + alpha ||w||^2 (E5)."""
    from pyspark.ml.regression import LinearRegression
    return Linear("ridge", alpha, features, label, lambda n: LinearRegression(
        featuresCol=features, labelCol=label, regParam=alpha / n, elasticNetParam=0.0, standardization=False))


def linear_l1l2(l1: float, l2: float, features: str = "features", label: str = "target"):
    """Linear model with L1 + L2 penalties (E6, replaces the online FTRL / epsilon-insensitive learners)."""
    from pyspark.ml.regression import LinearRegression
    reg = l1 + l2
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg,
                            elasticNetParam=(l1 / reg) if reg > 0 else 0.0, standardization=True)


def gbt(classification: bool = True, max_depth: int = 4, step: float = 0.1, iters: int = 50, seed: int = 0,
        features: str = "features", label: str = "target", weight: str | None = None):
    """Boosted trees."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor
    kw = {"weightCol": weight} if weight else {}
    cls = GBTClassifier if classification else GBTRegressor
    return cls(featuresCol=features, labelCol=label, maxDepth=max_depth, stepSize=step, maxIter=iters, seed=seed, **kw)


def random_forest(classification: bool = False, trees: int = 500, min_leaf: int = 5, max_depth: int = 10,
                  subset: str = "onethird", seed: int = 0, features: str = "features", label: str = "target"):
    """Random forest."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor
    cls = RandomForestClassifier if classification else RandomForestRegressor
    return cls(featuresCol=features, labelCol=label, numTrees=trees, minInstancesPerNode=min_leaf,
               maxDepth=max_depth, featureSubsetStrategy=subset, seed=seed)


def factorization_machine(factors: int = 8, iters: int = 100, step: float = 0.01, seed: int = 0,
                          features: str = "features", label: str = "target"):
    """Factorisation machine classifier."""
    from pyspark.ml.classification import FMClassifier
    return FMClassifier(featuresCol=features, labelCol=label, factorSize=factors, maxIter=iters,
                        stepSize=step, seed=seed)


def score(model, df: DataFrame, key: str, name: str = "score") -> DataFrame:
    """(key, score): probability of class 1 for classifiers, prediction otherwise."""
    out = model.transform(df)
    if "probability" in out.columns:
        s = vector_to_array("probability")[1]
    else:
        s = F.col("prediction")
    return out.select(key, s.cast("double").alias(name))


# ---- validation (E11-E15) ----

def _same_family(ests) -> bool:
    return all(isinstance(e, Linear) for e in ests) and len({e.family() for e in ests}) == 1


def _folds(df: DataFrame, fold: str) -> list:
    return [r[0] for r in df.select(fold).distinct().orderBy(fold).collect()]


def _linear_scores(df: DataFrame, est: Linear, fits, betas, keep, oof: str | None) -> DataFrame:
    """Rows of ``df`` with the score of every fit (``fit``: its number), or, with ``oof``, of the fits that left
    out the row's fold. The coefficients are folds x strengths x columns numbers."""
    from tessera.operators.linear import linear_score
    models = F.array(*[F.struct(F.lit(k).alias("fit"), F.lit(-1 if f.fold is None else int(f.fold)).alias("f"),
                                F.lit([float(v) for v in b]).cast("array<double>").alias("b"))
                       for k, (f, b) in enumerate(zip(fits, betas)) if b is not None])
    t = df.select(*keep, est.features, *([F.col(oof).alias("_f")] if oof else []), F.explode(models).alias("m"))
    if oof:
        t = t.filter(F.col("m.f") == F.col("_f"))
    return t.select(*keep, F.col("m.fit").alias("fit"), linear_score(est.kind, est.features, F.col("m.b")).alias("score"))


def _linear_oof(train: DataFrame, ests: list[Linear], keep, fold: str, shares=None) -> DataFrame:
    """Out-of-fold scores of linear models of one family, all fitted in the same passes: (keep, fold, model,
    score), model = place in ``ests``. ``shares``: (share column, its numbers) fits one model per number
    instead, on the rows of at most that share, and scores those rows only."""
    from tessera.operators.linear import Fit, fit_all
    est, folds = ests[0], _folds(train, fold)
    column, numbers = shares or (None, [0])
    runs = [(e, s) for e in ests for s in numbers]
    fits = [Fit(e.strength, f, s) for e, s in runs for f in folds]
    betas = fit_all(est.kind, train, fits, est.features, est.label, est.weight, fold, column)
    df = train if column is None else train.withColumn("_share", column)
    out = _linear_scores(df, est, fits, betas, [*keep, fold, *(["_share"] if shares else [])], fold)
    out = out.withColumn("model", F.floor(F.col("fit") / len(folds)).cast("int")).drop("fit")
    if shares:
        limit = F.array(*[F.lit(int(s)) for _, s in runs])[F.col("model")]
        out = out.filter(F.col("_share") <= limit).drop("_share")
    return out


def oof_scores(train: DataFrame, test: DataFrame | None, est: Estimator, key: str, fold: str = "fold",
               model_name: str = "model") -> DataFrame:
    """Per fold: fit on the other folds, score the fold and the test set.
    Returns (key, model, fold, split, score); split is 'oof' or 'test'. Linear models fit all folds in the
    same passes, other estimators one fold after the other."""
    folds = _folds(train, fold)
    if isinstance(est, Linear):
        from tessera.operators.linear import Fit, fit_all
        fits = [Fit(est.strength, f) for f in folds]
        betas = fit_all(est.kind, train, fits, est.features, est.label, est.weight, fold)
        parts = [_linear_scores(train, est, fits, betas, [key, fold], fold).withColumn("split", F.lit("oof"))]
        if test is not None:
            number = F.array(*[F.lit(f) for f in folds])
            parts.append(_linear_scores(test, est, fits, betas, [key], None).withColumns(
                {fold: number[F.col("fit")], "split": F.lit("test")}))
        parts = [p.select(key, F.lit(model_name).alias("model"), F.col(fold).alias("fold"), "split", "score") for p in parts]
    else:
        parts = []
        for f in folds:
            m = est.fit(train.filter(F.col(fold) != f))
            parts.append(score(m, train.filter(F.col(fold) == f), key).select(
                key, F.lit(model_name).alias("model"), F.lit(f).alias("fold"), F.lit("oof").alias("split"), "score"))
            if test is not None:
                parts.append(score(m, test, key).select(
                    key, F.lit(model_name).alias("model"), F.lit(f).alias("fold"), F.lit("test").alias("split"), "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _metric(df: DataFrame, label: str, metric: str, by):
    from tessera.operators.metrics import kendall_tau, log_loss, roc_auc
    if metric == "auc":
        return roc_auc(df, label, "score", by=by).select(*by, F.col("auc").alias("metric"))
    if metric == "log_loss":
        return log_loss(df, label, "score", by=by).select(*by, F.col("log_loss").alias("metric"))
    if metric == "kendall":
        # per fold: folds are few, one exact tau each
        out = None
        for f in [r[0] for r in df.select(*by).distinct().collect()]:
            t = kendall_tau(df.filter(F.col(by[0]) == f), label, "score").select(F.lit(f).alias(by[0]),
                                                                                   F.col("tau_b").alias("metric"))
            out = t if out is None else out.unionByName(t)
        return out
    raise ValueError(metric)


def cross_val_score(train: DataFrame, est: Estimator, key: str, label: str = "target", fold: str = "fold",
                    metric: str = "auc") -> DataFrame:
    """Metric per fold plus mean and population std (E12): (fold, metric) rows and summary."""
    if isinstance(est, Linear) and metric != "kendall":
        return _metric(_linear_oof(train, [est], [label], fold), label, metric, [fold]).withColumnRenamed(fold, "fold")
    oof = oof_scores(train, None, est, key, fold).join(train.select(key, label), key)
    per = _metric(oof, label, metric, ["fold"])
    return per


def _summary(per: DataFrame) -> DataFrame:
    return per.agg(F.avg("metric").alias("mean"), F.stddev_pop("metric").alias("std"))


def grid_metric(train: DataFrame, ests: list[Linear], label: str = "target", fold: str = "fold", metric: str = "auc",
                shares=None) -> DataFrame:
    """(model, fold, metric) of linear models of one family, all fitted in the same passes; model = place in
    ``ests`` (E12, E13)."""
    return _metric(_linear_oof(train, ests, [label], fold, shares), label, metric, ["model", fold])


def _by_model(train: DataFrame, ests, label: str, fold: str, metric: str, shares=None) -> dict[int, tuple[float, float]]:
    """Mean and std of the fold metric of every model."""
    per = grid_metric(train, ests, label, fold, metric, shares)
    rows = per.groupBy("model").agg(F.avg("metric").alias("mean"), F.stddev_pop("metric").alias("std")).collect()
    return {r.model: (r["mean"], r["std"]) for r in rows}


def grid_search(train: DataFrame, make_est, grid: dict, key: str, label: str = "target", fold: str = "fold",
                metric: str = "auc", greater_is_better: bool = True) -> DataFrame:
    """Every parameter combination, mean / std of the fold metric; rank 1 = best."""
    names = list(grid)
    combos = [dict(zip(names, combo)) for combo in itertools.product(*[grid[n] for n in names])]
    ests = [make_est(**params) for params in combos]
    if _same_family(ests) and metric != "kendall":
        scored = _by_model(train, ests, label, fold, metric)
        rows = [(str(params), *scored.get(k, (None, None))) for k, params in enumerate(combos)]
    else:
        rows = []
        for params, est in zip(combos, ests):
            s = _summary(cross_val_score(train, est, key, label, fold, metric)).first()
            rows.append((str(params), float(s["mean"]), float(s["std"])))
    spark = train.sparkSession
    out = spark.createDataFrame(rows, "params string, mean_score double, std_score double")
    order = F.desc("mean_score") if greater_is_better else F.asc("mean_score")
    return out.withColumn("rank", F.row_number().over(Window.orderBy(order, "params")))


def validation_curve(train: DataFrame, make_est, param: str, values, key: str, label: str = "target",
                     fold: str = "fold", metric: str = "auc") -> DataFrame:
    """Train and validation metric for each value of one parameter."""
    ests = [make_est(**{param: v}) for v in values]
    if _same_family(ests) and metric != "kendall":
        from tessera.operators.linear import Fit, fit_all
        valid = _by_model(train, ests, label, fold, metric)
        fits = [Fit(e.strength) for e in ests]
        betas = fit_all(ests[0].kind, train, fits, ests[0].features, ests[0].label, ests[0].weight)
        own = _metric(_linear_scores(train, ests[0], fits, betas, [label], None), label, metric, ["fit"])
        own = {r.fit: r.metric for r in own.collect()}
        rows = [(str(v), own.get(k), valid.get(k, (None,))[0]) for k, v in enumerate(values)]
    else:
        rows = []
        for v, est in zip(values, ests):
            val = _summary(cross_val_score(train, est, key, label, fold, metric)).first()["mean"]
            m = est.fit(train)
            tr = _metric(score(m, train, key).join(train.select(key, label), key).withColumn("_g", F.lit(0)),
                         label, metric, ["_g"]).first()["metric"]
            rows.append((str(v), float(tr), float(val)))
    return train.sparkSession.createDataFrame(rows, f"{param} string, train_score double, valid_score double")


def learning_curve(train: DataFrame, est: Estimator, sizes, key: str, label: str = "target",
                   fold: str = "fold", metric: str = "auc", seed: int = 0) -> DataFrame:
    """Validation metric when training on a hash-chosen share of the rows."""
    place = hash_fraction(seed, key)
    if isinstance(est, Linear) and metric != "kendall":
        steps = sorted(set(float(s) for s in sizes))
        share = F.lit(len(steps))  # beyond every size
        for k, s in reversed(list(enumerate(steps))):
            share = F.when(place < F.lit(s), k).otherwise(share)
        valid = _by_model(train, [est], label, fold, metric, (share, list(range(len(steps)))))
        rows = [(float(s), valid.get(steps.index(float(s)), (None,))[0]) for s in sizes]
    else:
        rows = []
        for s in sizes:
            sub = train.filter(place < F.lit(float(s)))
            rows.append((float(s), float(_summary(cross_val_score(sub, est, key, label, fold, metric)).first()["mean"])))
    return train.sparkSession.createDataFrame(rows, "train_share double, valid_score double")


# ---- ensembles (E16-E21) ----

def _assemble_scores(df: DataFrame, key: str, cols, out: str = "meta") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def _once(made: dict | None, key: tuple, make):
    """``make()``, or what an earlier call with the same dict made under this key."""
    if made is None:
        return make()
    if key not in made:
        made[key] = make()
    return made[key]


def _blend_parts(train, test, bases: dict, key: str, label: str, part1_ratio: float, seed: int, made: dict | None):
    """Scores of the bases fit on part 1 of train: (key, label, scores) of part 2 and (key, scores) of test,
    written once, as meta fit and scoring read them again."""
    def make():
        is1 = hash_fraction(seed, key) < F.lit(part1_ratio)
        p1, p2 = train.filter(is1), train.filter(~is1)
        s2, st = p2.select(key, label), test.select(key)
        for name, est in bases.items():
            m = est.fit(p1)
            s2 = s2.join(score(m, p2, key, name), key)
            st = st.join(score(m, test, key, name), key)
        return (s2, st) if made is None else (cut_lineage(s2), cut_lineage(st))
    return _once(made, ("blend", key, label, part1_ratio, seed), make)


def simple_blend(train: DataFrame, test: DataFrame, bases: dict, meta_est, key: str, label: str = "target",
                 part1_ratio: float = 0.9, seed: int = 0, made: dict | None = None) -> DataFrame:
    """Bases fit on part 1 of train; meta model fit on their part-2 scores; test scored.

    ``made``, here and below: a dict handed to several ensembles over the same train, test and bases; a base
    that was fit on the same rows for one of them is not fit again for the next."""
    s2, st = _blend_parts(train, test, bases, key, label, part1_ratio, seed, made)
    meta = meta_est.setFeaturesCol("meta").setLabelCol(label).fit(_assemble_scores(s2, key, bases))
    return score(meta, _assemble_scores(st, key, bases), key)


def average_blend(train, test, bases, meta_est, key, label="target", part1_ratio=0.9, n_iter=3, seed=0,
                  made: dict | None = None) -> DataFrame:
    """Mean of simple blends over seeds."""
    return _mean_score([simple_blend(train, test, bases, meta_est, key, label, part1_ratio, seed + i, made)
                        for i in range(n_iter)], key)


def _mean_score(parts, key: str) -> DataFrame:
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(key).agg(F.avg("score").alias("score"))


def concatenate_blend(train, test, bases, meta_est, key, label="target", part1_ratio=0.9, n_iter=3,
                      seed=0, made: dict | None = None) -> DataFrame:
    """One meta model on all realisations' part-2 rows together; it scores every realisation's
    test rows, and these scores are averaged (E18)."""
    metas, tests = zip(*[_blend_parts(train, test, bases, key, label, part1_ratio, seed + i, made) for i in range(n_iter)])
    allm = metas[0]
    for m in metas[1:]:
        allm = allm.unionByName(m)
    meta = meta_est.setFeaturesCol("meta").setLabelCol(label).fit(_assemble_scores(allm, key, bases))
    return _mean_score([score(meta, _assemble_scores(t, key, bases), key) for t in tests], key)


def stack(train, test, bases, meta_est, key, label="target", n_folds=3, n_iter=1, seed=0,
          noise: float = 0.0, made: dict | None = None) -> DataFrame:
    """Out-of-fold base scores as meta features over stratified folds, bases refit on all train
    for test (E19); ``noise`` > 0 adds Gaussian noise (hash-seeded) to the meta features of train
    and test (E20)."""
    reals = []
    whole = {} if made is None else made  # the fits on all train are the same in every iteration

    def features(i):
        tr = stratified_kfold(train, key, label, n_folds, seed=seed + i)
        meta_tr, meta_te = tr.select(key, label), test.select(key)
        for name, est in bases.items():
            o = oof_scores(tr, None, est, key, "fold", name).select(key, F.col("score").alias(name))
            meta_tr = meta_tr.join(o, key)
            model = _once(whole, ("whole", name, label), lambda: est.fit(train))  # noqa: B023
            meta_te = meta_te.join(score(model, test, key, name), key)
        return (meta_tr, meta_te) if made is None else (cut_lineage(meta_tr), cut_lineage(meta_te))
    for i in range(n_iter):
        meta_tr, meta_te = _once(made, ("stack", key, label, n_folds, seed + i), lambda: features(i))  # noqa: B023
        if noise > 0:
            def shaken(df):
                return df.withColumns({n: F.col(n) + F.lit(noise) * _gauss(seed + i, key, j) for j, n in enumerate(bases)})  # noqa: B023
            meta_tr, meta_te = shaken(meta_tr), shaken(meta_te)
        meta = meta_est.setFeaturesCol("meta").setLabelCol(label).fit(_assemble_scores(meta_tr, key, bases))
        reals.append(score(meta, _assemble_scores(meta_te, key, bases), key))
    return _mean_score(reals, key)


def _gauss(seed: int, key: str, j: int):
    """Standard normal from two hash uniforms (Box-Muller), repeatable per (seed, key, j)."""
    u1 = F.greatest(hash_fraction(seed * 7919 + 2 * j, key), F.lit(1e-12))
    u2 = hash_fraction(seed * 7919 + 2 * j + 1, key)
    return F.sqrt(-2 * F.log(u1)) * F.cos(2 * math.pi * u2)


def noise_stack(train, test, bases, meta_est, key, label="target", scale=0.03, n_folds=3, n_iter=1, seed=0,
                made: dict | None = None):
    return stack(train, test, bases, meta_est, key, label, n_folds, n_iter, seed, noise=scale, made=made)


def stack_tables(scores: DataFrame, features: DataFrame, key: str, split: str = "oof") -> DataFrame:
    """Score table (key, model, split, score) pivoted to one column per model, each min-max
    scaled over its column, joined to the features (E21). Model names are a declared list."""
    models = sorted(r[0] for r in scores.select("model").distinct().collect())
    s = scores.filter(F.col("split") == split).groupBy(key).pivot("model", models).agg(F.avg("score"))
    bounds = s.agg(*[F.min(m).alias(f"lo_{m}") for m in models], *[F.max(m).alias(f"hi_{m}") for m in models]).first()
    for m in models:
        lo, hi = bounds[f"lo_{m}"], bounds[f"hi_{m}"]
        rng = (hi - lo) if hi is not None and lo is not None and hi != lo else 1.0
        s = s.withColumn(m, (F.col(m) - F.lit(lo)) / F.lit(rng))
    return features.join(s, key, "left")


def feature_importance(model, names, k: int = 21) -> DataFrame:
    """Ranked importances (trees) or absolute coefficients (linear), top k."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
    else:
        vals = [abs(x) for x in model.coefficients.toArray().tolist()]
    df = spark.createDataFrame(list(zip(names, [float(v) for v in vals])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(k)


def class_weights(df: DataFrame, label: str = "target", weights: dict | None = None, out: str = "weight") -> DataFrame:
    """Per-class weight column (E24): fixed {class: w}, or balanced n / (n_classes * n_class)."""
    if weights is not None:
        from tessera.operators.clean import map_values
        return df.withColumn(out, map_values(label, weights).cast("double"))
    cnt = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.select(F.count(F.lit(1))).scalar()
    k = cnt.select(F.count(F.lit(1))).scalar()
    w = cnt.select(label, (n / (k * F.col("_nc"))).cast("double").alias(out))
    return df.join(w, label, "left")


# ---- reductions (M11; M10 is in ``svd``) ----

def pca_by_variance(df: DataFrame, vec: str, variance: float = 0.95, out: str = "pca") -> tuple[DataFrame, int]:
    """Smallest k explaining ``variance`` of the total (M11), then the projection of the centred
    vectors as an array column. One fit: the first k columns of its d x d matrix are used."""
    import numpy as np
    import pyarrow as pa
    from pyspark.ml.feature import PCA
    from pyspark.ml.stat import Summarizer
    d = len(df.select(vector_to_array(vec).alias("a")).first()["a"])
    full = PCA(k=d, inputCol=vec, outputCol=out).fit(df)
    ev = full.explainedVariance.toArray()
    k = int(min(d, 1 + next((i for i, c in enumerate(ev.cumsum()) if c >= variance - 1e-12), d - 1)))
    mean = df.select(Summarizer.mean(F.col(vec)).alias("m")).first()["m"].toArray()
    basis = full.pc.toArray()[:, :k]  # d x k, d fixed by the data model
    rest = [c for c in df.columns if c != vec]
    rows = df.select(*rest, vector_to_array(vec).alias("_v"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def project(batches):
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = ((x - mean) @ basis).ravel()
            offsets = pa.array(np.arange(0, len(y) + 1, k, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(rest))),
                                              pa.ListArray.from_arrays(offsets, pa.array(y))], [*rest, out])

    return rows.mapInArrow(project, f"{ddl}, {out} array<double>"), k


def knn_regress(train: DataFrame, query: DataFrame, k: int, key: str, vec: str = "vec", target: str = "target",
                out: str = "prediction") -> DataFrame:
    """Mean target of the k nearest train rows in Euclidean feature space (E9), exact
    (blocks of queries against blocks of rows, see spatial.knn_euclidean)."""
    from tessera.operators.spatial import knn_euclidean
    nn = knn_euclidean(query.select(key, vec), train.select(F.col(key).alias("_tk"), vec, target), k, key, vec)
    return nn.groupBy(key).agg(F.avg(target).alias(out))
