"""Registered model queries (Spark ML fits on the document features). No SQL form:
the driver checks rows; tests check the pieces (AUC, kNN, folds) against brute force."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.operators import encode as E
from tessera.operators import models as MD
from tessera.operators.aggregate import fold_test_average
from tessera.operators.folds import kfold, train_test_split
from tessera.plans.q_metrics import fold_sql
from tessera.plans.q_text import DOCLAB_SQL, TOKENS_SQL
from tessera.plans.registry import finish, register
from tessera.session import cut_lineage, forget, outlive, packed_table, scratch, table
from tessera.sources import standins as S

FEATURES = ["n_chars", "n_tokens", "n_distinct", "lang_en", "lang_fr", "lang_de", "lang_es"]


def doc_features(spark, sf_dir):
    """doc_id, target (null = test), numeric features, assembled vector, 5 hash folds."""
    # tokens are counted inside their document's row: no shuffle of tokens
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda t: F.length(t) > 0)
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", words.alias("w"))
    d = d.select("doc_id", "n_chars", "lang", F.coalesce(F.size("w"), F.lit(0)).alias("n_tokens"),
                 F.coalesce(F.size(F.array_distinct("w")), F.lit(0)).alias("n_distinct"))
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    # read by the scaling's statistics and by what follows
    d = cut_lineage(d.join(lab, "doc_id", "left"))
    d = E.one_hot(d, "lang", ["en", "fr", "de", "es"])
    d = d.withColumns({c: F.col(c).cast("double") for c in FEATURES})
    train = d.filter(F.col("target").isNotNull())
    d = E.standard_scale(train, d, ["n_chars", "n_tokens", "n_distinct"])
    d = E.assemble(d, FEATURES)
    d = d.withColumn("target", F.col("target").cast("double"))
    return kfold(d, "doc_id", 5, seed=239)


def _split(spark, sf_dir):
    # Every fit below re-reads this table many times (one pass per iteration, per fold):
    # write it once to the checkpoint folder so no fit recomputes tokens and joins.
    d = cut_lineage(doc_features(spark, sf_dir))
    return d.filter(F.col("target").isNotNull()), d.filter(F.col("target").isNull())


@register("doc_logistic_cv", headline=True)
def q_doc_logistic_cv(spark, sf_dir):
    """L2 logistic regression (C = 0.2), balanced class weights, 5-fold AUC."""
    tr, _ = _split(spark, sf_dir)
    tr = MD.class_weights(tr, "target")
    per = MD.cross_val_score(tr, MD.logistic(0.2, weight="weight"), "doc_id", metric="auc")
    return finish(per)


def _ridge_sql(alphas, folds: int, seed: int) -> str:
    """AUC per fold of ridge by normal equations: one matrix of products per fold, Gauss-Jordan elimination as a
    recursion over the columns, then ranks with mean ties."""
    d = len(FEATURES)
    one_hot = ", ".join(f"CAST(lang = '{v}' AS DOUBLE)" for v in ("en", "fr", "de", "es"))
    scaled = ", ".join(f"({c} - m.{c[0]}{c[2]}_m) / CASE WHEN m.{c[0]}{c[2]}_s = 0 THEN 1 ELSE m.{c[0]}{c[2]}_s END" for c in FEATURES[:3])
    stats = ", ".join(f"avg({c}) AS {c[0]}{c[2]}_m, stddev_pop({c}) AS {c[0]}{c[2]}_s" for c in FEATURES[:3])
    return f"""
WITH RECURSIVE {TOKENS_SQL}, {DOCLAB_SQL},
nt AS (SELECT doc_id, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct FROM toks GROUP BY doc_id),
d AS (SELECT documents.doc_id, n_chars, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_distinct, 0) AS n_distinct, lang, dl.target,
        {fold_sql(seed, 'documents.doc_id')} % {folds} AS fold
      FROM documents LEFT JOIN nt USING (doc_id) LEFT JOIN dl USING (doc_id) WHERE dl.target IS NOT NULL),
m AS (SELECT {stats} FROM d),
x AS (SELECT doc_id, fold, CAST(target AS DOUBLE) AS y, [{scaled}, {one_hot}, 1.0] AS v FROM d, m),
e AS (SELECT doc_id, fold, unnest(list_append(v, y)) AS c, unnest(range(1, {d + 3})) AS i FROM x),
g AS (SELECT f.fold, a.i, b.i AS j, sum(a.c * b.c) AS s FROM e a JOIN e b USING (doc_id)
      JOIN (SELECT DISTINCT fold FROM d) f ON f.fold <> a.fold WHERE a.i <= {d + 1} GROUP BY 1, 2, 3),
al AS (SELECT CAST(unnest([{', '.join(str(float(a)) for a in alphas)}]) AS DOUBLE) AS alpha),
r AS (SELECT alpha, fold, i, list(s + CASE WHEN i = j AND i <= {d} THEN alpha ELSE 0 END ORDER BY j) AS row FROM g, al GROUP BY 1, 2, 3),
mat AS (SELECT alpha, fold, list(row ORDER BY i) AS a FROM r GROUP BY 1, 2),
elim AS (
  SELECT alpha, fold, 1 AS k, a FROM mat
  UNION ALL
  SELECT alpha, fold, k + 1, list_transform(range(1, {d + 2}), lambda i: list_transform(range(1, {d + 3}), lambda j:
    CASE WHEN i = k THEN a[k][j] / a[k][k] ELSE a[i][j] - a[i][k] * a[k][j] / a[k][k] END))
  FROM elim WHERE k <= {d + 1}),
beta AS (SELECT alpha, fold, list_transform(a, lambda row: row[{d + 2}]) AS b FROM elim WHERE k = {d + 2}),
sc AS (SELECT alpha, x.fold, y, list_sum(list_transform(range(1, {d + 2}), lambda i: v[i] * b[i])) AS s
       FROM x JOIN beta ON x.fold = beta.fold),
rk AS (SELECT alpha, fold, y, rank() OVER (PARTITION BY alpha, fold ORDER BY s)
         + (count(*) OVER (PARTITION BY alpha, fold, s) - 1) / 2.0 AS rk FROM sc)
SELECT alpha, CAST(fold AS INTEGER) AS fold,
  round((sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) AS auc
FROM rk GROUP BY 1, 2"""


RIDGE_ALPHAS, RIDGE_FOLDS, RIDGE_SEED = (0.1, 1.0, 100.0), 3, 7


@register("doc_ridge_grid", _ridge_sql(RIDGE_ALPHAS, RIDGE_FOLDS, RIDGE_SEED))
def q_doc_ridge_grid(spark, sf_dir):
    """Ridge for every penalty and fold from one pass over the rows: AUC per penalty and fold."""
    tr, _ = _split(spark, sf_dir)
    tr = kfold(tr.drop("fold"), "doc_id", RIDGE_FOLDS, seed=RIDGE_SEED)
    per = MD.grid_metric(tr, [MD.ridge(a) for a in RIDGE_ALPHAS], "target", "fold")
    alpha = F.array(*[F.lit(a) for a in RIDGE_ALPHAS])[F.col("model")]
    return finish(per.select(alpha.alias("alpha"), "fold", F.col("metric").alias("auc")))


@register("doc_model_zoo")
def q_doc_model_zoo(spark, sf_dir):
    """Ridge, L1+L2 linear, boosted trees, forest, factorisation machine: 3-fold AUC
    mean and std per model (E5-E8, E10, A35)."""
    tr, _ = _split(spark, sf_dir)
    tr = kfold(tr.drop("fold"), "doc_id", 3, seed=7)
    models = {"ridge": MD.ridge(1.0), "l1l2": MD.linear_l1l2(0.001, 0.01),
              "gbt": MD.gbt(True, max_depth=3, iters=10), "forest": MD.random_forest(False, trees=20, max_depth=5),
              "fm": MD.factorization_machine(4, iters=20)}
    out = None
    for name, est in models.items():
        per = MD.cross_val_score(tr, est, "doc_id", metric="auc")
        s = per.agg(F.avg("metric").alias("mean_score"), F.stddev_pop("metric").alias("std_score")) \
               .select(F.lit(name).alias("model"), "mean_score", "std_score")
        out = s if out is None else out.unionByName(s)
    return finish(out)


@register("doc_stack_table")
def q_doc_stack_table(spark, sf_dir):
    """Out-of-fold and test scores of two models as a score table, test scores averaged over
    folds, then pivoted, min-max scaled and joined to the features (E11, A36, E21)."""
    tr, te = _split(spark, sf_dir)
    scores = MD.oof_scores(tr, te, MD.logistic(1.0), "doc_id", model_name="logit") \
        .unionByName(MD.oof_scores(tr, te, MD.gbt(True, 3, 0.1, 10), "doc_id", model_name="gbt"))
    test_avg = fold_test_average(scores.filter(F.col("split") == "test"), "doc_id", "score", "score")
    test_avg = test_avg.withColumn("split", F.lit("test_mean"))
    stacked = MD.stack_tables(scores, tr.select("doc_id", "target", *FEATURES), "doc_id")
    return finish(stacked.join(test_avg.select("doc_id", F.col("score").alias("test_mean")), "doc_id", "left"))


@register("doc_blends")
def q_doc_blends(spark, sf_dir):
    """Simple, average and concatenate blending, stacking and noise stacking of two bases
    under a logistic meta model (E16-E20): (doc_id, method, score) for the test documents."""
    tr, te = _split(spark, sf_dir)
    bases = {"logit": MD.logistic(1.0), "gbt": MD.gbt(True, 3, 0.1, 10)}

    def meta():
        from pyspark.ml.classification import LogisticRegression
        return LogisticRegression(regParam=0.01)
    made = {}  # bases fit on the same rows are fit once for all methods
    parts = {
        "simple": MD.simple_blend(tr, te, bases, meta(), "doc_id", seed=1, made=made),
        "average": MD.average_blend(tr, te, bases, meta(), "doc_id", n_iter=2, seed=1, made=made),
        "concatenate": MD.concatenate_blend(tr, te, bases, meta(), "doc_id", n_iter=2, seed=1, made=made),
        "stack": MD.stack(tr, te, bases, meta(), "doc_id", n_folds=3, seed=1, made=made),
        "noise_stack": MD.noise_stack(tr, te, bases, meta(), "doc_id", n_folds=3, seed=1, made=made),
    }
    out = None
    for name, df in parts.items():
        x = df.select("doc_id", F.lit(name).alias("method"), "score")
        out = x if out is None else out.unionByName(x)
    return finish(out)


@register("doc_model_selection")
def q_doc_model_selection(spark, sf_dir):
    """Grid search, validation curve and learning curve of the logistic model."""
    tr, _ = _split(spark, sf_dir)
    tr = kfold(tr.drop("fold"), "doc_id", 3, seed=11)
    g = MD.grid_search(tr, lambda C: MD.logistic(C), {"C": [0.1, 1.0]}, "doc_id") \
        .select(F.lit("grid").alias("kind"), F.col("params").alias("setting"), F.col("mean_score").alias("score"))
    v = MD.validation_curve(tr, lambda C: MD.logistic(C), "C", [0.1, 1.0], "doc_id") \
        .select(F.lit("validation").alias("kind"), F.col("C").alias("setting"), F.col("valid_score").alias("score"))
    lc = MD.learning_curve(tr, MD.logistic(1.0), [0.5, 1.0], "doc_id") \
        .select(F.lit("learning").alias("kind"), F.col("train_share").cast("string").alias("setting"),
                F.col("valid_score").alias("score"))
    return finish(g.unionByName(v).unionByName(lc))


@register("doc_feature_importance")
def q_doc_feature_importance(spark, sf_dir):
    """Top importances of a boosted-tree model."""
    tr, _ = _split(spark, sf_dir)
    m = MD.gbt(True, 3, 0.1, 10).fit(tr)
    return finish(MD.feature_importance(m, FEATURES, k=5))


@register("doc_svd")
def q_doc_svd(spark, sf_dir):
    """Rank-10 SVD of the TF-IDF document x term matrix, U * S keyed by document."""
    with scratch(spark):  # the texts' tables go as soon as the matrix is written
        with scratch(spark):
            w = E.tfidf(S.doc_tokens(spark, sf_dir), "doc_id", "token", min_df=2, max_df=0.9,
                        docs=table(spark, sf_dir, "documents").select("doc_id"))
            # read by the vocabulary, its ranges and the join with it
            w = outlive(packed_table(w.select("doc_id", "token", "tfidf")))
        long = w.select("doc_id", F.lit("tok").alias("src"), F.col("token").alias("key"), F.col("tfidf").alias("value"))
        idx, _ = E.dict_vectorise(long, long)
        idx = packed_table(idx.select("doc_id", "col_idx", "value"))
        forget(w)
        return finish(MD.truncated_svd(idx, "doc_id", "col_idx", "value", 10, spent=[idx]))


@register("embedding_pca")
def q_embedding_pca(spark, sf_dir):
    """PCA keeping the smallest number of components that explain 95 % of the variance."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(
        F.transform("embedding", lambda x: x.cast("double"))).alias("vec"))
    out, k = MD.pca_by_variance(e, "vec", 0.95)
    return out.select("vec_id", F.lit(k).alias("n_components"), "pca")


@register("embedding_pca_energy", """
WITH m AS (SELECT i, avg(e) AS mean FROM (SELECT unnest(embedding) AS e, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY i),
x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS e, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
SELECT vec_id, round(sum((e - mean) * (e - mean)), 6) AS energy FROM x JOIN m USING (i) GROUP BY vec_id""")
def q_embedding_pca_energy(spark, sf_dir):
    """All components together keep every centred vector's squared length."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(
        F.transform("embedding", lambda x: x.cast("double"))).alias("vec"))
    out, _ = MD.pca_by_variance(e, "vec", 1.0)
    return finish(out.select("vec_id", F.aggregate("pca", F.lit(0.0), lambda a, x: a + x * x).alias("energy")))


@register("embedding_svd_energy", """
SELECT vec_id, round(sum(e * e), 6) AS energy
FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS e FROM embeddings) GROUP BY vec_id""")
def q_embedding_svd_energy(spark, sf_dir):
    """A full-rank U * S keeps every row's squared length."""
    long = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(F.transform("embedding", lambda x: x.cast("double"))).alias("col_idx", "value"))
    out = MD.truncated_svd(long, "vec_id", "col_idx", "value", 64)
    energy = sum((F.col(c) * F.col(c) for c in out.columns[1:]), F.lit(0.0))
    return finish(out.select("vec_id", energy.alias("energy")))


@register("embedding_knn_digest", """
WITH e AS (SELECT vec_id, CAST(label AS DOUBLE) AS target, embedding FROM embeddings),
d AS (SELECT q.vec_id, r.vec_id AS rid, r.target,
        list_sum(list_transform(range(1, 65), lambda i: pow(CAST(q.embedding[i] AS DOUBLE) - CAST(r.embedding[i] AS DOUBLE), 2))) AS d2
      FROM e q JOIN e r ON q.vec_id % 7 = 0 AND r.vec_id % 7 <> 0),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, rid) AS rk FROM d)
SELECT vec_id, round(avg(target), 6) AS prediction FROM k WHERE rk <= 5 GROUP BY vec_id""")
def q_embedding_knn_digest(spark, sf_dir):
    """k-NN regression with a hold-out by id, so that SQL can repeat it."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"), F.col("label").cast("double").alias("target"))
    return finish(MD.knn_regress(e.filter("vec_id % 7 <> 0"), e.filter("vec_id % 7 = 0"), 5, "vec_id", "vec", "target"))


@register("embedding_knn_regress")
def q_embedding_knn_regress(spark, sf_dir):
    """k-NN regression (k = 5) of the label from the 64-d embedding, for a 30 % hold-out."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
        F.col("label").cast("double").alias("target"))
    e = train_test_split(e, "vec_id", 0.3, seed=5)
    tr, q = e.filter(F.col("is_test") == 0), e.filter(F.col("is_test") == 1)
    pred = MD.knn_regress(tr, q, 5, "vec_id", "vec", "target")
    return finish(pred.join(q.select("vec_id", "target"), "vec_id"))
