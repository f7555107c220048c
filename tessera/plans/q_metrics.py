"""Registered metric, encoding-by-label and split queries over documents, customers and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import encode as E
from tessera.operators import metrics as M
from tessera.operators import select as SEL
from tessera.operators.aggregate import score_summary
from tessera.operators.folds import kfold, stratified_kfold, train_test_split
from tessera.plans.q_text import DOCLAB_SQL, TOKENS_SQL, _doc_numeric
from tessera.plans.registry import finish, register
from tessera.session import table
from tessera.sources import standins as S

_DOCNUM_SQL = f"""{TOKENS_SQL}, {DOCLAB_SQL},
nt AS (SELECT doc_id, count(*) AS n_tokens FROM toks GROUP BY doc_id),
d AS (SELECT documents.doc_id, n_chars, coalesce(n_tokens, 0) AS n_tokens, dl.target, documents.doc_id % 5 AS fold
      FROM documents LEFT JOIN nt USING (doc_id) LEFT JOIN dl USING (doc_id)),
lg AS (SELECT fold, target, 'n_chars' AS model, CAST(n_chars AS DOUBLE) AS score FROM d WHERE target IS NOT NULL
       UNION ALL SELECT fold, target, 'n_tokens', CAST(n_tokens AS DOUBLE) FROM d WHERE target IS NOT NULL),
rk AS (SELECT *, rank() OVER (PARTITION BY fold, model ORDER BY score)
                 + (count(*) OVER (PARTITION BY fold, model, score) - 1) / 2.0 AS r FROM lg),
auc AS (SELECT fold, model,
          (sum(r) FILTER (WHERE target = 1) - count(*) FILTER (WHERE target = 1) * (count(*) FILTER (WHERE target = 1) + 1) / 2.0)
          / (count(*) FILTER (WHERE target = 1) * count(*) FILTER (WHERE target = 0)) AS auc,
          count(*) FILTER (WHERE target = 1) AS n_pos, count(*) FILTER (WHERE target = 0) AS n_neg
        FROM rk GROUP BY fold, model)"""


def _doc_folds(spark, sf_dir):
    return _doc_numeric(spark, sf_dir).withColumn("fold", F.pmod(F.col("doc_id"), F.lit(5)).cast("int"))


def _fold_auc(spark, sf_dir):
    d = _doc_folds(spark, sf_dir).filter(F.col("target").isNotNull())
    return M.auc_by_column(d, "target", ["n_chars", "n_tokens"], by=["fold"])


@register("doc_auc_by_fold", f"""
WITH {_DOCNUM_SQL}
SELECT CAST(fold AS INTEGER) AS fold, model, round(auc, 6) AS auc, n_pos, n_neg FROM auc""", headline=True)
def q_doc_auc_by_fold(spark, sf_dir):
    return finish(_fold_auc(spark, sf_dir))


@register("doc_auc_summary", f"""
WITH {_DOCNUM_SQL}
SELECT model, round(avg(auc), 6) AS mean_score, round(stddev_pop(auc), 6) AS std_score FROM auc GROUP BY model""")
def q_doc_auc_summary(spark, sf_dir):
    return finish(score_summary(_fold_auc(spark, sf_dir), "auc", by="model"))


@register("doc_log_loss", f"""
WITH {_DOCNUM_SQL},
tr AS (SELECT * FROM d WHERE target IS NOT NULL),
mm AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM tr),
p AS (SELECT fold, target, greatest(1e-15, least(1 - 1e-15, (n_chars - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END)) AS p
      FROM tr, mm)
SELECT CAST(fold AS INTEGER) AS fold, round(-avg(target * ln(p) + (1 - target) * ln(1 - p)), 6) AS log_loss
FROM p GROUP BY fold""")
def q_doc_log_loss(spark, sf_dir):
    d = _doc_folds(spark, sf_dir).filter(F.col("target").isNotNull())
    d = E.minmax_scale(d, d, ["n_chars"], suffix="_p")
    return finish(M.log_loss(d, "target", "n_chars_p", by="fold"))


def _tau_sql(tbl, a, b, name):
    return f"""SELECT '{name}' AS pair, round(sum(s) / sqrt((n0 - sum(ta)) * (n0 - sum(tb))), 6) AS tau_b
  FROM (SELECT sign(x.{a} - y.{a}) * sign(x.{b} - y.{b}) AS s, CAST(x.{a} = y.{a} AS INTEGER) AS ta,
               CAST(x.{b} = y.{b} AS INTEGER) AS tb
        FROM (SELECT {a}, {b}, row_number() OVER () AS i FROM {tbl}) x
        JOIN (SELECT {a}, {b}, row_number() OVER () AS i FROM {tbl}) y ON x.i < y.i) p,
       (SELECT count(*) * (count(*) - 1) / 2.0 AS n0 FROM {tbl}) c GROUP BY n0"""


def _spearman_sql(tbl, a, b, name):
    return f"""SELECT '{name}' AS pair, round(corr(ra, rb), 6) AS spearman FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb FROM {tbl})"""


@register("rank_correlations", f"""
WITH t AS ({_tau_sql('customer', 'c_acctbal', 'c_nationkey', 'customer')}
           UNION ALL {_tau_sql('part', 'p_retailprice', 'p_size', 'part')}),
s AS ({_spearman_sql('customer', 'c_acctbal', 'c_nationkey', 'customer')}
      UNION ALL {_spearman_sql('part', 'p_retailprice', 'p_size', 'part')})
SELECT pair, tau_b, spearman FROM t JOIN s USING (pair)""")
def q_rank_correlations(spark, sf_dir):
    out = None
    for name, tbl, a, b in (("customer", "customer", "c_acctbal", "c_nationkey"),
                            ("part", "part", "p_retailprice", "p_size")):
        df = table(spark, sf_dir, tbl).select(a, b)
        r = M.kendall_tau(df, a, b).select(F.lit(name).alias("pair"), "tau_b")
        r = r.select("pair", "tau_b", M.spearman(df, a, b).scalar().alias("spearman"))
        out = r if out is None else out.unionByName(r)
    return finish(out)


@register("doc_target_encoding", f"""
WITH {DOCLAB_SQL},
d AS (SELECT documents.doc_id, lang, dl.target, CAST(documents.doc_id % 5 AS INTEGER) AS fold
      FROM documents JOIN dl USING (doc_id)),
tr AS (SELECT * FROM d WHERE target IS NOT NULL),
g AS (SELECT avg(target) AS g FROM tr),
per AS (SELECT lang, fold, sum(target) AS s, count(*) AS n FROM tr GROUP BY 1, 2),
tot AS (SELECT lang, sum(s) AS ss, sum(n) AS nn FROM per GROUP BY lang),
oof AS (SELECT tr.doc_id, tr.lang, tr.fold,
          CASE WHEN nn - n > 0 THEN ((ss - s) / (nn - n) * (nn - n) + 10 * g) / (nn - n + 10) END AS te
        FROM tr JOIN per USING (lang, fold) JOIN tot USING (lang), g),
full_enc AS (SELECT lang, (avg(target) * count(*) + 10 * any_value(g)) / (count(*) + 10) AS te FROM tr, g GROUP BY lang)
SELECT doc_id, lang, fold, round(te, 6) AS lang_te FROM oof
UNION ALL
SELECT d.doc_id, d.lang, d.fold, round(f.te, 6) FROM d LEFT JOIN full_enc f USING (lang) WHERE d.target IS NULL""")
def q_doc_target_encoding(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(
        table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target")), "doc_id", "left")
    d = d.withColumn("fold", F.pmod(F.col("doc_id"), F.lit(5)).cast("int"))
    train, test = d.filter(F.col("target").isNotNull()), d.filter(F.col("target").isNull())
    tr, te = E.encode_split(train, [test], "lang", "fold", "target", 10.0)
    cols = ["doc_id", "lang", "fold", "lang_te"]
    return finish(tr.select(*cols).unionByName(te.select(*cols)))


def _tok_long(spark, sf_dir):
    """Term counts, plus a term that only documents of class 1 hold and one that every document holds."""
    tf = S.doc_tokens(spark, sf_dir).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("value"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    one = F.lit(1).cast("long").alias("value")
    tf = tf.unionByName(lab.filter(F.col("quality") == 1).select("doc_id", F.lit("<class 1>").alias("token"), one)) \
           .unionByName(table(spark, sf_dir, "documents").select("doc_id", F.lit("<all>").alias("token"), one))
    return tf.select("doc_id", F.lit("tok").alias("src"), F.col("token").alias("key"), "value")


_SEL_BASE = f"""{TOKENS_SQL}, {DOCLAB_SQL},
lab AS (SELECT doc_id, target FROM dl WHERE target IS NOT NULL),
tf AS (SELECT doc_id, token, count(*) AS tf FROM toks GROUP BY 1, 2
       UNION ALL SELECT doc_id, '<class 1>', 1 FROM lab WHERE target = 1
       UNION ALL SELECT doc_id, '<all>', 1 FROM documents)"""


def _top_sql(score_cte):
    return f"""{score_cte},
r AS (SELECT token, score, row_number() OVER (ORDER BY CASE WHEN isinf(score) THEN score ELSE round(score, 9) END DESC NULLS LAST, token) AS rk,
             count(*) OVER () AS n FROM sc)
SELECT 'tok' AS src, token AS key, CASE WHEN isinf(score) THEN score ELSE round(score, 6) END AS score FROM r WHERE rk <= ceil(n * 10 / 100.0)"""


@register("token_select_f", "WITH " + _top_sql(f"""{_SEL_BASE},
nc AS (SELECT target, count(*) AS n_c FROM lab GROUP BY target),
tot AS (SELECT sum(n_c) AS nn, count(*) AS k FROM nc),
per AS (SELECT token, target, CAST(sum(tf) AS DOUBLE) AS s, CAST(sum(tf * tf) AS DOUBLE) AS ss
        FROM tf JOIN lab USING (doc_id) GROUP BY 1, 2),
agg AS (SELECT token, sum(s) AS s, sum(ss) AS ss, sum(s * s / n_c) AS b FROM per JOIN nc USING (target) GROUP BY token),
sc AS (SELECT token, CASE WHEN ss - b > ss * 1e-12 THEN ((b - s * s / nn) / (k - 1)) / ((ss - b) / (nn - k))
         WHEN b - s * s / nn > ss * 1e-12 THEN CAST('infinity' AS DOUBLE) END AS score FROM agg, tot)"""))
def q_token_select_f(spark, sf_dir):
    lab = S.doc_labels(spark, sf_dir)
    return finish(SEL.select_top_percent(SEL.anova_f(_tok_long(spark, sf_dir), lab, "doc_id"), 10))


@register("token_select_mi", "WITH " + _top_sql(f"""{_SEL_BASE},
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(target) AS DOUBLE) AS n1 FROM lab),
cnt AS (SELECT token, CAST(count(*) FILTER (WHERE target = 1) AS DOUBLE) AS a11, CAST(count(*) AS DOUBLE) AS x1
        FROM (SELECT DISTINCT doc_id, token FROM tf WHERE tf <> 0) JOIN lab USING (doc_id) GROUP BY token),
c2 AS (SELECT token, a11, x1 - a11 AS a10, n1 - a11 AS a01, n - x1 - (n1 - a11) AS a00, x1, n, n1 FROM cnt, nn),
sc AS (SELECT token,
   (CASE WHEN a11 > 0 THEN a11 / n * ln(a11 * n / (x1 * n1)) ELSE 0 END) +
   (CASE WHEN a10 > 0 THEN a10 / n * ln(a10 * n / (x1 * (n - n1))) ELSE 0 END) +
   (CASE WHEN a01 > 0 THEN a01 / n * ln(a01 * n / ((n - x1) * n1)) ELSE 0 END) +
   (CASE WHEN a00 > 0 THEN a00 / n * ln(a00 * n / ((n - x1) * (n - n1))) ELSE 0 END) AS score FROM c2)"""))
def q_token_select_mi(spark, sf_dir):
    lab = S.doc_labels(spark, sf_dir)
    return finish(SEL.select_top_percent(SEL.mutual_info(_tok_long(spark, sf_dir), lab, "doc_id"), 10))


@register("stratified_fold_sizes", """
WITH c AS (SELECT quality AS target, count(*) AS n FROM labels GROUP BY quality)
SELECT target, CAST(f AS INTEGER) AS fold, n // 5 + CASE WHEN f < n % 5 THEN 1 ELSE 0 END AS n
FROM c, range(5) t(f)""")
def q_stratified_fold_sizes(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    f = stratified_kfold(lab, "doc_id", "target", 5, seed=239)
    return f.groupBy("target", "fold").agg(F.count(F.lit(1)).alias("n"))


def fold_sql(seed: int, key: str) -> str:
    """28 bits of the md5 of (seed, key), as ``window.hash_int``."""
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {key})), 1, 7) AS BIGINT)"


@register("doc_splits", f"""
SELECT doc_id, CAST({fold_sql(239, 'doc_id')} % 10 AS INTEGER) AS fold,
       CAST({fold_sql(17, 'doc_id')} / 268435456.0 < 0.2 AS INTEGER) AS is_test FROM documents""")
def q_doc_splits(spark, sf_dir):
    """Hash folds and hold-out flags."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    return train_test_split(kfold(d, "doc_id", 10, seed=239), "doc_id", 0.2, seed=17)
