"""Registered queries over documents (+ labels): tokens, TF-IDF, encoders, vocabularies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.maps import array_length, array_max_or_zero
from tessera.functions.misc import log_root
from tessera.operators import encode as E
from tessera.operators.window import pad_or_truncate
from tessera.plans.registry import finish, register
from tessera.session import table
from tessera.sources import standins as S

TOKENS_SQL = r"""sp AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{L}]+') AS arr FROM documents),
toks AS (SELECT doc_id, pos, token FROM (
           SELECT doc_id, unnest(arr) AS token, unnest(range(len(arr))) AS pos FROM sp) WHERE length(token) > 0)"""
DOCLAB_SQL = """dl AS (SELECT d.doc_id, l.quality AS target FROM documents d LEFT JOIN labels l USING (doc_id))"""


@register("doc_tfidf", rf"""
WITH {TOKENS_SQL},
tf AS (SELECT doc_id, token, count(*) AS tf FROM toks GROUP BY 1, 2),
nd AS (SELECT count(*) + 1 AS n FROM documents),
dfs AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
keep AS (SELECT token, df, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM dfs, nd WHERE df >= 2 AND df <= 0.9 * n),
w AS (SELECT tf.doc_id, tf.token, tf.tf, keep.df, keep.idf, tf.tf * keep.idf AS x FROM tf JOIN keep USING (token)),
nrm AS (SELECT doc_id, sqrt(sum(x * x)) AS nn FROM w GROUP BY doc_id)
SELECT doc_id, token, tf, df, round(idf, 6) AS idf, round(CASE WHEN nn > 0 THEN x / nn ELSE x END, 6) AS tfidf
FROM w JOIN nrm USING (doc_id)""", headline=True)
def q_doc_tfidf(spark, sf_dir):
    """n counts all documents, and one more that has no text at all."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    docs = docs.unionByName(docs.agg((F.max("doc_id") + 1).alias("doc_id")))
    return finish(E.tfidf(S.doc_tokens(spark, sf_dir), "doc_id", "token", min_df=2, max_df=0.9, docs=docs))


@register("doc_label_encode", """
SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_le,
       source, CAST(dense_rank() OVER (ORDER BY source) - 1 AS INTEGER) AS source_le,
       CAST(lang = 'en' AS INTEGER) AS lang_en, CAST(lang = 'fr' AS INTEGER) AS lang_fr,
       CAST(lang = 'de' AS INTEGER) AS lang_de, CAST(lang = 'es' AS INTEGER) AS lang_es
FROM documents""")
def q_doc_label_encode(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    d = E.label_encode(E.label_encode(d, "lang"), "source")
    return E.one_hot(d, "lang", ["en", "fr", "de", "es"]).select(
        "doc_id", "lang", "lang_le", "source", "source_le", "lang_en", "lang_fr", "lang_de", "lang_es")


def _doc_numeric(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    ntok = S.doc_tokens(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))
    return d.join(ntok, "doc_id", "left").fillna(0, subset=["n_tokens"]).join(lab, "doc_id", "left")


_SCALE_SQL = rf"""
WITH {TOKENS_SQL}, {DOCLAB_SQL},
nt AS (SELECT doc_id, count(*) AS n_tokens FROM toks GROUP BY doc_id),
d AS (SELECT documents.doc_id, n_chars, coalesce(n_tokens, 0) AS n_tokens, dl.target
      FROM documents LEFT JOIN nt USING (doc_id) LEFT JOIN dl USING (doc_id)),
tr AS (SELECT * FROM d WHERE target IS NOT NULL),
st AS (SELECT avg(n_chars) AS m_c, stddev_pop(n_chars) AS s_c, avg(n_tokens) AS m_t, stddev_pop(n_tokens) AS s_t,
              min(n_chars) AS lo_c, max(n_chars) AS hi_c, max(abs(n_tokens)) AS ma_t,
              quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS q2, quantile_cont(n_chars, 0.75) AS q3
       FROM tr)
SELECT doc_id,
  round((n_chars - m_c) / CASE WHEN s_c = 0 THEN 1 ELSE s_c END, 6) AS n_chars_std,
  round((n_tokens - m_t) / CASE WHEN s_t = 0 THEN 1 ELSE s_t END, 6) AS n_tokens_std,
  round(-1 + (n_chars - lo_c) / CASE WHEN hi_c = lo_c THEN 1 ELSE hi_c - lo_c END * 2, 6) AS n_chars_mm,
  round(n_tokens / CASE WHEN ma_t = 0 THEN 1 ELSE ma_t END, 6) AS n_tokens_ma,
  round((n_chars - q2) / CASE WHEN q3 - q1 = 0 THEN 1 ELSE q3 - q1 END, 6) AS n_chars_rb,
  round(sqrt(ln(1 + n_chars)), 6) AS n_chars_lr
FROM d, st"""


@register("doc_scaling", _SCALE_SQL)
def q_doc_scaling(spark, sf_dir):
    d = _doc_numeric(spark, sf_dir)
    tr = d.filter(F.col("target").isNotNull())
    d = E.standard_scale(tr, d, ["n_chars", "n_tokens"], suffix="_std")
    d = E.minmax_scale(tr, d, ["n_chars"], lo=-1.0, hi=1.0, suffix="_mm")
    d = E.maxabs_scale(tr, d, ["n_tokens"], suffix="_ma")
    d = E.robust_scale(tr, d, ["n_chars"], suffix="_rb")
    d = d.withColumn("n_chars_lr", log_root("n_chars"))
    return finish(d.select("doc_id", "n_chars_std", "n_tokens_std", "n_chars_mm", "n_tokens_ma",
                           "n_chars_rb", "n_chars_lr"))


def _vocab(spark, sf_dir):
    toks = S.doc_tokens(spark, sf_dir).withColumn("src", F.lit("tok")).withColumnRenamed("token", "key")
    lab = table(spark, sf_dir, "labels").select("doc_id")
    train = toks.join(lab, "doc_id", "left_semi")
    indexed, voc = E.dict_vectorise(train, toks, keys=("src", "key"))
    return indexed, voc


@register("doc_vocabulary", rf"""
WITH {TOKENS_SQL},
tr AS (SELECT DISTINCT token FROM toks WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT 'tok' AS src, token AS key, CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS col_idx FROM tr""")
def q_doc_vocabulary(spark, sf_dir):
    return _vocab(spark, sf_dir)[1]


@register("doc_index_sequences", rf"""
WITH {TOKENS_SQL},
tr AS (SELECT DISTINCT token FROM toks WHERE doc_id IN (SELECT doc_id FROM labels)),
voc AS (SELECT token, CAST(row_number() OVER (ORDER BY token) AS INTEGER) AS id FROM tr),
s AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM toks JOIN voc USING (token) GROUP BY doc_id)
SELECT doc_id, list_resize(coalesce(ids, []), 50, 0) AS seq, CAST(coalesce(len(ids), 0) AS INTEGER) AS n_ids, coalesce(list_max(ids), 0) AS max_id
FROM documents LEFT JOIN s USING (doc_id)""")
def q_doc_index_sequences(spark, sf_dir):
    indexed, _ = _vocab(spark, sf_dir)
    ids = indexed.select("doc_id", "pos", (F.col("col_idx") + 1).alias("id"))
    seq = ids.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_s")) \
             .select("doc_id", F.transform("_s", lambda x: x["id"]).alias("ids"))
    seq = table(spark, sf_dir, "documents").select("doc_id").join(seq, "doc_id", "left") \
        .withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))  # no known word: all padding
    return seq.select("doc_id", pad_or_truncate("ids", 50).alias("seq"), array_length("ids").alias("n_ids"),
                      array_max_or_zero("ids").alias("max_id"))


@register("doc_row_normalise", rf"""
WITH {TOKENS_SQL},
tf AS (SELECT doc_id, token, count(*) AS value FROM toks GROUP BY 1, 2),
n AS (SELECT doc_id, sum(abs(value)) AS l1 FROM tf GROUP BY doc_id)
SELECT doc_id, count(*) AS n_terms, round(max(value / l1), 6) AS max_share, round(sum(value / l1), 6) AS total
FROM tf JOIN n USING (doc_id) GROUP BY doc_id""")
def q_doc_row_normalise(spark, sf_dir):
    tf = S.doc_tokens(spark, sf_dir).groupBy("doc_id", "token").agg(F.count(F.lit(1)).cast("double").alias("value"))
    n = E.row_normalise(tf, "doc_id", "l1")
    return finish(n.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"), F.max("value").alias("max_share"),
                                          F.sum("value").alias("total")))
