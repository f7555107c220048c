"""Feature encoding (M1-M9, M14-M17): fit = small aggregate, transform = projection or join.

Fitted parameters (means, scales, vocabularies) stay DataFrames joined back by
key, except a handful of per-column scalars that become literals.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranks import prefix_sums

__all__ = ["label_encode", "one_hot", "standard_scale", "minmax_scale", "maxabs_scale", "maxabs_scale_long",
           "robust_scale", "row_normalise", "dict_vectorise", "tfidf", "target_encode", "target_encode_oof",
           "encode_split", "assemble"]


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Category -> 0-based index in sorted order (M1). The index table is a distributed
    dense rank over the distinct values, joined back."""
    out = out or f"{col}_le"
    d = df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1))
    idx = prefix_sums(d, col, "_one").select(col, F.col("_one_before").cast("int").alias(out))
    return df.join(idx, col, "left")


def one_hot(df: DataFrame, col: str, values, prefix: str | None = None) -> DataFrame:
    """0/1 column per declared value (M2)."""
    p = prefix if prefix is not None else f"{col}_"
    return df.withColumns({f"{p}{v}": (F.col(col) == F.lit(v)).cast("int") for v in values})


def _stats(train: DataFrame, cols, exprs) -> dict:
    row = train.agg(*[e(c).alias(f"{k}|{c}") for c in cols for k, e in exprs.items()]).first()
    return row.asDict()


def standard_scale(train: DataFrame, df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x - mean) / population std of train; zero std -> 1 (M3)."""
    st = _stats(train, cols, {"m": F.avg, "s": F.stddev_pop})
    out = {}
    for c in cols:
        s = st[f"s|{c}"] or 0.0
        out[f"{c}{suffix}"] = (F.col(c) - F.lit(st[f"m|{c}"])) / F.lit(s if s != 0 else 1.0)
    return df.withColumns(out)


def minmax_scale(train: DataFrame, df: DataFrame, cols, lo: float = 0.0, hi: float = 1.0,
                 suffix: str = "") -> DataFrame:
    """Rescale to [lo, hi] with train's min and max; constant column -> lo (M4)."""
    st = _stats(train, cols, {"lo": F.min, "hi": F.max})
    out = {}
    for c in cols:
        mn, mx = st[f"lo|{c}"], st[f"hi|{c}"]
        rng = (mx - mn) if mx is not None and mn is not None and mx != mn else 1.0
        out[f"{c}{suffix}"] = F.lit(lo) + (F.col(c) - F.lit(mn)) / F.lit(rng) * F.lit(hi - lo)
    return df.withColumns(out)


def maxabs_scale(train: DataFrame, df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """Divide by train's max |x|; zero column stays (M5)."""
    st = _stats(train, cols, {"a": lambda c: F.max(F.abs(c))})
    return df.withColumns({f"{c}{suffix}": F.col(c) / F.lit(st[f"a|{c}"] or 1.0) for c in cols})


def maxabs_scale_long(train_long: DataFrame, long: DataFrame, keys=("src", "key"), value: str = "value") -> DataFrame:
    """Sparse form of M5: per-key max |value| from train joined back (keys unseen in train -> dropped)."""
    keys = list(keys)
    m = train_long.groupBy(*keys).agg(F.max(F.abs(value)).alias("_ma")).filter(F.col("_ma") > 0)
    return long.join(m, keys, "inner").withColumn(value, F.col(value) / F.col("_ma")).drop("_ma")


def robust_scale(train: DataFrame, df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """(x - median) / IQR of train (M6); zero IQR -> 1. Scales the column, not one row."""
    from tessera.operators.aggregate import exact_quantiles
    out = {}
    for c in cols:
        q1, q2, q3 = exact_quantiles(train, c, [0.25, 0.5, 0.75]).first()
        iqr = (q3 or 0.0) - (q1 or 0.0)
        out[f"{c}{suffix}"] = (F.col(c) - F.lit(q2)) / F.lit(iqr if iqr != 0 else 1.0)
    return df.withColumns(out)


def row_normalise(long: DataFrame, row_key, p: str = "l2", value: str = "value") -> DataFrame:
    """Each row (user) of a long table divided by its L1 or L2 norm; zero rows stay (M7)."""
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    over = Window.partitionBy(*keys)
    norm = F.sum(F.abs(value)).over(over) if p == "l1" else F.sqrt(F.sum(F.col(value) * F.col(value)).over(over))
    # a row of a table with a null key stays; the table is made and moved once, not once more for the norms
    known = functools.reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return long.withColumn("_norm", F.when(known, norm)).withColumn(
        value, F.when(F.col("_norm") > 0, F.col(value) / F.col("_norm")).otherwise(F.col(value))).drop("_norm")


def dict_vectorise(train_long: DataFrame, long: DataFrame, keys=("src", "key"), out: str = "col_idx"):
    """Key -> column index fitted on train (sorted keys, 0-based), unknown keys dropped (M8).
    Returns (indexed long table, vocabulary table)."""
    keys = list(keys)
    comp = F.concat_ws("\u0001", *[F.col(k).cast("string") for k in keys])
    voc = train_long.select(*keys).distinct().withColumn("_k", comp).withColumn("_one", F.lit(1))
    voc = prefix_sums(voc, "_k", "_one").select(*keys, F.col("_one_before").cast("int").alias(out))
    return long.join(voc, keys, "inner"), voc


def tfidf(tokens: DataFrame, doc: str = "doc_id", term: str = "token", min_df=1, max_df=1.0,
          max_features: int | None = None, smooth: bool = True, norm: str | None = "l2",
          docs: DataFrame | None = None) -> DataFrame:
    """Term counts x idf, row L2 norm (M9), long form (doc, term, tf, idf, tfidf).

    idf = ln((1 + n) / (1 + df)) + 1 (smooth) or ln(n / df) + 1. ``min_df`` / ``max_df``
    are document counts (int) or fractions (float); ``max_features`` keeps the terms with
    the largest total count (ties by term). n counts every row of ``docs``, documents without a
    term too; without ``docs`` only those that have one."""
    # A row needs a document and a term (the per-document norm join drops null documents
    # anyway). ``tf`` feeds four branches (n_docs, df, the weights, the norms): write it
    # once to the checkpoint folder instead of tokenising the raw text four times.
    from tessera.session import packed_table
    tokens = tokens.filter(F.col(doc).isNotNull() & F.col(term).isNotNull())
    tf = packed_table(tokens.groupBy(doc, term).agg(F.count(F.lit(1)).alias("tf")))
    n_docs = (tf if docs is None else docs).select(F.countDistinct(doc)).scalar()
    dfs = tf.groupBy(term).agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("_tot"))

    def bound(x):
        return F.lit(x) if isinstance(x, int) else F.lit(float(x)) * n_docs
    dfs = dfs.filter((F.col("df") >= bound(min_df)) & (F.col("df") <= bound(max_df)))
    if max_features:
        dfs = dfs.orderBy(F.desc("_tot"), term).limit(max_features)
    num = (F.lit(1.0) + n_docs) if smooth else n_docs.cast("double")
    den = (F.lit(1.0) + F.col("df")) if smooth else F.col("df").cast("double")
    dfs = dfs.select(term, "df", (F.log(num / den) + 1).alias("idf"))
    w = tf.join(dfs, term, "inner").withColumn("tfidf", F.col("tf") * F.col("idf"))
    if norm == "l2":
        w = row_normalise(w, doc, "l2", "tfidf")
    elif norm == "l1":
        w = row_normalise(w, doc, "l1", "tfidf")
    return w.select(doc, term, "tf", "df", "idf", "tfidf")


def target_encode(train: DataFrame, df: DataFrame, col: str, target: str = "target", k: float = 10.0,
                  out: str | None = None) -> DataFrame:
    """(mean * count + k * global mean) / (count + k) from train; unseen category -> null."""
    out = out or f"{col}_te"
    g = train.select(F.avg(target)).scalar()
    st = train.groupBy(col).agg(F.avg(target).alias("_m"), F.count(F.lit(1)).alias("_n"))
    enc = st.select(col, ((F.col("_m") * F.col("_n") + F.lit(k) * g) / (F.col("_n") + F.lit(k))).alias(out))
    return df.join(enc, col, "left")


def target_encode_oof(train: DataFrame, col: str, fold: str = "fold", target: str = "target",
                      k: float = 10.0, out: str | None = None) -> DataFrame:
    """Out-of-fold encoding (M15): each row's statistics come from the OTHER folds; the global
    mean is over all train rows. One aggregation per (col, fold) and its per-col totals,
    no loop over folds. A category absent from the other folds -> null."""
    out = out or f"{col}_te"
    g = train.select(F.avg(target)).scalar()
    per = train.groupBy(col, fold).agg(F.sum(target).alias("_s_fold"), F.count(F.lit(1)).alias("_n_fold"))
    tot = per.groupBy(col).agg(F.sum("_s_fold").alias("_s_all"), F.sum("_n_fold").alias("_n_all"))
    st = per.join(tot, col)
    n_other = F.col("_n_all") - F.col("_n_fold")
    mean_other = F.try_divide(F.col("_s_all") - F.col("_s_fold"), n_other.cast("double"))
    enc = st.select(col, fold, F.when(n_other > 0, (mean_other * n_other + F.lit(k) * g) / (n_other + F.lit(k)))
                    .alias(out))
    return train.join(enc, [col, fold], "left")


def encode_split(train: DataFrame, others, col: str, fold: str = "fold", target: str = "target",
                 k: float = 10.0):
    """M15 on train, M14 (fitted on all train) on each other frame."""
    tr = target_encode_oof(train, col, fold, target, k)
    return [tr] + [target_encode(train, o, col, target, k) for o in others]


def assemble(df: DataFrame, cols, out: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """Dense columns side by side into one vector column."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid).transform(df)
