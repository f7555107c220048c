"""Exact evaluation metrics (A31-A33, A35, E23) without pairing rows.

* ROC AUC (A31): Mann-Whitney form. Rows collapse to (group, score) -> (pos, neg);
  a distributed ordered prefix sum gives the negatives below each score.
* Kendall tau-b (A33): n0 - n1 - n2 + n3 - 2 * discordant, where the discordant
  count is a weighted inversion count in bounded groups (see ``inversions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.inversions import DIGIT_BITS, LEAF, discordant_weight, weighted_inversions
from tessera.operators.ranks import average_rank, prefix_sums

__all__ = ["roc_auc", "auc_by_column", "log_loss", "kendall_tau", "spearman", "weighted_inversions",
           "score_by_model"]


def roc_auc(df: DataFrame, label: str, score: str, by=(), name: str = "auc") -> DataFrame:
    """Area under the ROC curve per group (ties count one half). Exact."""
    by = [by] if isinstance(by, str) else list(by)
    y = F.col(label).cast("long")
    t = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()) \
          .groupBy(*by, score).agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    # prefix_sums reads t twice (split points, then sums): write it once (one row per
    # distinct score) instead of recomputing the input pipeline
    from tessera.session import cut_lineage
    t = prefix_sums(cut_lineage(t), score, ["_neg"], partition_cols=by)
    agg = t.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_neg_before") + 0.5 * F.col("_neg"))).alias("_num"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))
    return agg.select(*by, F.try_divide(F.col("_num"), F.col("n_pos") * F.col("n_neg")).alias(name),
                      "n_pos", "n_neg")


def auc_by_column(df: DataFrame, label: str, cols, by=()) -> DataFrame:
    """AUC of each score column (E23): columns stacked into long form, one grouped AUC."""
    by = [by] if isinstance(by, str) else list(by)
    stacked = df.select(*by, label, F.explode(F.array(*[
        F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("score")) for c in cols])).alias("s"))
    long = stacked.select(*by, label, "s.model", "s.score")
    return roc_auc(long, label, "score", by=[*by, "model"])


def log_loss(df: DataFrame, label: str, prob: str, by=(), eps: float = 1e-15, name: str = "log_loss") -> DataFrame:
    """Mean cross-entropy with probabilities clipped to [eps, 1 - eps]."""
    by = [by] if isinstance(by, str) else list(by)
    p = F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(prob).cast("double")))
    y = F.col(label).cast("double")
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias(name))


def spearman(df: DataFrame, a: str, b: str, name: str = "spearman") -> DataFrame:
    """Pearson correlation of average ranks (A29, Spearman)."""
    r = average_rank(average_rank(df.select(a, b), a, "_ra"), b, "_rb")
    return r.agg(F.corr("_ra", "_rb").alias(name))


def kendall_tau(df: DataFrame, a: str, b: str, n_buckets: int | None = None, name: str = "tau_b",
                leaf: int = LEAF, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """Kendall tau-b of two numeric columns, exact, without pairing rows.

    S = n0 - n1 - n2 + n3 - 2D with n1, n2, n3 the tied pairs in a, in b and in
    both, and D the pairs with a_i < a_j and b_i > b_j. Rows collapse to distinct
    (a, b) with weights; D is the weighted inversion count of ``inversions``, whose
    groups hold at most ``leaf`` rows at any size and any skew. ``n_buckets`` lowers
    ``leaf`` until there are at least so many groups. Null and NaN rows take no part; a column
    of one value gives null.
    """
    pairs = (df.select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
             .dropna().groupBy("a", "b").agg(F.count(F.lit(1)).alias("w")))
    from tessera.session import cut_lineage
    pairs = cut_lineage(pairs)
    if n_buckets is not None:
        leaf = min(leaf, 1 << (max(1, pairs.count() // n_buckets).bit_length() - 1))
    disc = discordant_weight(pairs, "a", "b", "w", leaf, digit_bits)

    def tied(cols):
        return pairs.groupBy(*cols).agg(F.sum("w").alias("t")).agg(
            F.coalesce(F.sum(F.col("t") * (F.col("t") - 1) / 2), F.lit(0)).alias("x"))

    # every part is a one-row aggregate: combine them as scalar subqueries
    row = pairs.agg(F.sum("w").cast("double").alias("n")).select(
        "n", tied(["a"]).scalar().alias("n1"), tied(["b"]).scalar().alias("n2"),
        tied(["a", "b"]).scalar().alias("n3"), F.coalesce(disc.scalar(), F.lit(0)).alias("d"))
    n0 = F.col("n") * (F.col("n") - 1) / 2
    s = n0 - F.col("n1") - F.col("n2") + F.col("n3") - 2 * F.col("d").cast("double")
    tau = F.try_divide(s, F.sqrt((n0 - F.col("n1")) * (n0 - F.col("n2"))))
    return row.select(tau.alias(name), F.col("d").cast("long").alias("discordant"), F.col("n").cast("long").alias("n"))


def score_by_model(df: DataFrame, label: str, cols) -> DataFrame:
    """AUC of each model column (E23); correlations via ``aggregate.corr_pairs``."""
    return auc_by_column(df, label, cols)
