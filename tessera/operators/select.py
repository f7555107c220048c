"""Supervised key selection on long tables.

Keys (sparse columns) are scored from per-(key, class) sums; users without
the key contribute implicit zeros, recovered from the class totals, so the
sparse table is never densified. The top share is taken with a distributed
rank, not a driver-side sort.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import row_number_by_key

__all__ = ["anova_f", "mutual_info", "select_top_percent", "select_percentile_f", "select_percentile_mi"]


def _class_totals(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("_y")).agg(
        F.count(F.lit(1)).alias("n_c"))


def anova_f(long: DataFrame, labels: DataFrame, key: str, label: str = "target",
            feat=("src", "key"), value: str = "value") -> DataFrame:
    """One-way ANOVA F of each sparse key across classes, zeros included."""
    feat = list(feat)
    lab = labels.filter(F.col(label).isNotNull()).select(key, F.col(label).alias("_y"))
    nc = _class_totals(labels, key, label)
    n_total = nc.select(F.sum("n_c")).scalar()
    k_classes = nc.select(F.count(F.lit(1))).scalar()
    per = long.join(lab, key, "inner").groupBy(*feat, "_y").agg(
        F.sum(value).cast("double").alias("s"), F.sum(F.col(value) * F.col(value)).cast("double").alias("ss"))
    agg = per.join(F.broadcast(nc), "_y", "inner").groupBy(*feat).agg(
        F.sum("s").alias("S"), F.sum("ss").alias("SS"),
        F.sum(F.col("s") * F.col("s") / F.col("n_c")).alias("B"))
    # total mean = S / N; SSB = sum_c s_c^2 / n_c - S^2 / N; SSW = SS - sum_c s_c^2 / n_c
    ssb = F.col("B") - F.col("S") * F.col("S") / n_total
    ssw = F.col("SS") - F.col("B")
    # no spread inside the classes: a perfect separator has F = infinity, a constant key none
    tiny = F.col("SS") * 1e-12
    f = F.when(ssw > tiny, (ssb / (k_classes - 1)) / (ssw / (n_total - k_classes))) \
         .when(ssb > tiny, F.lit(float("inf")))
    return agg.select(*feat, f.alias("score"))


def mutual_info(long: DataFrame, labels: DataFrame, key: str, label: str = "target",
                feat=("src", "key"), value: str = "value") -> DataFrame:
    """Mutual information (nats) between key presence (value != 0) and a 0/1 label."""
    feat = list(feat)
    lab = labels.filter(F.col(label).isNotNull()).select(key, F.col(label).cast("int").alias("_y"))
    n = lab.select(F.count(F.lit(1)).cast("double")).scalar()
    n1 = lab.select(F.sum("_y").cast("double")).scalar()
    pres = long.filter(F.col(value) != 0).select(key, *feat).distinct().join(lab, key, "inner")
    cnt = pres.groupBy(*feat).agg(F.count_if(F.col("_y") == 1).cast("double").alias("a11"),
                                  F.count(F.lit(1)).cast("double").alias("x1"))
    a11 = F.col("a11")
    a10 = F.col("x1") - a11
    a01 = n1 - a11
    a00 = n - F.col("x1") - a01

    def term(nxy, nx, ny):
        return F.when(nxy > 0, nxy / n * F.log(nxy * n / (nx * ny))).otherwise(F.lit(0.0))
    mi = (term(a11, F.col("x1"), n1) + term(a10, F.col("x1"), n - n1) +
          term(a01, n - F.col("x1"), n1) + term(a00, n - F.col("x1"), n - n1))
    return cnt.select(*feat, mi.alias("score"))


def select_top_percent(scores: DataFrame, percent: float, feat=("src", "key"), digits: int = 9) -> DataFrame:
    """Keys with the best ``percent`` % of scores (ceil, ties by key), exact distributed rank:
    infinite scores first, undefined ones last. Scores equal to ``digits`` decimals count as
    ties (engine-independent order). Rows are ranked on (score, key) by range, so many keys
    of one score span many tasks."""
    from tessera.session import cut_lineage
    feat = list(feat)
    scores = cut_lineage(scores)  # the count, the ranges' sample and the ranks read it
    keep = int(math.ceil(scores.count() * percent / 100.0))
    undefined = F.col("score").isNull() | F.isnan("score")
    neg = F.when(undefined, F.lit(0.0)).otherwise(-F.round("score", digits))
    s = scores.withColumns({"_last": undefined.cast("int"), "_neg": neg})
    r = row_number_by_key(s, [], ["_last", "_neg", *feat], "_rank")
    return r.filter(F.col("_rank") < keep).select(*feat, "score")


def select_percentile_f(long: DataFrame, labels: DataFrame, key: str, percent: float, **kw) -> DataFrame:
    sel = select_top_percent(anova_f(long, labels, key, **kw), percent)
    return long.join(sel.select("src", "key"), ["src", "key"], "left_semi")


def select_percentile_mi(long: DataFrame, labels: DataFrame, key: str, percent: float, **kw) -> DataFrame:
    sel = select_top_percent(mutual_info(long, labels, key, **kw), percent)
    return long.join(sel.select("src", "key"), ["src", "key"], "left_semi")
