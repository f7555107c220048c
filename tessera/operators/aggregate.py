"""Grouped statistics.

Most operators come in two forms: ``*_exprs`` returns aggregate Columns, so many
feature blocks share ONE ``groupBy(key).agg(...)`` (one shuffle, partial
aggregation map-side); the plain form runs that aggregation on its own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["safe_name", "basic_stats_exprs", "basic_stats", "value_range", "date_span_days_expr",
           "max_category", "true_mode", "pivot_count_exprs", "pivot_agg_exprs", "pivot_count",
           "pivot_agg", "one_hot_aggregate_exprs", "max_per_key", "count_distinct", "two_level_agg",
           "share", "exact_quantiles", "describe", "value_counts", "corr_pairs", "normality_test",
           "drop_duplicates", "score_summary", "fold_test_average", "drop_outliers"]


def safe_name(v) -> str:
    """Column-name-safe lower-case token of a category value."""
    return re.sub(r"[^0-9a-zA-Z]+", "_", str(v)).strip("_").lower() or "empty"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basic_stats_exprs(col, prefix: str, fill_std: bool = True) -> list[Column]:
    """count, sum, mean, max, min, sample std (null for one row, 0 after fill)."""
    c = _c(col)
    std = F.stddev_samp(c)
    if fill_std:
        std = F.coalesce(std, F.lit(0.0))
    return [F.count(c).alias(f"{prefix}_count"), F.sum(c).alias(f"{prefix}_sum"),
            F.avg(c).alias(f"{prefix}_mean"), F.max(c).alias(f"{prefix}_max"),
            F.min(c).alias(f"{prefix}_min"), std.alias(f"{prefix}_std")]


def basic_stats(df: DataFrame, key, col, prefix: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(*basic_stats_exprs(col, prefix or str(col)))


def value_range(col) -> Column:
    """max - min (A2)."""
    return F.max(_c(col)) - F.min(_c(col))


def date_span_days_expr(ts) -> Column:
    """Whole days between first and last event (A3): floor(seconds / 86400)."""
    t = _c(ts).cast("timestamp")
    return F.floor((F.unix_timestamp(F.max(t)) - F.unix_timestamp(F.min(t))) / F.lit(86400)).cast("long")


def max_category(col) -> Column:
    """The reference's "mode" is the largest value (A4)."""
    return F.max(_c(col))


def true_mode(col) -> Column:
    """Most frequent value, smallest on ties (deterministic)."""
    return F.mode(_c(col), deterministic=True)


def pivot_count_exprs(cat, values, prefix: str) -> list[Column]:
    """Count per declared category value, 0 when absent (A5). No extra pass for distinct values."""
    c = _c(cat)
    return [F.count_if(c == F.lit(v)).alias(f"{prefix}{safe_name(v)}") for v in values]


def pivot_agg_exprs(cat, val, values, fn: str, prefix: str, fill=0.0) -> list[Column]:
    """sum / avg / max / min / stddev of ``val`` per category value."""
    c, v = _c(cat), _c(val)
    fns = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max, "min": F.min,
           "std": F.stddev_samp, "count": F.count}
    out = []
    for x in values:
        e = fns[fn](F.when(c == F.lit(x), v))
        if fill is not None:
            e = F.coalesce(e, F.lit(fill))
        out.append(e.alias(f"{prefix}{safe_name(x)}"))
    return out


def pivot_count(df: DataFrame, key, cat, values, prefix: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(*pivot_count_exprs(cat, values, prefix or f"{cat}_"))


def pivot_agg(df: DataFrame, key, cat, val, values, fn: str, prefix: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(*pivot_agg_exprs(cat, val, values, fn, prefix or f"{fn}_{val}_"))


def one_hot_aggregate_exprs(cat, values, fns=("avg", "sum", "min", "max"), prefix: str = "oh_") -> list[Column]:
    """One-hot the category, then mean / sum / min / max of each indicator per key."""
    c = _c(cat)
    f = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max}
    return [f[fn](F.when(c == F.lit(v), 1).otherwise(0)).alias(f"{prefix}{fn}_{safe_name(v)}")
            for fn in fns for v in values]


def max_per_key(df: DataFrame, key, cols, how: str = "max") -> DataFrame:
    """Label columns collapsed by max (or min) per key (A10)."""
    f = F.max if how == "max" else F.min
    return df.groupBy(key).agg(*[f(c).alias(c) for c in cols])


def count_distinct(df: DataFrame, key, col, name: str | None = None, approx: bool = False) -> DataFrame:
    """Distinct values per key."""
    e = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.groupBy(key).agg(e.alias(name or f"nuniq_{col}"))


def two_level_agg(df: DataFrame, key, sub, prefix: str = "rows_per_") -> DataFrame:
    """Rows per (key, sub), then max and mean over sub per key (A12). Two aggregations,
    the second on the much smaller per-(key, sub) table."""
    inner = df.groupBy(key, sub).agg(F.count(F.lit(1)).alias("_n"))
    return inner.groupBy(key).agg(F.max("_n").alias(f"{prefix}{sub}_max"),
                                  F.avg("_n").alias(f"{prefix}{sub}_mean"))


def share(num, den) -> Column:
    """Ratio, null when the denominator is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def exact_quantiles(df: DataFrame, col: str, probs, by=()) -> DataFrame:
    """Linear-interpolated quantiles (A26), one row per group: ``by`` columns, then q0, q1, ...
    in the order of ``probs``.

    Equal values are counted first; the running count over value ranges (``prefix_sums``) gives
    every value's order positions, and the two order statistics of each quantile are picked by
    aggregation. No buffer holds a group's values."""
    from tessera.operators.ranks import prefix_sums
    by = list(by)
    counts = df.filter(F.col(col).isNotNull()).groupBy(*by, F.col(col).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_cnt"))
    runs = prefix_sums(counts, "_v", "_cnt", partition_cols=by)
    totals = df.filter(F.col(col).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    if by:
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
        cond = same[0]
        for x in same[1:]:
            cond = cond & x
        joined = runs.alias("r").join(totals.alias("t"), cond)
    else:
        joined = runs.alias("r").crossJoin(F.broadcast(totals).alias("t"))  # one row
    first, past = F.col("_cnt_before"), F.col("_cnt_before") + F.col("_cnt")
    aggs = []
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("_n") - 1)
        for name, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(F.max(F.when((at >= first) & (at < past), F.col("_v"))).alias(f"_{name}{i}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_f{i}"))
    got = joined.groupBy(*[F.col(f"r.{c}").alias(c) for c in by]).agg(*aggs)
    return got.select(*by, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q{i}")
                             for i in range(len(list(probs)))])


def drop_outliers(df: DataFrame, col: str, q: float, keep: str = "below") -> DataFrame:
    """Rows above (or below) the q-quantile removed (P12). The quantile is one scalar subquery."""
    thr = exact_quantiles(df, col, [q]).scalar()
    return df.filter(F.col(col) <= thr) if keep == "below" else df.filter(F.col(col) > thr)


def describe(df: DataFrame, cols) -> DataFrame:
    """count, mean, population-free sample std, min, quartiles, max per column (A27), long form:
    one row per (column, statistic)."""
    exprs = []
    for c in cols:
        x = F.col(c).cast("double")
        exprs += [F.count(x).cast("double").alias(f"{c}|count"), F.avg(x).alias(f"{c}|mean"),
                  F.stddev_samp(x).alias(f"{c}|std"), F.min(x).alias(f"{c}|min"), F.max(x).alias(f"{c}|max")]

    def stacked(wide: DataFrame) -> DataFrame:
        return wide.select(F.explode(F.array(*[
            F.struct(F.lit(n.split("|")[0]).alias("column"), F.lit(n.split("|")[1]).alias("statistic"),
                     F.col(f"`{n}`").alias("value")) for n in wide.columns])).alias("s")).select("s.*")

    out = stacked(df.agg(*exprs))
    for c in cols:
        q = exact_quantiles(df, c, [0.25, 0.5, 0.75])
        out = out.unionByName(stacked(q.toDF(f"{c}|25%", f"{c}|50%", f"{c}|75%")))
    return out


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """Frequency table, largest first."""
    d = df.filter(F.col(col).isNotNull()) if dropna else df
    return d.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first(col))


def corr_pairs(df: DataFrame, cols, method: str = "pearson") -> DataFrame:
    """Correlation of every column pair (A29), long form (a, b, corr).

    pearson: ``corr`` in one aggregation. spearman: Pearson on average ranks
    (ranks from ``tessera.operators.ranks``). kendall: see ``metrics.kendall_tau``.
    """
    if method == "spearman":
        from tessera.operators.ranks import average_rank
        ranked = df
        for c in cols:
            ranked = average_rank(ranked, c, f"_r_{c}")
        src, names = ranked, [f"_r_{c}" for c in cols]
    elif method == "pearson":
        src, names = df, list(cols)
    else:
        raise ValueError("method must be pearson or spearman (kendall: metrics.kendall_tau)")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = src.agg(*[F.corr(names[cols.index(a)], names[cols.index(b)]).alias(f"{a}|{b}") for a, b in pairs])
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("corr"))
        for a, b in pairs])).alias("s")).select("s.*")


def normality_test(df: DataFrame, col: str) -> DataFrame:
    """D'Agostino-Pearson K^2 from power sums in one aggregation.

    Skewness and kurtosis z-scores follow D'Agostino (1970) and Anscombe-Glynn
    (1983); p = exp(-K2/2) (chi-square, 2 degrees of freedom)."""
    x = F.col(col).cast("double")
    a = df.agg(F.count(x).cast("double").alias("n"), F.skewness(x).alias("g1"),
               F.kurtosis(x).alias("g2"))
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta2 - 1))
    delta = 1 / F.sqrt(F.log(F.sqrt(w2)))
    alpha = F.sqrt(2.0 / (w2 - 1))
    ya = y / alpha
    z1 = delta * F.log(ya + F.sqrt(ya * ya + 1))
    b2 = g2 + 3
    e = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    xk = (b2 - e) / F.sqrt(var)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    aa = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1 + 4.0 / (sb1 * sb1)))
    t1 = 1 - 2 / (9.0 * aa)
    den = 1 + xk * F.sqrt(2 / (aa - 4.0))
    t2 = F.signum(den) * F.pow(F.abs((1 - 2 / aa) / den), 1.0 / 3)
    z2 = (t1 - t2) / F.sqrt(2 / (9.0 * aa))
    k2 = z1 * z1 + z2 * z2
    return a.select("n", k2.alias("k2"), F.exp(-k2 / 2).alias("p_value"),
                    (F.exp(-k2 / 2) >= 0.05).cast("int").alias("normal_at_05"))


def drop_duplicates(df: DataFrame, subset=None, order=None) -> DataFrame:
    """Full-row distinct, or first row per key in an explicit order."""
    if subset is None:
        return df.dropDuplicates()
    from tessera.operators.window import first_per_key
    return first_per_key(df, subset, order)


def score_summary(df: DataFrame, score: str, by=None) -> DataFrame:
    """Mean and population std of fold scores."""
    g = df.groupBy(by) if by else df.groupBy()
    return g.agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))


def fold_test_average(df: DataFrame, key: str, score: str, name: str = "score") -> DataFrame:
    """Per-id mean of the fold models' test scores (A36; true mean, not a fixed 0.1 weight)."""
    return df.groupBy(key).agg(F.avg(score).alias(name))
