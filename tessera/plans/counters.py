"""Per-user marts over a clickstream with JSON counter maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.maps import map_size, map_sum
from tessera.operators import aggregate as A
from tessera.operators.counters import distinct_flags_count, distinct_map_keys, map_value_sum, pivot_with_total, with_maps
from tessera.operators.window import argmax_of_columns


def _row_stats(df: DataFrame, srcs) -> DataFrame:
    cols = {}
    for s in srcs:
        cols[f"num_keys_{s}"] = map_size(s)
        cols[f"sum_values_{s}"] = map_sum(s)
    return df.withColumns(cols)


def counter_features(clicks: DataFrame, cats, srcs) -> DataFrame:
    """The 32-column user mart (M18): category counts, records, day bounds, and std / max /
    mean of per-row map sizes and sums. ONE aggregation by uid."""
    df = _row_stats(with_maps(clicks, srcs), srcs)
    aggs = [F.count_if(F.col("cat") == F.lit(c)).alias(f"num_times_cat_eq_{i}") for i, c in enumerate(cats)]
    aggs += [F.count(F.lit(1)).alias("records"), F.max("days").alias("max_days"), F.min("days").alias("min_days")]
    fns = {"std": F.stddev_samp, "max": F.max, "mean": F.avg}
    for fun, f in fns.items():
        for s in srcs:
            for c in ("sum_values_", "num_keys_"):
                aggs.append(f(f"{c}{s}").alias(f"{c}{s}_{fun}"))
    return df.groupBy("uid").agg(*aggs)


def extended_counter_features(clicks: DataFrame, cats, srcs) -> DataFrame:
    """M18 subset + rows-per-day max/mean (A12), distinct keys and value sums per category
    with totals (A13-A15), most frequent category (W3), number of categories used (A23),
    distinct days (A11). Three aggregations, all hash-partitioned by uid, so the final
    joins need no further exchange."""
    df = _row_stats(with_maps(clicks, srcs), srcs)
    base_aggs = [F.count_if(F.col("cat") == F.lit(c)).alias(f"num_times_cat_eq_{i}") for i, c in enumerate(cats)]
    base_aggs += [F.count(F.lit(1)).alias("records"), F.max("days").alias("max_days"),
                  F.min("days").alias("min_days"), F.countDistinct("days").alias("unique_days")]
    for fun, f in {"max": F.max, "mean": F.avg}.items():
        for s in srcs:
            for c in ("sum_values_", "num_keys_"):
                base_aggs.append(f(f"{c}{s}").alias(f"{c}{s}_{fun}"))
    base = df.groupBy("uid").agg(*base_aggs)
    per_day = A.two_level_agg(df.select("uid", "days"), "uid", "days", prefix="_").select(
        "uid", F.col("_days_max").alias("max_day_cntr"), F.col("_days_mean").alias("mean_day_cntr"))
    # distinct keys and value sums per (uid, cat), spread over the categories with totals
    keys = distinct_map_keys(df, ["uid", "cat"], srcs)
    keys = keys.groupBy("uid", "cat").agg(*[
        F.coalesce(F.max(F.when(F.col("src") == F.lit(s), F.col("nuniq_keys"))), F.lit(0)).alias(f"nuniq_{s}") for s in srcs])
    per_cat = map_value_sum(df, ["uid", "cat"], srcs).join(keys, ["uid", "cat"], "left")
    names = {f"nuniq_{s}": f"nuniq_keys_{s}" for s in srcs} | {f"sumval_{s}": f"sumval_keys_{s}" for s in srcs}
    spread = pivot_with_total(per_cat, "uid", "cat", cats, list(names), names)
    out = base.join(per_day, "uid", "left").join(spread, "uid", "left")
    cat_cols = [f"num_times_cat_eq_{i}" for i in range(len(cats))]
    out = out.fillna(0, subset=[c for c in out.columns if c.startswith(("nuniq_keys_", "sumval_keys_"))])
    return out.withColumns({"most_freq_cat": argmax_of_columns(cat_cols),
                            "diff_num_cats": distinct_flags_count(cat_cols)})


def base_features(clicks: DataFrame, cats, srcs, labels: DataFrame | None = None) -> DataFrame:
    """The earlier user mart (M20): one-hot category mean / sum / min / max, day offset
    bounds, mean and spread, per-source max / min / mean of map sizes and sums, smallest
    category index, row count; optional label (min per user)."""
    df = _row_stats(with_maps(clicks, srcs), srcs)
    cat_index = F.array_position(F.array(*[F.lit(c) for c in sorted(cats)]), F.col("cat")) - 1
    df = df.withColumn("cat_le", cat_index.cast("int"))
    aggs = A.one_hot_aggregate_exprs("cat", sorted(cats), prefix="cat_")
    aggs += [F.max("days").alias("max_date_diff"), F.min("days").alias("min_date_diff"),
             F.avg("days").alias("mean_date_diff"), A.value_range("days").alias("delta_date_diff")]
    for fun, f in {"max": F.max, "min": F.min, "mean": F.avg}.items():
        for s in srcs:
            aggs += [f(f"num_keys_{s}").alias(f"{fun}_count_{s}"), f(f"sum_values_{s}").alias(f"{fun}_sum_{s}")]
    aggs += [F.min("cat_le").alias("cat_min_le"), F.count(F.lit(1)).alias("count_rows")]
    out = df.groupBy("uid").agg(*aggs)
    if labels is not None:
        out = out.join(labels, "uid", "left")
    return out
