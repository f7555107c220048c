"""Client feature mart from a transaction log (M21, A8), one aggregation by client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import is_weekend
from tessera.operators import aggregate as A
from tessera.operators.clean import map_values, mask_amount
from tessera.operators.joins import lookup

# Fixed values of the stand-in: balance sign per channel ('P' is unmapped -> null).
CHANNEL_SIGN = {"F": 1, "O": -1}
WEEKDAYS = list(range(7))


def transaction_features(tx: DataFrame, groups: DataFrame | None, categories, channels) -> DataFrame:
    """One row per client: counts, sums, spread, sign of the mean balance, span in days,
    largest merchant group, one-hot of the largest channel, per-category counts and sums,
    mean amount per weekday (Monday = 0). One shuffle by ``cl_id``."""
    if groups is not None:
        tx = lookup(tx, groups, "mcc")
    balance = map_values("channel_type", CHANNEL_SIGN) * F.col("amount")
    tx = tx.withColumns({"balance": balance, "weekday": F.weekday("ts"), "weekend": is_weekend("ts")})
    aggs = [
        F.count(F.lit(1)).alias("count_tr"),
        F.sum("amount").alias("sum_tr"),
        F.avg("amount").alias("mean_amount"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("std_amount"),
        A.value_range("amount").alias("delta_amount"),
        F.coalesce((F.avg("balance") > 0).cast("int"), F.lit(0)).alias("sign"),
        A.date_span_days_expr("ts").alias("delta_first_end_tr"),
        F.avg("weekend").alias("weekend_share"),
    ]
    if groups is not None:
        aggs.append(A.max_category("mcc_group").alias("mode_mcc_group"))
    # One-hot of the largest channel without a string max (which would force a sort-based
    # aggregation): c is the largest iff c occurs and no larger value occurs. Null when the
    # client has no channel at all, as (max == c) would be.
    ch = F.col("channel_type")
    for c in channels:
        n = A.safe_name(c)
        aggs += [F.max((ch == F.lit(c)).cast("int")).alias(f"_has_{n}"), F.max((ch > F.lit(c)).cast("int")).alias(f"_gt_{n}")]
    aggs += A.pivot_count_exprs("trx_category", categories, "cnt_")
    aggs += A.pivot_agg_exprs("trx_category", "amount", categories, "sum", "sum_")
    aggs += A.pivot_agg_exprs("weekday", "amount", WEEKDAYS, "avg", "mean_wd_")
    out = tx.groupBy("cl_id").agg(*aggs)
    names = [A.safe_name(c) for c in channels]
    onehot = [((F.col(f"_has_{n}") == 1) & (F.col(f"_gt_{n}") == 0)).cast("int").alias(f"chan_{n}") for n in names]
    return out.select(*[c for c in out.columns if not c.startswith(("_has_", "_gt_"))], *onehot)


SIGNS = ("all", "pos", "neg")
HOURS = list(range(24))


def _mean(v, cents: int):
    """Sum rounded to the currency's decimals over the count: independent of the order of addition."""
    return F.coalesce(F.round(F.sum(v), cents) / F.count(v), F.lit(0.0))


def _five(amount, prefix: str, hit=None, cents: int = 2) -> list:
    v = amount if hit is None else F.when(hit, amount)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return [F.count(v).alias(f"{prefix}count"), zero(F.round(F.sum(v), cents)).alias(f"{prefix}sum"),
            zero(F.max(v)).alias(f"{prefix}max"), zero(F.stddev_samp(v)).alias(f"{prefix}std"),
            _mean(v, cents).alias(f"{prefix}mean")]


def signed_feature_set(tx: DataFrame, categories) -> DataFrame:
    """The signed feature set (A8), ONE aggregation: for all amounts, and with the negative or
    the positive ones set to zero, count / sum / max / std / mean in total and per category,
    mean per weekday and per hour; and the span in days. Missing cells are 0. The blocks per MCC
    have an open domain and come in long form (``signed_long_blocks``). The rows are dealt by
    client first: the 180 aggregates of a client are far larger than its rows, so no task holds
    them for clients that others hold too."""
    tx = tx.select("cl_id", "ts", "trx_category", "amount").repartition("cl_id")
    tx = tx.withColumns({"weekday": F.weekday("ts"), "hour": F.hour("ts")})
    aggs = []
    for sign in SIGNS:
        amt = mask_amount("amount", sign)
        aggs += _five(amt, f"{sign}_")
        for v in categories:
            aggs += _five(amt, f"{sign}_cat_{A.safe_name(v)}_", F.col("trx_category") == F.lit(v))
        for dim, short, values in (("weekday", "wd", WEEKDAYS), ("hour", "h", HOURS)):
            aggs += [_mean(F.when(F.col(dim) == F.lit(v), amt), 2).alias(f"{sign}_{short}_{v}_mean") for v in values]
    aggs.append(A.date_span_days_expr("ts").alias("span_days"))
    return tx.groupBy("cl_id").agg(*aggs)


def signed_long_blocks(tx: DataFrame, dim: str) -> DataFrame:
    """The five statistics per client, sign and every value of ``dim`` (A8), long form. A row is
    aggregated once for all signs; only the results are laid out a sign a row."""
    def five(sign):
        v = mask_amount("amount", sign)
        return F.struct(F.lit(sign).alias("sign"), F.count(v).alias("n"), F.sum(v).alias("total"), F.max(v).alias("largest"),
                        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("std"), F.avg(v).alias("mean"))
    per = tx.groupBy("cl_id", dim).agg(*[five(s).alias(s) for s in SIGNS])
    rows = per.select("cl_id", dim, F.explode(F.array(*SIGNS)).alias("s"))
    return rows.select("cl_id", "s.sign", dim, *[f"s.{c}" for c in ("n", "total", "largest", "std", "mean")])
