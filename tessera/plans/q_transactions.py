"""Registered queries over the transaction stand-in (lineitem x orders)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import aggregate as A
from tessera.operators import joins as J
from tessera.operators import setops as U
from tessera.operators import window as W
from tessera.plans.registry import finish, register
from tessera.plans.transactions import signed_feature_set, signed_long_blocks, transaction_features
from tessera.session import table
from tessera.sources import standins as S

_TX_SQL = """
tx AS (
  SELECT o_custkey AS cl_id, l_orderkey AS trx_id, l_linenumber AS trx_line, o_orderdate AS ts,
         o_orderpriority AS trx_category, o_orderstatus AS channel_type, l_suppkey AS mcc,
         l_extendedprice * CASE WHEN l_returnflag = 'R' THEN -1.0 ELSE 1.0 END AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _cat_cols(prefix, expr_fmt):
    names = ["1_urgent", "2_high", "3_medium", "4_not_specified", "5_low"]
    return ",\n  ".join(expr_fmt.format(v=v) + f" AS {prefix}{n}" for v, n in zip(S.TRX_CATEGORIES, names))


_TF_SQL = f"""
WITH {_TX_SQL},
mg AS (SELECT s_suppkey AS mcc, n_regionkey AS mcc_group FROM supplier JOIN nation ON s_nationkey = n_nationkey),
t AS (SELECT tx.*, mg.mcc_group,
        CASE channel_type WHEN 'F' THEN 1 WHEN 'O' THEN -1 END * amount AS balance,
        isodow(ts) - 1 AS weekday
      FROM tx LEFT JOIN mg USING (mcc)),
g AS (
SELECT cl_id, count(*) AS count_tr, round(sum(amount), 6) AS sum_tr, round(avg(amount), 6) AS mean_amount,
  round(coalesce(stddev_samp(amount), 0.0), 6) AS std_amount, round(max(amount) - min(amount), 6) AS delta_amount,
  coalesce(CAST(avg(balance) > 0 AS INTEGER), 0) AS sign,
  CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) AS BIGINT) AS delta_first_end_tr,
  max(channel_type) AS mx_channel,
  round(avg(CASE WHEN weekday >= 5 THEN 1 ELSE 0 END), 6) AS weekend_share,
  max(mcc_group) AS mode_mcc_group,
  {_cat_cols('cnt_', "count(*) FILTER (WHERE trx_category = '{v}')")},
  {_cat_cols('sum_', "round(coalesce(sum(amount) FILTER (WHERE trx_category = '{v}'), 0.0), 6)")},
  {", ".join(f"round(coalesce(avg(amount) FILTER (WHERE weekday = {d}), 0.0), 6) AS mean_wd_{d}" for d in range(7))}
FROM t GROUP BY cl_id)
SELECT * EXCLUDE (mx_channel),
  CAST(mx_channel = 'F' AS INTEGER) AS chan_f, CAST(mx_channel = 'O' AS INTEGER) AS chan_o,
  CAST(mx_channel = 'P' AS INTEGER) AS chan_p
FROM g
"""


@register("transaction_features", _TF_SQL, headline=True)
def q_transaction_features(spark, sf_dir):
    tx = S.transactions(spark, sf_dir)
    return finish(transaction_features(tx, S.mcc_groups(spark, sf_dir), S.TRX_CATEGORIES, S.CHANNELS))


def _signed_sql():
    parts = []
    for sign in ("all", "pos", "neg"):
        amt = {"all": "amount", "pos": "CASE WHEN amount > 0 THEN amount ELSE 0.0 END",
               "neg": "CASE WHEN amount < 0 THEN amount ELSE 0.0 END"}[sign]

        def block(name, hit, stats):
            total = f"round(sum({amt}) FILTER (WHERE {hit}), 2)"  # noqa: B023
            sql = {"count": f"count(*) FILTER (WHERE {hit})", "sum": f"coalesce({total}, 0.0)",
                   "max": f"coalesce(max({amt}) FILTER (WHERE {hit}), 0.0)",  # noqa: B023
                   "std": f"round(coalesce(stddev_samp({amt}) FILTER (WHERE {hit}), 0.0), 3)",  # noqa: B023
                   "mean": f"round(coalesce({total} / nullif(count(*) FILTER (WHERE {hit}), 0), 0.0), 7)"}
            return [f"{sql[x]} AS {sign}_{name}{x}" for x in stats]  # noqa: B023
        five = ("count", "sum", "max", "std", "mean")
        parts += block("", "TRUE", five)
        for v in S.TRX_CATEGORIES:
            parts += block(f"cat_{A.safe_name(v)}_", f"trx_category = '{v}'", five)
        for d in range(7):
            parts += block(f"wd_{d}_", f"weekday = {d}", ("mean",))
        for h in range(24):
            parts += block(f"h_{h}_", f"hour = {h}", ("mean",))
    parts.append("CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 86400) AS BIGINT) AS span_days")
    return (f"WITH {_TX_SQL}, t AS (SELECT *, isodow(ts) - 1 AS weekday, hour(ts) AS hour FROM tx)\n"
            "SELECT cl_id,\n  " + ",\n  ".join(parts) + "\nFROM t GROUP BY cl_id")


@register("signed_feature_set", _signed_sql())
def q_signed_feature_set(spark, sf_dir):
    out = finish(signed_feature_set(S.transactions(spark, sf_dir), S.TRX_CATEGORIES), 7)
    return out.withColumns({c: F.round(c, 3) for c in out.columns if c.endswith("_std")})


@register("signed_mcc_blocks", f"""
WITH {_TX_SQL},
s AS (SELECT cl_id, mcc, 'all' AS sign, amount AS v FROM tx
      UNION ALL SELECT cl_id, mcc, 'pos', CASE WHEN amount > 0 THEN amount ELSE 0.0 END FROM tx
      UNION ALL SELECT cl_id, mcc, 'neg', CASE WHEN amount < 0 THEN amount ELSE 0.0 END FROM tx)
SELECT cl_id, sign, mcc, count(*) AS n, round(sum(v), 6) AS total, round(max(v), 6) AS largest,
       round(coalesce(stddev_samp(v), 0.0), 6) AS std, round(avg(v), 6) AS mean
FROM s GROUP BY cl_id, sign, mcc""")
def q_signed_mcc_blocks(spark, sf_dir):
    """The MCC blocks of the signed set, long form over every MCC value."""
    return finish(signed_long_blocks(S.transactions(spark, sf_dir), "mcc"))


@register("category_value_counts", f"""
WITH {_TX_SQL}
SELECT trx_category, count(*) AS n FROM tx WHERE trx_category IS NOT NULL GROUP BY trx_category""")
def q_category_value_counts(spark, sf_dir):
    return A.value_counts(S.transactions(spark, sf_dir), "trx_category")


@register("orders_per_day_stats", """
WITH d AS (SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey AS cl_id, max(n) AS rows_per_day_max, round(avg(n), 6) AS rows_per_day_mean,
       count(*) AS nuniq_days
FROM d GROUP BY 1""")
def q_orders_per_day_stats(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cl_id"), F.col("o_orderdate").alias("day"))
    two = A.two_level_agg(o, "cl_id", "day")
    two = two.withColumnsRenamed({"rows_per_day_max": "rows_per_day_max", "rows_per_day_mean": "rows_per_day_mean"})
    nd = A.count_distinct(o, "cl_id", "day", "nuniq_days")
    return finish(two.join(nd, "cl_id"))


@register("amount_quantiles", f"""
WITH {_TX_SQL}
SELECT trx_category, round(quantile_cont(amount, 0.99), 6) AS q99, round(quantile_cont(amount, 0.5), 6) AS q50,
       round(quantile_cont(amount, 0.995), 6) AS q995
FROM tx GROUP BY trx_category""")
def q_amount_quantiles(spark, sf_dir):
    tx = S.transactions(spark, sf_dir)
    return finish(A.exact_quantiles(tx, "amount", [0.99, 0.5, 0.995], ["trx_category"]).toDF("trx_category", "q99", "q50", "q995"))


@register("drop_outlier_orders", """
SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)""")
def q_drop_outlier_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return finish(A.drop_outliers(o, "o_totalprice", 0.99))


@register("price_describe", """
WITH s AS (SELECT
  count(l_quantity) AS q_count, avg(l_quantity) AS q_mean, stddev_samp(l_quantity) AS q_std, min(l_quantity) AS q_min,
  quantile_cont(l_quantity, 0.25) AS q_p25, quantile_cont(l_quantity, 0.5) AS q_p50, quantile_cont(l_quantity, 0.75) AS q_p75,
  max(l_quantity) AS q_max,
  count(l_extendedprice) AS e_count, avg(l_extendedprice) AS e_mean, stddev_samp(l_extendedprice) AS e_std,
  min(l_extendedprice) AS e_min, quantile_cont(l_extendedprice, 0.25) AS e_p25, quantile_cont(l_extendedprice, 0.5) AS e_p50,
  quantile_cont(l_extendedprice, 0.75) AS e_p75, max(l_extendedprice) AS e_max FROM lineitem)
SELECT c AS "column", st AS statistic, round(v, 6) AS value FROM (
  SELECT 'l_quantity' c, 'count' st, CAST(q_count AS DOUBLE) v FROM s UNION ALL SELECT 'l_quantity', 'mean', q_mean FROM s
  UNION ALL SELECT 'l_quantity', 'std', q_std FROM s UNION ALL SELECT 'l_quantity', 'min', q_min FROM s
  UNION ALL SELECT 'l_quantity', '25%', q_p25 FROM s UNION ALL SELECT 'l_quantity', '50%', q_p50 FROM s
  UNION ALL SELECT 'l_quantity', '75%', q_p75 FROM s UNION ALL SELECT 'l_quantity', 'max', q_max FROM s
  UNION ALL SELECT 'l_extendedprice', 'count', CAST(e_count AS DOUBLE) FROM s UNION ALL SELECT 'l_extendedprice', 'mean', e_mean FROM s
  UNION ALL SELECT 'l_extendedprice', 'std', e_std FROM s UNION ALL SELECT 'l_extendedprice', 'min', e_min FROM s
  UNION ALL SELECT 'l_extendedprice', '25%', e_p25 FROM s UNION ALL SELECT 'l_extendedprice', '50%', e_p50 FROM s
  UNION ALL SELECT 'l_extendedprice', '75%', e_p75 FROM s UNION ALL SELECT 'l_extendedprice', 'max', e_max FROM s) u""")
def q_price_describe(spark, sf_dir):
    return finish(A.describe(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"]))


@register("price_correlation", """
SELECT a, b, round(c, 6) AS "corr" FROM (
  SELECT 'l_quantity' a, 'l_extendedprice' b, corr(l_quantity, l_extendedprice) c FROM lineitem UNION ALL
  SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem UNION ALL
  SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem) u""")
def q_price_correlation(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return finish(A.corr_pairs(li, ["l_quantity", "l_extendedprice", "l_discount"], "pearson"))


@register("first_transaction", f"""
WITH {_TX_SQL}
SELECT cl_id, trx_id, trx_line, ts, round(amount, 6) AS amount FROM (
  SELECT *, row_number() OVER (PARTITION BY cl_id ORDER BY ts, trx_id, trx_line, mcc, amount) AS rn FROM tx) WHERE rn = 1""")
def q_first_transaction(spark, sf_dir):
    tx = S.transactions(spark, sf_dir)
    f = W.first_per_key(tx, "cl_id", ["ts", "trx_id", "trx_line", "mcc", "amount"])
    return finish(f.select("cl_id", "trx_id", "trx_line", "ts", "amount"))


@register("customer_id_sets", """
SELECT 'both' AS kind, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders) x
UNION ALL SELECT 'no_orders', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) y
UNION ALL SELECT 'union_distinct', count(*) FROM (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders) z
UNION ALL SELECT 'union_all', (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)""")
def q_customer_id_sets(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    both = U.intersect_ids(c, o, id_cols="k").agg(F.count(F.lit(1)).alias("n")).select(F.lit("both").alias("kind"), "n")
    no = U.except_ids(c, o, "k").agg(F.count(F.lit(1)).alias("n")).select(F.lit("no_orders").alias("kind"), "n")
    ud = U.union_distinct_ids([c, o], "k").agg(F.count(F.lit(1)).alias("n")).select(F.lit("union_distinct").alias("kind"), "n")
    ua = U.union_all(c, o).agg(F.count(F.lit(1)).alias("n")).select(F.lit("union_all").alias("kind"), "n")
    return U.union_all(both, no, ud, ua)


@register("customer_label_joins", """
WITH f AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders, round(sum(o_totalprice), 6) AS total FROM orders GROUP BY 1)
SELECT c.c_custkey, c.c_mktsegment, f.n_orders, f.total, CAST(f.n_orders IS NULL AS INTEGER) AS has_null
FROM customer c LEFT JOIN f USING (c_custkey)
WHERE c.c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 0)""")
def q_customer_label_joins(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    o = table(spark, sf_dir, "orders")
    f = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"),
                                                            F.sum("o_totalprice").alias("total"))
    nat = table(spark, sf_dir, "nation")
    keep = nat.filter(F.col("n_regionkey") != 0).select(F.col("n_nationkey").alias("c_nationkey"))
    c = J.semi_by_keys(c, keep, "c_nationkey").drop("c_nationkey")
    return finish(J.align_to_ids(c, f, "c_custkey"))
