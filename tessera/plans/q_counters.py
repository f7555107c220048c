"""Registered queries over the clickstream stand-in (events -> JSON counter maps)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import maps as FM
from tessera.operators import counters as C
from tessera.plans.counters import base_features, counter_features, extended_counter_features
from tessera.plans.registry import finish, register
from tessera.sources import standins as S

SRCS = ["f1"]
CATS = S.EVENT_TYPES

CLICKS_SQL = """clicks AS (
  SELECT user_id AS uid, event_id AS row_id, event_type AS cat,
         date_diff('day', (SELECT min(ts)::DATE FROM events), ts::DATE) AS days,
         json_extract_string(props, '$.k') AS k, CAST(round(value) AS BIGINT) AS v
  FROM events)"""
LABELS_SQL = """ulab AS (
  SELECT u.uid, l.quality AS target FROM (SELECT DISTINCT user_id AS uid FROM events) u
  LEFT JOIN labels l ON l.doc_id = u.uid)"""


def _cats(fmt):
    return ",\n  ".join(fmt.format(c=c, i=i) for i, c in enumerate(CATS))


_M18_SQL = f"""
WITH {CLICKS_SQL}
SELECT uid,
  {_cats("count(*) FILTER (WHERE cat = '{c}') AS num_times_cat_eq_{i}")},
  count(*) AS records, max(days) AS max_days, min(days) AS min_days,
  round(stddev_samp(v), 6) AS sum_values_f1_std, round(stddev_samp(1), 6) AS num_keys_f1_std,
  max(v) AS sum_values_f1_max, CAST(max(1) AS BIGINT) AS num_keys_f1_max,
  round(avg(v), 6) AS sum_values_f1_mean, round(avg(1), 6) AS num_keys_f1_mean
FROM clicks GROUP BY uid"""


@register("counter_features", _M18_SQL, headline=True)
def q_counter_features(spark, sf_dir):
    return finish(counter_features(S.clicks(spark, sf_dir), CATS, SRCS))


_M19_SQL = f"""
WITH {CLICKS_SQL},
base AS (SELECT uid,
  {_cats("count(*) FILTER (WHERE cat = '{c}') AS num_times_cat_eq_{i}")},
  count(*) AS records, max(days) AS max_days, min(days) AS min_days, count(DISTINCT days) AS unique_days,
  max(v) AS sum_values_f1_max, CAST(max(1) AS BIGINT) AS num_keys_f1_max,
  round(avg(v), 6) AS sum_values_f1_mean, round(avg(1), 6) AS num_keys_f1_mean
  FROM clicks GROUP BY uid),
pd AS (SELECT uid, max(n) AS max_day_cntr, round(avg(n), 6) AS mean_day_cntr
       FROM (SELECT uid, days, count(*) AS n FROM clicks GROUP BY 1, 2) GROUP BY uid),
pc AS (SELECT uid, cat, count(DISTINCT k) AS nuniq, sum(v) AS sumval FROM clicks GROUP BY 1, 2),
sp AS (SELECT uid,
  {_cats("coalesce(sum(nuniq) FILTER (WHERE cat = '{c}'), 0) AS nuniq_keys_f1_cat{i}")},
  coalesce(sum(nuniq), 0) AS nuniq_keys_f1_total,
  {_cats("coalesce(sum(sumval) FILTER (WHERE cat = '{c}'), 0) AS sumval_keys_f1_cat{i}")},
  coalesce(sum(sumval), 0) AS sumval_keys_f1_total
  FROM pc GROUP BY uid)
SELECT base.*, pd.max_day_cntr, pd.mean_day_cntr, sp.* EXCLUDE (uid),
  CAST(list_position([num_times_cat_eq_0, num_times_cat_eq_1, num_times_cat_eq_2, num_times_cat_eq_3, num_times_cat_eq_4],
       greatest(num_times_cat_eq_0, num_times_cat_eq_1, num_times_cat_eq_2, num_times_cat_eq_3, num_times_cat_eq_4)) - 1 AS INTEGER) AS most_freq_cat,
  CAST((num_times_cat_eq_0 > 0)::INT + (num_times_cat_eq_1 > 0)::INT + (num_times_cat_eq_2 > 0)::INT
     + (num_times_cat_eq_3 > 0)::INT + (num_times_cat_eq_4 > 0)::INT AS INTEGER) AS diff_num_cats
FROM base LEFT JOIN pd USING (uid) LEFT JOIN sp USING (uid)"""


@register("extended_counter_features", _M19_SQL)
def q_extended_counter_features(spark, sf_dir):
    return finish(extended_counter_features(S.clicks(spark, sf_dir), CATS, SRCS))


_M20_SQL = f"""
WITH {CLICKS_SQL}, {LABELS_SQL}
SELECT c.uid,
  {", ".join(f"round(avg(CASE WHEN cat = '{x}' THEN 1 ELSE 0 END), 6) AS cat_avg_{x}" for x in sorted(CATS))},
  {", ".join(f"sum(CASE WHEN cat = '{x}' THEN 1 ELSE 0 END) AS cat_sum_{x}" for x in sorted(CATS))},
  {", ".join(f"min(CASE WHEN cat = '{x}' THEN 1 ELSE 0 END) AS cat_min_{x}" for x in sorted(CATS))},
  {", ".join(f"max(CASE WHEN cat = '{x}' THEN 1 ELSE 0 END) AS cat_max_{x}" for x in sorted(CATS))},
  max(days) AS max_date_diff, min(days) AS min_date_diff, round(avg(days), 6) AS mean_date_diff,
  max(days) - min(days) AS delta_date_diff,
  CAST(max(1) AS BIGINT) AS max_count_f1, max(v) AS max_sum_f1, CAST(min(1) AS BIGINT) AS min_count_f1, min(v) AS min_sum_f1,
  round(avg(1), 6) AS mean_count_f1, round(avg(v), 6) AS mean_sum_f1,
  CAST(min(list_position({sorted(CATS)!r}, cat) - 1) AS INTEGER) AS cat_min_le, count(*) AS count_rows,
  any_value(ulab.target) AS target
FROM clicks c LEFT JOIN ulab USING (uid) GROUP BY c.uid"""


@register("base_features", _M20_SQL)
def q_base_features(spark, sf_dir):
    return finish(base_features(S.clicks(spark, sf_dir), CATS, SRCS, S.click_labels(spark, sf_dir)))


@register("merge_counters_sum", f"""
WITH {CLICKS_SQL}
SELECT uid, 'f1' AS src, k AS key, sum(v) AS value FROM clicks GROUP BY uid, k""")
def q_merge_counters_sum(spark, sf_dir):
    return C.merge_maps_sum(C.with_maps(S.clicks(spark, sf_dir), SRCS), "uid", SRCS)


@register("merge_counters_last", f"""
WITH {CLICKS_SQL}
SELECT uid, 'f1' AS src, k AS key, arg_max(v, (days, row_id)) AS value FROM clicks GROUP BY uid, k""")
def q_merge_counters_last(spark, sf_dir):
    return C.merge_maps_last(C.with_maps(S.clicks(spark, sf_dir), SRCS), "uid", SRCS)


@register("binary_presence_max", f"""
WITH {CLICKS_SQL},
m AS (SELECT uid, k, sum(v) AS value FROM clicks GROUP BY uid, k)
SELECT u.uid, coalesce(b.n_present, 0) AS n_present, coalesce(x.max_value, 0) AS max_value
FROM (SELECT DISTINCT uid FROM clicks) u
LEFT JOIN (SELECT uid, count(*) AS n_present FROM m WHERE value <> 0 GROUP BY uid) b USING (uid)
LEFT JOIN (SELECT uid, max(value) AS max_value FROM m GROUP BY uid) x USING (uid)""")
def q_binary_presence_max(spark, sf_dir):
    clicks = C.with_maps(S.clicks(spark, sf_dir), SRCS)
    long = C.merge_maps_sum(clicks, "uid", SRCS)
    users = clicks.select("uid").distinct()
    present = C.binarise(long).groupBy("uid").agg(F.count(F.lit(1)).alias("n_present"))
    mx = C.max_merged_value(long, users, "uid")
    return mx.join(present, "uid", "left").fillna(0, subset=["n_present"]).select("uid", "n_present", "max_value")


@register("support_filtered_counters", f"""
WITH {CLICKS_SQL}, {LABELS_SQL},
m AS (SELECT uid, k, sum(v) AS value FROM clicks GROUP BY uid, k),
s AS (SELECT k, count(*) FILTER (WHERE target IS NOT NULL) AS n_train, count(*) FILTER (WHERE target IS NULL) AS n_test
      FROM m JOIN ulab USING (uid) GROUP BY k)
SELECT m.uid, 'f1' AS src, m.k AS key, m.value FROM m JOIN s USING (k) WHERE s.n_train > 4 AND s.n_test > 1""")
def q_support_filtered_counters(spark, sf_dir):
    long = C.merge_maps_sum(C.with_maps(S.clicks(spark, sf_dir), SRCS), "uid", SRCS)
    return C.support_filter(long, S.click_labels(spark, sf_dir), "uid", 4, 1)


@register("global_key_totals", f"""
WITH {CLICKS_SQL}
SELECT 'f1' AS src, k AS key, sum(v) AS total FROM clicks GROUP BY k""")
def q_global_key_totals(spark, sf_dir):
    return C.global_key_totals(C.with_maps(S.clicks(spark, sf_dir), SRCS), SRCS)


@register("top_test_keys", f"""
WITH {CLICKS_SQL}, {LABELS_SQL},
m AS (SELECT uid, k, sum(v) AS value FROM clicks GROUP BY uid, k),
top AS (SELECT k FROM m JOIN ulab USING (uid) WHERE target IS NULL GROUP BY k ORDER BY sum(value) DESC, k LIMIT 20)
SELECT uid, 'f1' AS src, k AS key, value FROM m WHERE k IN (SELECT k FROM top)""")
def q_top_test_keys(spark, sf_dir):
    long = C.merge_maps_sum(C.with_maps(S.clicks(spark, sf_dir), SRCS), "uid", SRCS)
    return C.top_keys_by_test_mass(long, S.click_labels(spark, sf_dir), "uid", 20)


@register("user_key_tokens", f"""
WITH {CLICKS_SQL},
m AS (SELECT uid, CAST(k AS BIGINT) + 1 AS id FROM clicks GROUP BY uid, k HAVING sum(v) <> 0)
SELECT uid, CAST(0 AS BIGINT) AS piece, array_to_string(list_sort(list(id)), ' ') AS tokens FROM m GROUP BY uid""")
def q_user_key_tokens(spark, sf_dir):
    long = C.merge_maps_sum(C.with_maps(S.clicks(spark, sf_dir), SRCS), "uid", SRCS)
    return C.key_tokens(long, "uid")


@register("counter_row_functions", f"""
WITH {CLICKS_SQL}
SELECT row_id, 1 AS not_empty, CAST(1 AS BIGINT) AS n_keys, v AS sum_values, v AS max_value,
  CASE WHEN k = '7' THEN v ELSE 0 END AS key_7, k AS json_keys, '"' || k || '":' || v AS inner_text,
  [k || ':' || v] AS tokens, 1 AS n_tokens
FROM clicks""")
def q_counter_row_functions(spark, sf_dir):
    c = S.clicks(spark, sf_dir)
    m = FM.parse_counter_map("f1")
    return c.select("row_id", FM.map_is_not_empty(m).alias("not_empty"), FM.map_size(m).alias("n_keys"),
                    FM.map_sum(m).alias("sum_values"), FM.map_max(m).alias("max_value"),
                    FM.map_get(m, "7").alias("key_7"), FM.extract_keys("f1").alias("json_keys"),
                    FM.strip_trailing_comma(FM.strip_braces("f1")).alias("inner_text"),
                    FM.counter_tokens(m).alias("tokens"),
                    FM.array_length(FM.counter_tokens(m)).alias("n_tokens"))
