"""Registered queries over table-shaping operators and counter maps with many keys and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import maps as FM
from tessera.functions.dates import date_parts, parse_period, parse_trdatetime
from tessera.functions.misc import blend, log_root, log_root_inverse, sign_flag
from tessera.operators import aggregate as A
from tessera.operators import clean as CL
from tessera.operators import counters as C
from tessera.operators import encode as E
from tessera.operators import joins as J
from tessera.operators import masks as MK
from tessera.operators import window as W
from tessera.plans.counters import base_features, counter_features, extended_counter_features
from tessera.plans.q_detection import _REG_SQL, BOX_SQL, H
from tessera.plans.registry import finish, register
from tessera.session import table
from tessera.sources import standins as S

# ---- counter maps with several keys and three sources ----

SRCS = ["f1", "f2", "f3"]
CATS = S.TRX_CATEGORIES
MAPS_SQL = """rw AS (SELECT o_orderkey AS row_id, o_custkey AS uid, o_orderpriority AS cat,
    date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), CAST(o_orderdate AS DATE)) AS days FROM orders),
ent AS (SELECT l_orderkey AS row_id, 'f1' AS src, CAST(l_partkey % 50 AS VARCHAR) AS key, count(*) AS value FROM lineitem GROUP BY 1, 3
  UNION ALL SELECT l_orderkey, 'f2', CAST(l_suppkey % 20 AS VARCHAR), CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) FROM lineitem GROUP BY 1, 3
  UNION ALL SELECT l_orderkey, 'f3', CAST(l_linenumber AS VARCHAR), max(CAST(l_quantity AS BIGINT)) FROM lineitem WHERE l_quantity > 25 GROUP BY 1, 3),
ue AS (SELECT rw.uid, rw.cat, rw.days, ent.* FROM ent JOIN rw USING (row_id)),
st AS (SELECT rw.row_id, any_value(uid) AS uid, any_value(cat) AS cat, any_value(days) AS days,
    count(*) FILTER (WHERE src = 'f1') AS nk_f1, count(*) FILTER (WHERE src = 'f2') AS nk_f2, count(*) FILTER (WHERE src = 'f3') AS nk_f3,
    coalesce(sum(value) FILTER (WHERE src = 'f1'), 0) AS sv_f1, coalesce(sum(value) FILTER (WHERE src = 'f2'), 0) AS sv_f2,
    coalesce(sum(value) FILTER (WHERE src = 'f3'), 0) AS sv_f3 FROM rw LEFT JOIN ent USING (row_id) GROUP BY rw.row_id)"""


def _stat_sql(fun):
    sql = {"std": "round(stddev_samp({c}), 6)", "max": "max({c})", "min": "min({c})", "mean": "round(avg({c}), 6)"}[fun]
    return [(s, f"CAST({sql.format(c='sv_' + s)} AS {'DOUBLE' if fun in ('std', 'mean') else 'BIGINT'})",
             f"CAST({sql.format(c='nk_' + s)} AS {'DOUBLE' if fun in ('std', 'mean') else 'BIGINT'})") for s in SRCS]


def _counts_sql():
    return ", ".join(f"count(*) FILTER (WHERE cat = '{c}') AS num_times_cat_eq_{i}" for i, c in enumerate(CATS))


@register("order_counter_features", f"""
WITH {MAPS_SQL}
SELECT uid, {_counts_sql()}, count(*) AS records, max(days) AS max_days, min(days) AS min_days,
  {", ".join(f"{sv} AS sum_values_{s}_{f}, {nk} AS num_keys_{s}_{f}" for f in ('std', 'max', 'mean') for s, sv, nk in _stat_sql(f))}
FROM st GROUP BY uid""")
def q_order_counter_features(spark, sf_dir):
    return finish(counter_features(S.order_counters(spark, sf_dir), CATS, SRCS))


@register("order_extended_features", f"""
WITH {MAPS_SQL},
base AS (SELECT uid, {_counts_sql()}, count(*) AS records, max(days) AS max_days, min(days) AS min_days, count(DISTINCT days) AS unique_days,
  {", ".join(f"{sv} AS sum_values_{s}_{f}, {nk} AS num_keys_{s}_{f}" for f in ('max', 'mean') for s, sv, nk in _stat_sql(f))}
  FROM st GROUP BY uid),
pd AS (SELECT uid, max(n) AS max_day_cntr, round(avg(n), 6) AS mean_day_cntr
       FROM (SELECT uid, days, count(*) AS n FROM st GROUP BY 1, 2) GROUP BY uid),
pc AS (SELECT uid, cat, src, count(DISTINCT key) AS nuniq, sum(value) AS sumval FROM ue GROUP BY 1, 2, 3),
sp AS (SELECT uid, {", ".join(f"CAST(coalesce(sum({v}) FILTER (WHERE src = '{s}' AND cat = '{c}'), 0) AS BIGINT) AS {stem}_{s}_cat{i}"
                              for s in SRCS for stem, v in (('nuniq_keys', 'nuniq'), ('sumval_keys', 'sumval')) for i, c in enumerate(CATS))},
  {", ".join(f"CAST(coalesce(sum({v}) FILTER (WHERE src = '{s}'), 0) AS BIGINT) AS {stem}_{s}_total"
             for s in SRCS for stem, v in (('nuniq_keys', 'nuniq'), ('sumval_keys', 'sumval')))} FROM pc GROUP BY uid)
SELECT base.*, max_day_cntr, mean_day_cntr, sp.* EXCLUDE (uid),
  CAST(list_position([{", ".join(f"num_times_cat_eq_{i}" for i in range(5))}], greatest({", ".join(f"num_times_cat_eq_{i}" for i in range(5))})) - 1 AS INTEGER) AS most_freq_cat,
  CAST({" + ".join(f"(num_times_cat_eq_{i} > 0)::INT" for i in range(5))} AS INTEGER) AS diff_num_cats
FROM base LEFT JOIN pd USING (uid) LEFT JOIN sp USING (uid)""")
def q_order_extended_features(spark, sf_dir):
    return finish(extended_counter_features(S.order_counters(spark, sf_dir), CATS, SRCS))


_MANY = [("max", "max"), ("min", "min"), ("mean", "mean")]


@register("order_base_features", f"""
WITH {MAPS_SQL}
SELECT uid, {", ".join(f"round(avg(CASE WHEN cat = '{x}' THEN 1 ELSE 0 END), 6) AS cat_avg_{A.safe_name(x)}" for x in CATS)},
  {", ".join(f"{f}(CASE WHEN cat = '{x}' THEN 1 ELSE 0 END) AS cat_{f}_{A.safe_name(x)}" for f in ('sum', 'min', 'max') for x in CATS)},
  max(days) AS max_date_diff, min(days) AS min_date_diff, round(avg(days), 6) AS mean_date_diff, max(days) - min(days) AS delta_date_diff,
  {", ".join(f"{nk} AS {f}_count_{s}, {sv} AS {f}_sum_{s}" for f in ('max', 'min', 'mean') for s, sv, nk in _stat_sql(f))},
  CAST(min(list_position({sorted(CATS)!r}, cat) - 1) AS INTEGER) AS cat_min_le, count(*) AS count_rows
FROM st GROUP BY uid""")
def q_order_base_features(spark, sf_dir):
    return finish(base_features(S.order_counters(spark, sf_dir), CATS, SRCS))


@register("order_counters_merged", f"""
WITH {MAPS_SQL},
s AS (SELECT uid, src, key, CAST(sum(value) AS BIGINT) AS total, arg_max(value, (days, row_id)) AS latest FROM ue GROUP BY 1, 2, 3)
SELECT *, CAST(total <> 0 AS INTEGER) AS present FROM s""")
def q_order_counters_merged(spark, sf_dir):
    """Sums, latest values and presence of every user's keys."""
    maps = C.with_maps(S.order_counters(spark, sf_dir), SRCS)
    total = C.merge_maps_sum(maps, "uid", SRCS)
    last = C.merge_maps_last(maps, "uid", SRCS).withColumnRenamed("value", "latest")
    present = C.binarise(total).withColumnRenamed("value", "present")
    keys = ["uid", "src", "key"]
    return total.withColumnRenamed("value", "total").join(last, keys).join(present, keys, "left") \
        .withColumn("present", F.coalesce(F.col("present").cast("int"), F.lit(0)))


@register("order_map_keys", f"""
WITH {MAPS_SQL},
d AS (SELECT uid, src, count(DISTINCT key) AS nuniq_keys FROM ue GROUP BY 1, 2),
v AS (SELECT uid, CAST(sum(sv_f1) AS BIGINT) AS sumval_f1, CAST(sum(sv_f2) AS BIGINT) AS sumval_f2, CAST(sum(sv_f3) AS BIGINT) AS sumval_f3 FROM st GROUP BY 1)
SELECT d.*, sumval_f1, sumval_f2, sumval_f3 FROM d JOIN v USING (uid)""")
def q_order_map_keys(spark, sf_dir):
    """Distinct keys per source and value sums of every user."""
    maps = C.with_maps(S.order_counters(spark, sf_dir), SRCS)
    return C.distinct_map_keys(maps, "uid", SRCS).join(C.map_value_sum(maps, "uid", SRCS), "uid")


@register("order_map_rows", f"""
WITH {MAPS_SQL}
SELECT st.row_id, CAST(nk_f2 > 0 AS INTEGER) AS not_empty, nk_f2 AS n_keys, CAST(sv_f2 AS BIGINT) AS sum_values,
  coalesce(x.mx, 0) AS max_value, coalesce(x.k7, 0) AS key_7, coalesce(x.tokens, []) AS tokens, CAST(nk_f3 AS INTEGER) AS n_large
FROM st LEFT JOIN (SELECT row_id, max(value) AS mx, max(value) FILTER (WHERE key = '7') AS k7,
    list(key || ':' || value ORDER BY key) AS tokens FROM ent WHERE src = 'f2' GROUP BY row_id) x ON x.row_id = st.row_id""")
def q_order_map_rows(spark, sf_dir):
    """Row functions on maps with many keys."""
    o = S.order_counters(spark, sf_dir)
    m, large = FM.parse_counter_map("f2"), FM.parse_counter_map("f3")
    return o.select("row_id", FM.map_is_not_empty(m).alias("not_empty"), FM.map_size(m).alias("n_keys"), FM.map_sum(m).alias("sum_values"),
                    FM.map_max(m).alias("max_value"), FM.map_get(m, "7").alias("key_7"), FM.counter_tokens(m).alias("tokens"),
                    FM.map_size(large).cast("int").alias("n_large"))


# ---- cleaning ----

@register("clean_customers", """
WITH c AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer),
l AS (SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE balance END AS balance, CASE WHEN id % 7 = 0 THEN NULL ELSE segment END AS segment, nation, name FROM c)
SELECT id, coalesce(balance, 0) AS balance, CASE WHEN contains(coalesce(segment, 'NONE'), 'BUILD') THEN 'B' ELSE coalesce(segment, 'NONE') END AS segment,
  CAST(balance > 0 AND balance IS NOT NULL AS INTEGER) AS positive, TRY_CAST(substr(name, 10) AS DOUBLE) AS number, CAST(balance > 0 AND balance IS NOT NULL AS INTEGER) AS sign
FROM l WHERE nation IN (1, 2, 3, 5, 8, 13, 21) AND nation <> 13""")
def q_clean_customers(spark, sf_dir):
    """Rename, drop, fill, filter, flags, numbers from text, category normalising, invalid rows."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_custkey")
    c = CL.rename(c, ["id", "name", "nation", "balance", "segment", "spare"])
    c = CL.drop_columns(c, ["spare"])
    c = c.withColumns({"balance": F.when(F.col("id") % 11 != 0, F.col("balance")), "segment": F.when(F.col("id") % 7 != 0, F.col("segment"))})
    c = c.withColumns({"positive": CL.flag(F.col("balance") > 0), "number": F.substring("name", 10, 20)})
    c = CL.fill_missing(CL.to_numeric(c, ["number"]), numeric=None, string="NONE")
    c = CL.fill_missing(c, numeric=0)
    c = CL.drop_invalid(CL.isin_filter(c, "nation", [1, 2, 3, 5, 8, 13, 21]), ["nation"], marker=13)
    return c.select("id", "balance", CL.normalise_category("segment", "BUILD", "B").alias("segment"), "positive", "number",
                    sign_flag("balance").alias("sign"))


@register("label_split_sizes", """
WITH d AS (SELECT documents.doc_id, quality AS target FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'train' AS part, count(*) AS n FROM d WHERE target IS NOT NULL UNION ALL SELECT 'test', count(*) FROM d WHERE target IS NULL""")
def q_label_split_sizes(spark, sf_dir):
    """Train and test by the label."""
    train, test = CL.split_by_label(S.doc_labels(spark, sf_dir))
    n = F.count(F.lit(1)).alias("n")
    return train.agg(n).select(F.lit("train").alias("part"), "n").unionByName(test.agg(n).select(F.lit("test").alias("part"), "n"))


# ---- joins ----

@register("customer_blocks", """
WITH o AS (SELECT o_custkey AS id, count(*) AS orders, max(o_totalprice) AS largest FROM orders GROUP BY 1),
u AS (SELECT o_custkey AS id, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
l AS (SELECT doc_id AS id, quality FROM labels),
c AS (SELECT c_custkey AS id FROM customer)
SELECT coalesce(o.id, u.id, l.id) AS id, orders, largest, urgent, quality, CAST(i.id IS NOT NULL AS INTEGER) AS in_all,
  CAST(c.id IS NOT NULL AND o.id IS NULL AS INTEGER) AS customer_without_orders
FROM o FULL JOIN u ON o.id = u.id FULL JOIN l ON coalesce(o.id, u.id) = l.id
LEFT JOIN (SELECT o.id FROM o JOIN u USING (id) JOIN l USING (id)) i ON i.id = coalesce(o.id, u.id, l.id)
LEFT JOIN c ON c.id = coalesce(o.id, u.id, l.id)""")
def q_customer_blocks(spark, sf_dir):
    """Feature blocks joined outer and inner, left lookups, anti join."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "id")
    o = orders.groupBy("id").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest"))
    u = orders.filter("o_orderpriority = '1-URGENT'").groupBy("id").agg(F.count(F.lit(1)).alias("urgent"))
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    inner = J.assemble_inner([o, u, lab], "id").select("id", F.lit(1).alias("in_all"))
    idle = J.anti_by_keys(c, o, "id").withColumn("customer_without_orders", F.lit(1))
    out = J.left_join_features(J.assemble_outer([o, u, lab], "id"), [inner, idle], "id")
    return out.fillna(0, subset=["in_all", "customer_without_orders"])


@register("labelled_lengths", """
WITH d AS (SELECT doc_id, quality, n_chars, lang FROM documents JOIN labels USING (doc_id))
SELECT lang, count(n_chars) AS n_count, CAST(sum(n_chars) AS BIGINT) AS n_sum, round(avg(n_chars), 6) AS n_mean, max(n_chars) AS n_max, min(n_chars) AS n_min,
  round(coalesce(stddev_samp(n_chars), 0.0), 6) AS n_std, max(quality) AS quality, round(CAST(sum(quality) AS DOUBLE) / nullif(count(*), 0), 6) AS good_share
FROM d GROUP BY lang""")
def q_labelled_lengths(spark, sf_dir):
    """Inner label join, basic statistics, label per key, share."""
    d = J.inner_join_labels(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"),
                            table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    good = d.groupBy("lang").agg(A.share(F.sum("quality"), F.count(F.lit(1))).alias("good_share"))
    return finish(A.basic_stats(d, "lang", "n_chars", "n").join(A.max_per_key(d, "lang", ["quality"]), "lang").join(good, "lang"))


@register("class_ids_both_ways", f"""
WITH {_REG_SQL}
SELECT c.source, c.source_class_id, r.class_id, r.source AS back_source, r.source_class_id AS back_id
FROM (SELECT DISTINCT source, CAST(source_class_id AS BIGINT) AS source_class_id FROM cls) c JOIN reg r USING (source, source_class_id)""")
def q_class_ids_both_ways(spark, sf_dir):
    """Source class ids to internal ids and back."""
    from tessera.operators.boxes import build_class_registry
    cls = S.class_sources(spark, sf_dir)
    reg = build_class_registry(cls)
    there = J.class_map_join(cls.select("source", F.col("source_class_id").cast("long").alias("source_class_id")).distinct(), reg)
    back = J.class_map_join(there.select("class_id"), reg, "to_source")
    return there.join(back.select("class_id", F.col("source").alias("back_source"), F.col("source_class_id").alias("back_id")), "class_id")


# ---- aggregates, windows, sorts ----

@register("distinct_first_rows", """
WITH d AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders),
f AS (SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY 1)
SELECT f.o_custkey, first_order, n_status FROM f JOIN (SELECT o_custkey, count(*) AS n_status FROM d GROUP BY 1) USING (o_custkey)""")
def q_distinct_first_rows(spark, sf_dir):
    """Distinct rows, and the first row of a key in an order."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    status = A.drop_duplicates(o.select("o_custkey", "o_orderstatus")).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_status"))
    first = A.drop_duplicates(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", F.col("o_orderkey").alias("first_order")).join(status, "o_custkey")


@register("price_normality", """
WITH m AS (SELECT count(*) AS n, avg(o_totalprice) AS mu FROM orders),
c AS (SELECT any_value(n) AS n, avg(pow(o_totalprice - mu, 2)) AS m2, avg(pow(o_totalprice - mu, 3)) AS m3, avg(pow(o_totalprice - mu, 4)) AS m4 FROM orders, m),
g AS (SELECT CAST(n AS DOUBLE) AS n, m3 / pow(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2 FROM c),
a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y,
    3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2 FROM g),
s AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2 FROM a),
z AS (SELECT *, asinh(y / sqrt(2.0 / (w2 - 1))) / sqrt(ln(sqrt(w2))) AS z1,
    6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb,
    (g2 + 3 - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x FROM s),
k AS (SELECT *, 6.0 + 8.0 / sb * (2.0 / sb + sqrt(1 + 4.0 / (sb * sb))) AS aa FROM z),
r AS (SELECT n, pow(z1, 2) + pow((1 - 2 / (9.0 * aa) - cbrt((1 - 2 / aa) / (1 + x * sqrt(2 / (aa - 4.0))))) / sqrt(2 / (9.0 * aa)), 2) AS k2 FROM k)
SELECT n, round(k2, 3) AS k2, round(exp(-k2 / 2), 6) AS p_value, CAST(exp(-k2 / 2) >= 0.05 AS INTEGER) AS normal_at_05 FROM r""")
def q_price_normality(spark, sf_dir):
    """D'Agostino-Pearson test of the order prices."""
    out = finish(A.normality_test(table(spark, sf_dir, "orders"), "o_totalprice"))
    return out.withColumn("k2", F.round("k2", 3))


@register("customer_order_texts", """
SELECT o_custkey, CAST(0 AS BIGINT) AS piece, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderdate, o_orderkey) AS text
FROM orders GROUP BY o_custkey""")
def q_customer_order_texts(spark, sf_dir):
    """A customer's order ids joined in time order."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderkey").cast("string").alias("t"))
    return W.ordered_concat(o, "o_custkey", "o_orderdate", "t", row_id="o_orderkey")


@register("order_row_numbers", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS overall,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) - 1 AS in_priority FROM orders""")
def q_order_row_numbers(spark, sf_dir):
    """Row numbers over the table and inside five hot keys."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    o = W.row_index(o, ["o_totalprice", "o_orderkey"], out="overall")
    return W.row_index(o, ["o_totalprice", "o_orderkey"], "o_orderpriority", "in_priority").select("o_orderkey", "overall", "in_priority")


@register("largest_orders", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""")
def q_largest_orders(spark, sf_dir):
    """A sorted top-k report."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return W.sort_by(W.top_k(o, "o_totalprice", 50, tie_break="o_orderkey"), [F.desc("o_totalprice")], "o_orderkey")


@register("sampled_orders", """
SELECT o_orderkey FROM orders ORDER BY md5(concat_ws('|', '13', o_orderkey)), o_orderkey LIMIT 100""")
def q_sampled_orders(spark, sf_dir):
    """A repeatable sample of rows."""
    return W.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey"), 100, 13, "o_orderkey")


# ---- masks ----

@register("mask_decode_round_trip", f"""
WITH {BOX_SQL}
SELECT image_id, gt_id AS instance_id, CAST(count(*) AS BIGINT) AS columns, CAST(sum(y2 - y1) AS BIGINT) AS pixels, 1 AS valid
FROM gt, LATERAL (SELECT unnest(range(x1, x2)) AS x) GROUP BY 1, 2""")
def q_mask_decode_round_trip(spark, sf_dir):
    """Encoded masks decoded again (W9): runs split into columns have every pixel."""
    from tessera.operators.boxes import split_runs
    back = MK.run_length_decode(MK.run_length_encode(S.masks(spark, sf_dir)), "rle", H, S.IMAGE_W, packed=True)
    cut = back.select("*", MK.once(split_runs("runs", H)).alias("cut")).filter(F.size("cut") > 0).dropna(subset=["image_id", "instance_id"])
    pixels = F.aggregate("cut", F.lit(0).cast("long"), lambda n, c: n + c["y_end"] - c["y_start"] + 1)
    return cut.select("image_id", "instance_id", F.size(F.array_distinct(F.transform("cut", lambda c: c["x"]))).cast("long").alias("columns"),
                      pixels.alias("pixels"), F.array_min(F.transform("runs", lambda r: r["valid"])).alias("valid"))


@register("occluded_masks", f"""
WITH {BOX_SQL},
px AS (SELECT image_id, gt_id AS instance_id, unnest(range(y1, y2)) AS y, x FROM gt, LATERAL (SELECT unnest(range(x1, x2)) AS x)),
top AS (SELECT image_id, y, x, max(instance_id) AS instance_id FROM px GROUP BY 1, 2, 3)
SELECT image_id, instance_id, count(*) AS pixels FROM top GROUP BY 1, 2""")
def q_occluded_masks(spark, sf_dir):
    """Later shapes hide earlier ones (W11): visible pixels of every shape."""
    runs = S.masks(spark, sf_dir)
    z = S.gt_boxes(spark, sf_dir).select("image_id", F.col("gt_id").alias("instance_id"), F.col("gt_id").cast("double").alias("z"))
    return MK.occlude(runs, z).groupBy("image_id", "instance_id").agg(F.sum("length").alias("pixels")).filter("pixels > 0")


# ---- dates, blends, sparse scaling ----

@register("order_date_parts", """
WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, d AS period, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
  CAST(isodow(d) - 1 AS INTEGER) AS weekday, CAST(o_orderkey % 24 AS INTEGER) AS hour FROM d""")
def q_order_date_parts(spark, sf_dir):
    """Dates written in the log's two formats and read back (F1, F2)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    written = F.concat(F.upper(F.date_format("d", "ddMMMyy")), F.lit(":"), F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":00:00"))
    o = o.select("o_orderkey", parse_period(F.date_format("d", "dd/MM/yyyy")).alias("period"), parse_trdatetime(written).alias("ts"))
    return o.select("o_orderkey", "period", *date_parts("ts"))


@register("blended_scores", """
WITH s AS (SELECT doc_id, n_chars / 1000.0 AS a, (doc_id % 97) / 97.0 AS b FROM documents)
SELECT doc_id, round(0.85 * a + 0.15 * b, 6) AS blend, round(a, 6) AS back FROM s""")
def q_blended_scores(spark, sf_dir):
    """A weighted blend, and the target transform undone."""
    d = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / 1000.0).alias("a"), ((F.col("doc_id") % 97) / 97.0).alias("b"))
    return finish(d.select("doc_id", blend({"a": 0.85, "b": 0.15}).alias("blend"), log_root_inverse(log_root("a")).alias("back")))


@register("sparse_maxabs", f"""
WITH {MAPS_SQL},
m AS (SELECT uid, src, key, CAST(sum(value) AS BIGINT) AS value FROM ue GROUP BY 1, 2, 3),
t AS (SELECT src, key, max(abs(value)) AS ma FROM m WHERE uid % 3 <> 0 GROUP BY 1, 2 HAVING max(abs(value)) > 0)
SELECT m.uid, m.src, m.key, round(CAST(value AS DOUBLE) / ma, 6) AS value FROM m JOIN t USING (src, key)""")
def q_sparse_maxabs(spark, sf_dir):
    """Sparse columns divided by their largest train value (M5)."""
    long = C.merge_maps_sum(C.with_maps(S.order_counters(spark, sf_dir), SRCS), "uid", SRCS)
    return finish(E.maxabs_scale_long(long.filter("uid % 3 <> 0"), long))
