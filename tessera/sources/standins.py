"""The reference's inputs, derived from the driver's tables (FIXTURES.md part B).

Every stand-in is a plain projection/join of the given tables, so its size grows
with the scale factor (except ``embeddings``, fixed at 500 rows by the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

# Categories of the transaction stand-in (o_orderpriority) and
# the centre of the point cloud (lat 55.75, lon 37.62).
TRX_CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CHANNELS = ["F", "O", "P"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
POINT_LAT0 = 55.75
POINT_LON0 = 37.62
IMAGE_H = 128
IMAGE_W = 128


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cl_id, ts, trx_category, channel_type, mcc, amount (negative for returned lines).

    lineitem x orders on the order key: a shuffle join of two large tables on
    one key; both sides are pruned to the needed columns at the scan.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    sign = F.when(F.col("l_returnflag") == "R", F.lit(-1.0)).otherwise(F.lit(1.0))
    return j.select(
        F.col("o_custkey").alias("cl_id"),
        F.col("l_orderkey").alias("trx_id"),
        F.col("l_linenumber").alias("trx_line"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("trx_category"),
        F.col("o_orderstatus").alias("channel_type"),
        F.col("l_suppkey").alias("mcc"),
        (F.col("l_extendedprice") * sign).alias("amount"),
    )


def mcc_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mcc -> group: supplier's nation's region (small dimension)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("mcc"), F.col("n_regionkey").alias("mcc_group"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, row_id, cat, days, f1 (JSON counter text) from ``events``.

    days = calendar days since the first event day of the table (one global
    scalar, a one-row aggregate joined back); f1 = {props.k: round(value)}.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    first_day = ev.select(F.min(F.to_date("ts"))).scalar()
    key = F.get_json_object("props", "$.k")
    counter = F.to_json(F.create_map(key, F.round("value").cast("long")))
    return ev.select(
        F.col("user_id").alias("uid"),
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("cat"),
        F.datediff(F.to_date("ts"), first_day).alias("days"),
        counter.alias("f1"),
    )


def order_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, row_id, cat, days and three JSON counter maps of an order: f1 part group -> lines,
    f2 supplier group -> quantity, f3 line number -> quantity of its larger lines (often empty)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    first_day = o.select(F.min("day")).scalar()
    out = o
    for name, rows, key, value in (
            ("f1", li, F.pmod("l_partkey", F.lit(50)), F.count(F.lit(1))),
            ("f2", li, F.pmod("l_suppkey", F.lit(20)), F.sum(F.col("l_quantity").cast("long"))),
            ("f3", li.filter("l_quantity > 25"), F.col("l_linenumber"), F.max(F.col("l_quantity").cast("long")))):
        per = rows.groupBy("l_orderkey", key.cast("string").alias("k")).agg(value.alias("v"))
        m = per.groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "v")))).alias(name))
        out = out.join(m.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    return out.select(F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("row_id"), F.col("o_orderpriority").alias("cat"),
                      F.datediff("day", first_day).alias("days"), *[F.coalesce(c, F.lit("{}")).alias(c) for c in ("f1", "f2", "f3")])


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, target (null = test row) for every document."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    return d.join(lab, "doc_id", "left")


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, token: lower-cased runs of letters of the whole text (one row per token). The texts
    are dealt by document, so what is counted per document later moves no token."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")
    toks = F.split(F.lower(F.col("text")), r"[^\p{L}]+")
    return (d.select("doc_id", F.posexplode(toks).alias("pos", "token"))
            .filter(F.length("token") > 0))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """point_id, lat, lon, tags: embeddings mapped to a small area around a city centre."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("point_id"),
        (F.lit(POINT_LAT0) + F.col("embedding")[0].cast("double")).alias("lat"),
        (F.lit(POINT_LON0) + F.col("embedding")[1].cast("double")).alias("lon"),
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("tags"),
        F.col("label").alias("label"),
    )


def zones(spark: SparkSession, sf_dir: str, n: int = 20, far: int = 0) -> DataFrame:
    """n x n grid of boxes over the bounding range of the points (zone_id, corners, centre).
    ``far`` > 0 continues the grid by that many zones beyond the points, ``n`` boxes north of
    the range for the first, 2n for the second, and so on."""
    p = points(spark, sf_dir)
    la0, la1 = p.select(F.min("lat")).scalar(), p.select(F.max("lat")).scalar()
    lo0, lo1 = p.select(F.min("lon")).scalar(), p.select(F.max("lon")).scalar()
    extra = F.col("id") - n * n
    cells = spark.range(n * n + far).select(
        F.col("id").alias("zone_id"),
        F.when(extra < 0, (F.col("id") / n).cast("long")).otherwise(2 * n + n * extra).alias("zi"),
        F.when(extra < 0, F.pmod(F.col("id"), F.lit(n))).otherwise(extra).alias("zj"),
        la0.alias("la0"), la1.alias("la1"), lo0.alias("lo0"), lo1.alias("lo1"))
    dlat = (F.col("la1") - F.col("la0")) / n
    dlon = (F.col("lo1") - F.col("lo0")) / n
    z = cells.select(
        "zone_id",
        (F.col("la0") + F.col("zi") * dlat).alias("lat_bl"),
        (F.col("lo0") + F.col("zj") * dlon).alias("lon_bl"),
        (F.col("la0") + (F.col("zi") + 1) * dlat).alias("lat_tr"),
        (F.col("lo0") + (F.col("zj") + 1) * dlon).alias("lon_tr"),
    )
    return z.withColumn("lat_c", (F.col("lat_bl") + F.col("lat_tr")) / 2) \
            .withColumn("lon_c", (F.col("lon_bl") + F.col("lon_tr")) / 2)


def _box_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (l_orderkey, l_linenumber): the pair is not unique, keep the smallest row."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    best = F.min(F.struct("l_partkey", "l_suppkey", "l_quantity", "l_discount")).alias("r")
    return li.groupBy("l_orderkey", "l_linenumber").agg(best).select(
        "l_orderkey", "l_linenumber", "r.*")


def gt_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, gt_id, class_id, y1, x1, y2, x2 (integer pixels in a 128 x 128 image)."""
    b = _box_lines(spark, sf_dir)
    y1 = F.pmod(F.col("l_partkey"), F.lit(61))
    x1 = F.pmod(F.col("l_partkey") * 7, F.lit(59))
    return b.select(
        F.col("l_orderkey").alias("image_id"),
        F.col("l_linenumber").alias("gt_id"),
        (F.lit(1) + F.pmod(F.col("l_partkey"), F.lit(3))).cast("int").alias("class_id"),
        y1.cast("int").alias("y1"), x1.cast("int").alias("x1"),
        (y1 + F.col("l_quantity").cast("int") + 2).cast("int").alias("y2"),
        (x1 + F.pmod(F.col("l_partkey"), F.lit(13)) + 3).cast("int").alias("x2"),
    )


def pred_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, pred_id, class_id, score, y1..x2: ground truth shifted by l_suppkey % 5.

    The class changes for every seventh supplier so that some predictions miss.
    """
    b = _box_lines(spark, sf_dir)
    y1 = F.pmod(F.col("l_partkey"), F.lit(61))
    x1 = F.pmod(F.col("l_partkey") * 7, F.lit(59))
    s = F.pmod(F.col("l_suppkey"), F.lit(5))
    cls_shift = F.when(F.pmod(F.col("l_suppkey"), F.lit(7)) == 0, 1).otherwise(0)
    return b.select(
        F.col("l_orderkey").alias("image_id"),
        F.col("l_linenumber").alias("pred_id"),
        (F.lit(1) + F.pmod(F.col("l_partkey") + cls_shift, F.lit(3))).cast("int").alias("class_id"),
        F.col("l_discount").alias("score"),
        (y1 + s).cast("int").alias("y1"), (x1 + s).cast("int").alias("x1"),
        (y1 + F.col("l_quantity").cast("int") + 2 + s).cast("int").alias("y2"),
        (x1 + F.pmod(F.col("l_partkey"), F.lit(13)) + 3 + s).cast("int").alias("x2"),
    )


def _column_runs(height: int, ragged: int = 1):
    """The box y1..x2 as an array of column runs (start, length), without empty ones."""
    def run(x):
        y1 = F.col("y1") + F.pmod(x, F.lit(ragged))
        return F.struct((x * height + y1 + 1).cast("long").alias("start"), (F.col("y2") - y1).cast("long").alias("length"))
    return F.filter(F.transform(F.sequence(F.col("x1"), F.col("x2") - 1), run), lambda r: r["length"] > 0)


def masks(spark: SparkSession, sf_dir: str, height: int = IMAGE_H, ragged: int = 1) -> DataFrame:
    """``mask_runs`` packed: one row a gt box, its runs in the array ``runs``."""
    return gt_boxes(spark, sf_dir).select("image_id", F.col("gt_id").alias("instance_id"), _column_runs(height, ragged).alias("runs"))


def pred_masks(spark: SparkSession, sf_dir: str, height: int = IMAGE_H) -> DataFrame:
    """``pred_mask_runs`` packed: one row a predicted box, its runs in the array ``runs``."""
    return pred_boxes(spark, sf_dir).select("image_id", F.col("pred_id").alias("instance_id"), _column_runs(height).alias("runs"))


def mask_runs(spark: SparkSession, sf_dir: str, height: int = IMAGE_H, ragged: int = 1) -> DataFrame:
    """image_id, instance_id, start (1-based, column-major), length: each gt box cut into columns.
    ``ragged`` > 1 starts column x by x % ragged pixels lower, so the mask is not a rectangle."""
    return masks(spark, sf_dir, height, ragged).select("image_id", "instance_id", F.inline("runs"))


def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """image_id, height, width for every order: 128 x 128, images of odd orders 32 pixels wider."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    wider = (F.pmod(F.col("image_id"), F.lit(2)) * 32).cast("int")
    return o.select("image_id", F.lit(IMAGE_H).alias("height"), (F.lit(IMAGE_W) + wider).alias("width"))


def click_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, target for every clicking user: the quality label of the document whose id equals
    the user id (null = test user). A deterministic train/test split derived from ``labels``."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("uid")).distinct()
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("uid"), F.col("quality").alias("target"))
    return users.join(lab, "uid", "left")


def pred_mask_runs(spark: SparkSession, sf_dir: str, height: int = IMAGE_H) -> DataFrame:
    """Prediction masks: each predicted box cut into columns (like ``mask_runs``)."""
    p = pred_boxes(spark, sf_dir)
    col = F.explode(F.sequence(F.col("x1"), F.col("x2") - 1)).alias("x")
    return p.select("image_id", F.col("pred_id").alias("instance_id"), "y1", "y2", col).select(
        "image_id", "instance_id",
        (F.col("x") * height + F.col("y1") + 1).cast("long").alias("start"),
        (F.col("y2") - F.col("y1")).cast("long").alias("length"),
    )


def class_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, source_class_id, name: class lists of two 'data sets' (regions and nations),
    the region list given twice (duplicates must be ignored)."""
    r = table(spark, sf_dir, "region").select(F.lit("region").alias("source"),
                                              F.col("r_regionkey").alias("source_class_id"), F.col("r_name").alias("name"))
    n = table(spark, sf_dir, "nation").select(F.lit("nation").alias("source"),
                                              F.col("n_nationkey").alias("source_class_id"), F.col("n_name").alias("name"))
    return r.unionByName(n).unionByName(r)
