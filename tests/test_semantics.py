"""Hand-made rows for the semantics listed in FIXTURES.md part C."""

import math

from pyspark.sql import functions as F

from tessera.functions import boxes as FB
from tessera.functions import maps as FM
from tessera.operators import aggregate as A
from tessera.operators import counters as C
from tessera.operators import deteval as D
from tessera.operators import encode as E
from tessera.operators import masks as MK
from tessera.operators import spatial as G
from tessera.operators.clean import map_values, tag_filter
from tessera.operators.window import argmax_of_columns


def test_empty_map(spark):
    df = spark.createDataFrame([("{}",)], "t string")
    m = FM.parse_counter_map("t")
    r = df.select(FM.map_size(m).alias("n"), FM.map_sum(m).alias("s"), FM.map_max(m).alias("mx"),
                  FM.map_is_not_empty(m).alias("ne")).first()
    assert (r.n, r.s, r.mx, r.ne) == (0, 0, 0, 0)


def test_duplicate_json_key_last_wins(spark):
    df = spark.createDataFrame([('{"two":3,"three":1,"two":1}',)], "t string")
    r = df.select(FM.parse_counter_map("t").alias("m")).first().m
    assert r["two"] == 1 and r["three"] == 1


def test_sum_and_last_merge(spark):
    df = spark.createDataFrame([(1, 1, 1, '{"a":1}'), (1, 2, 2, '{"a":5}')], "uid int, days int, row_id int, f1 string")
    df = C.with_maps(df, ["f1"])
    s = C.merge_maps_sum(df, "uid", ["f1"]).first()
    last = C.merge_maps_last(df, "uid", ["f1"]).first()
    assert s.value == 6 and last.value == 5


def test_one_row_std_then_fill(spark):
    df = spark.createDataFrame([(1, 10.0)], "k int, v double")
    r = df.groupBy("k").agg(*A.basic_stats_exprs("v", "v", fill_std=False)).first()
    assert r.v_std is None
    r = df.groupBy("k").agg(*A.basic_stats_exprs("v", "v")).first()
    assert r.v_std == 0.0


def test_unmapped_category_is_null(spark):
    df = spark.createDataFrame([("X", 5.0), ("POS", 5.0)], "c string, a double")
    rows = df.select((map_values("c", {"POS": -1}) * F.col("a")).alias("b")).collect()
    assert rows[0].b is None and rows[1].b == -5.0


def test_span_under_a_day(spark):
    df = spark.createDataFrame([(1, "2017-01-01 23:00:00"), (1, "2017-01-02 01:00:00")], "k int, t string")
    df = df.withColumn("t", F.to_timestamp("t"))
    assert df.groupBy("k").agg(A.date_span_days_expr("t").alias("d")).first().d == 0


def test_argmax_tie_first(spark):
    df = spark.createDataFrame([(2, 2, 0, 0, 0, 0)], "a int, b int, c int, d int, e int, f int")
    assert df.select(argmax_of_columns(list("abcdef")).alias("i")).first().i == 0


def test_target_encoding_formula_and_unseen(spark):
    train = spark.createDataFrame([("a", 1)] * 5 + [("a", 0)] * 5 + [("b", 0)] * 40, "c string, target int")
    test = spark.createDataFrame([("a",), ("z",)], "c string")
    # train mean of 'a' is 0.5 with count 10; global mean is 5 / 50 = 0.1
    out = {r.c: r.c_te for r in E.target_encode(train, test, "c", k=10.0).collect()}
    assert math.isclose(out["a"], (0.5 * 10 + 10 * 0.1) / 20)
    assert out["z"] is None
    # the FIXTURES case: mean 0.5, global 0.2, count 10, k 10 -> 0.35
    assert math.isclose((0.5 * 10 + 10 * 0.2) / 20, 0.35)


def test_oof_encoding_never_uses_own_fold(spark):
    rows = [("a", 1, 0), ("a", 1, 0), ("a", 0, 1), ("b", 1, 1)]
    train = spark.createDataFrame(rows, "c string, target int, fold int")
    out = E.target_encode_oof(train, "c", "fold", k=0.0).collect()
    for r in out:
        if r.c == "a" and r.fold == 0:
            assert r.c_te == 0.0          # only the fold-1 row of 'a' counts
        if r.c == "a" and r.fold == 1:
            assert r.c_te == 1.0
        if r.c == "b":
            assert r.c_te is None          # no 'b' outside its own fold


def test_point_on_border_inside_and_empty_zone(spark):
    zones = spark.createDataFrame([(0, 0.0, 0.0, 1.0, 1.0), (1, 5.0, 5.0, 6.0, 6.0)],
                                  "zone_id int, lat_bl double, lon_bl double, lat_tr double, lon_tr double")
    pts = spark.createDataFrame([(0, 0.0, 0.5), (1, 1.0, 1.0), (2, 2.0, 2.0)], "point_id int, lat double, lon double")
    out = {r.zone_id: r.n_points for r in G.point_in_box_count(zones, pts).collect()}
    assert out == {0: 2, 1: 0}


def test_tag_not_in_list(spark):
    df = spark.createDataFrame([({"a": "x"},), ({"k": "bad"},), ({"k": "ok"},)], "tags map<string,string>")
    r = [x.f for x in df.select(tag_filter("tags", {"value_not_in": ("k", ["bad"])}).alias("f")).collect()]
    assert r == [False, False, True]


def test_iou_value(spark):
    df = spark.createDataFrame([(0, 0, 10, 10, 0, 5, 10, 15)], "a1 int, b1 int, c1 int, d1 int, a2 int, b2 int, c2 int, d2 int")
    v = df.select(FB.iou((F.col("a1"), F.col("b1"), F.col("c1"), F.col("d1")),
                         (F.col("a2"), F.col("b2"), F.col("c2"), F.col("d2"))).alias("v")).first().v
    assert math.isclose(v, 50 / 150)


def test_nms_keeps_first_and_third(spark):
    # box 1 and 2 overlap with IoU 0.6, box 3 far away
    rows = [(1, 1, 0.9, 0, 0, 10, 10), (1, 2, 0.8, 0, 0, 10, 6), (1, 3, 0.7, 50, 50, 60, 60)]
    df = spark.createDataFrame(rows, "image_id int, box_id int, score double, y1 int, x1 int, y2 int, x2 int")
    kept = sorted(r.box_id for r in D.non_max_suppression(df, 0.5, "box_id").collect())
    assert kept == [1, 3]


def test_delta_round_trip_and_normalise(spark):
    df = spark.createDataFrame([(2.0, 3.0, 20.0, 13.0, 4.0, 1.0, 30.0, 19.0)],
                               "y1 double, x1 double, y2 double, x2 double, g1 double, g2 double, g3 double, g4 double")
    box = FB.box_cols("")
    gt = (F.col("g1"), F.col("g2"), F.col("g3"), F.col("g4"))
    d = df.select("*", *FB.box_refinement(box, gt))
    back = d.select(*FB.apply_box_deltas(box, [F.col("dy"), F.col("dx"), F.col("dh"), F.col("dw")])).first()
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(back, (4.0, 1.0, 30.0, 19.0)))
    n = spark.createDataFrame([(0, 0, 50, 70)], "y1 int, x1 int, y2 int, x2 int").select(
        *FB.norm_boxes(FB.box_cols(""), 50, 70)).first()
    assert tuple(n) == (0.0, 0.0, 1.0, 1.0)


def test_average_precision_example(spark):
    pred = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.7)], "image_id int, pred_id int, score double")
    gt = spark.createDataFrame([(1, 1), (1, 2)], "image_id int, gt_id int")
    matches = spark.createDataFrame([(1, 1), (1, 3)], "image_id int, pred_id int")
    ap = D.average_precision(pred, gt, matches).first().ap
    assert math.isclose(ap, 0.5 * 1 + 0.5 * 2 / 3)


def test_gt_matched_once(spark):
    pred = spark.createDataFrame([(1, 1, 1, 0.9, 0, 0, 10, 10), (1, 2, 1, 0.8, 0, 0, 10, 10)],
                                 "image_id int, pred_id int, class_id int, score double, y1 int, x1 int, y2 int, x2 int")
    gt = spark.createDataFrame([(1, 1, 1, 0, 0, 10, 10)], "image_id int, gt_id int, class_id int, y1 int, x1 int, y2 int, x2 int")
    m = D.match_detections(pred, gt, 0.5).collect()
    assert [(r.pred_id, r.gt_id) for r in m] == [(1, 1)]


def test_run_length_codes(spark):
    # 2 x 3 mask rows 110 / 011 -> column-major pixels 1 (y0x0), 3 (y0x1), 4 (y1x1), 6 (y1x2)
    runs = spark.createDataFrame([(1, 1, 1, 1), (1, 1, 3, 2), (1, 1, 6, 1)],
                                 "image_id int, instance_id int, start long, length long")
    assert MK.run_length_encode(runs).first().rle == "1 1 3 2 6 1"
    rm = MK.run_length_encode_rowmajor(runs, 2, 3).first()
    assert rm.encoded_pixels == "0 2|4 2|" and rm.pixel_count == 4


def test_image_without_masks_gets_empty_line(spark):
    images = spark.createDataFrame([(1,), (2,)], "image_id int")
    runs = spark.createDataFrame([(1, 1, 1, 2)], "image_id int, instance_id int, start long, length long")
    scores = spark.createDataFrame([(1, 1, 0.5)], "image_id int, instance_id int, score double")
    out = {r.ImageId: r.EncodedPixels for r in MK.submission_rle(images, runs, scores).collect()}
    assert out == {1: "1 2", 2: ""}


def test_rle_round_trip(spark):
    runs = spark.createDataFrame([(1, 1, 5, 3), (1, 1, 20, 4), (1, 2, 1, 1)],
                                 "image_id int, instance_id int, start long, length long")
    enc = MK.run_length_encode(runs)
    dec = MK.run_length_decode(enc, "rle", 10, 10).select("image_id", "instance_id", "start", "length")
    assert sorted(map(tuple, dec.collect())) == sorted(map(tuple, runs.collect()))
