"""Registered detection-table queries (boxes from lineitem arithmetic, masks as column runs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import boxes as FB
from tessera.functions.misc import clean_name
from tessera.operators import anchors as A
from tessera.operators import boxes as B
from tessera.operators import deteval as D
from tessera.operators import masks as MK
from tessera.operators.clean import confidence_filter, degenerate_box_filter, keep_nonempty_instances, trim_zero_rows
from tessera.operators.joins import class_map_join
from tessera.plans.registry import finish, register
from tessera.session import table
from tessera.sources import standins as S

H = S.IMAGE_H
W = S.IMAGE_W

BOX_SQL = """lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_partkey, l_suppkey, l_quantity, l_discount) AS rn FROM lineitem) WHERE rn = 1),
gt AS (SELECT l_orderkey AS image_id, l_linenumber AS gt_id, CAST(1 + l_partkey % 3 AS INTEGER) AS class_id,
         CAST(l_partkey % 61 AS INTEGER) AS y1, CAST((l_partkey * 7) % 59 AS INTEGER) AS x1,
         CAST(l_partkey % 61 + CAST(l_quantity AS INTEGER) + 2 AS INTEGER) AS y2,
         CAST((l_partkey * 7) % 59 + l_partkey % 13 + 3 AS INTEGER) AS x2 FROM lines),
pred AS (SELECT l_orderkey AS image_id, l_linenumber AS pred_id,
         CAST(1 + (l_partkey + CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END) % 3 AS INTEGER) AS class_id,
         l_discount AS score,
         CAST(l_partkey % 61 + l_suppkey % 5 AS INTEGER) AS y1, CAST((l_partkey * 7) % 59 + l_suppkey % 5 AS INTEGER) AS x1,
         CAST(l_partkey % 61 + CAST(l_quantity AS INTEGER) + 2 + l_suppkey % 5 AS INTEGER) AS y2,
         CAST((l_partkey * 7) % 59 + l_partkey % 13 + 3 + l_suppkey % 5 AS INTEGER) AS x2 FROM lines)"""

PAIRS_SQL = """pairs AS (SELECT g.image_id, g.gt_id, p.pred_id, g.class_id AS gt_class, p.class_id AS pred_class, p.score,
    CAST(greatest(least(g.y2, p.y2) - greatest(g.y1, p.y1), 0) * greatest(least(g.x2, p.x2) - greatest(g.x1, p.x1), 0) AS DOUBLE)
    / ((g.y2 - g.y1) * (g.x2 - g.x1) + (p.y2 - p.y1) * (p.x2 - p.x1)
       - greatest(least(g.y2, p.y2) - greatest(g.y1, p.y1), 0) * greatest(least(g.x2, p.x2) - greatest(g.x1, p.x1), 0)) AS iou
  FROM gt g JOIN pred p ON g.image_id = p.image_id AND least(g.y2, p.y2) > greatest(g.y1, p.y1)
                         AND least(g.x2, p.x2) > greatest(g.x1, p.x1))"""


def _pairs(spark, sf_dir):
    j = B.iou_join(S.gt_boxes(spark, sf_dir), S.pred_boxes(spark, sf_dir), "gt_id", "pred_id",
                   a_cols=("class_id",), b_cols=("class_id", "score"), a_prefix="g_", b_prefix="p_")
    return j.select("image_id", F.col("g_gt_id").alias("gt_id"), F.col("p_pred_id").alias("pred_id"),
                    F.col("g_class_id").alias("gt_class"), F.col("p_class_id").alias("pred_class"),
                    F.col("p_score").alias("score"), "iou")


@register("box_iou_pairs", f"""
WITH {BOX_SQL}, {PAIRS_SQL}
SELECT image_id, gt_id, pred_id, round(iou, 6) AS iou FROM pairs""", headline=True)
def q_box_iou_pairs(spark, sf_dir):
    return finish(_pairs(spark, sf_dir).select("image_id", "gt_id", "pred_id", "iou"))


@register("box_best_partners", f"""
WITH {BOX_SQL}, {PAIRS_SQL}
SELECT image_id, gt_id, pred_id, round(iou, 6) AS iou,
  CAST(row_number() OVER (PARTITION BY image_id, gt_id ORDER BY iou DESC, pred_id) = 1 AS INTEGER) AS best_for_left,
  CAST(row_number() OVER (PARTITION BY image_id, pred_id ORDER BY iou DESC, gt_id) = 1 AS INTEGER) AS best_for_right
FROM pairs""")
def q_box_best_partners(spark, sf_dir):
    p = _pairs(spark, sf_dir).select("image_id", "gt_id", "pred_id", "iou")
    return finish(B.argmax_match(p, "gt_id", "pred_id"))


def _algebra_sql():
    cy, cx, h, w = "(p.y1 + 0.5 * (p.y2 - p.y1))", "(p.x1 + 0.5 * (p.x2 - p.x1))", "(p.y2 - p.y1)", "(p.x2 - p.x1)"
    gy, gx, gh, gw = "(g.y1 + 0.5 * (g.y2 - g.y1))", "(g.x1 + 0.5 * (g.x2 - g.x1))", "(g.y2 - g.y1)", "(g.x2 - g.x1)"
    dy, dx = f"(({gy} - {cy}) / {h})", f"(({gx} - {cx}) / {w})"
    dh, dw = f"ln({gh}::DOUBLE / {h})", f"ln({gw}::DOUBLE / {w})"
    ny = f"({cy} + {dy} * {h} - 0.5 * {h} * exp({dh}))"
    nx = f"({cx} + {dx} * {w} - 0.5 * {w} * exp({dw}))"
    return f"""
WITH {BOX_SQL}
SELECT g.image_id, g.gt_id,
  round({dy} / 0.1, 6) AS dy, round({dx} / 0.1, 6) AS dx, round({dh} / 0.2, 6) AS dh, round({dw} / 0.2, 6) AS dw,
  round({ny}, 6) AS ry1, round({nx}, 6) AS rx1, round({ny} + {h} * exp({dh}), 6) AS ry2, round({nx} + {w} * exp({dw}), 6) AS rx2,
  round(g.y1 / 127.0, 6) AS ny1, round(g.x1 / 127.0, 6) AS nx1, round((g.y2 - 1) / 127.0, 6) AS ny2, round((g.x2 - 1) / 127.0, 6) AS nx2,
  CAST(round_even(g.y1 / 127.0 * 127, 0) AS INTEGER) AS dy1, CAST(round_even(g.x1 / 127.0 * 127, 0) AS INTEGER) AS dx1,
  CAST(round_even((g.y2 - 1) / 127.0 * 127 + 1, 0) AS INTEGER) AS dy2, CAST(round_even((g.x2 - 1) / 127.0 * 127 + 1, 0) AS INTEGER) AS dx2,
  CAST(g.x1 AS DOUBLE) AS bx, CAST(g.y1 AS DOUBLE) AS by, CAST(g.x2 - g.x1 AS DOUBLE) AS bw, CAST(g.y2 - g.y1 AS DOUBLE) AS bh,
  (g.y2 - g.y1) * (g.x2 - g.x1) AS area,
  least(5, greatest(2, 4 + CAST(round_even(log2(sqrt(((g.y2 - 1) / 127.0 - g.y1 / 127.0) * ((g.x2 - 1) / 127.0 - g.x1 / 127.0))
        / (224.0 / sqrt(1024.0 * 1024.0))), 0) AS INTEGER))) AS level,
  greatest(least(p.y2, 100), 10) AS cy2
FROM gt g JOIN pred p ON g.image_id = p.image_id AND g.gt_id = p.pred_id
WHERE (g.y2 - g.y1) * (g.x2 - g.x1) > 0 AND greatest(abs(g.y1), abs(g.x1), abs(g.y2), abs(g.x2)) > 0"""


@register("box_algebra", _algebra_sql())
def q_box_algebra(spark, sf_dir):
    g = S.gt_boxes(spark, sf_dir)
    p = S.pred_boxes(spark, sf_dir).select("image_id", F.col("pred_id").alias("gt_id"),
                                           *[F.col(c).alias(f"p_{c}") for c in ("y1", "x1", "y2", "x2")])
    j = trim_zero_rows(degenerate_box_filter(g), ["y1", "x1", "y2", "x2"]).join(p, ["image_id", "gt_id"])
    gb = FB.box_cols("")
    pb = FB.box_cols("p_")
    d = FB.box_refinement(pb, gb, std=B.BBOX_STD)
    back = FB.apply_box_deltas(pb, [F.col(c) for c in ("dy", "dx", "dh", "dw")], std=B.BBOX_STD, prefix="r")
    nb = FB.norm_boxes(gb, H - 1 + 1, W - 1 + 1)
    out = j.select("*", *d, *nb)
    out = out.select("*", *back, *FB.denorm_boxes(FB.box_cols("n"), H, W, prefix="d"),
                     *FB.to_xywh(gb), FB.box_area(gb).alias("area"),
                     FB.pyramid_level(FB.box_cols("n"), 1024, 1024).alias("level"),
                     FB.clip(F.col("p_y2"), 10, 100).alias("cy2"))
    return finish(out.select("image_id", "gt_id", "dy", "dx", "dh", "dw", "ry1", "rx1", "ry2", "rx2",
                             "ny1", "nx1", "ny2", "nx2", "dy1", "dx1", "dy2", "dx2", "bx", "by", "bw", "bh",
                             "area", "level", "cy2"))


# Fixed values of the anchor configuration.
ANCHOR_SCALES = (16, 32, 64)
ANCHOR_RATIOS = (0.5, 1.0, 2.0)
ANCHOR_STRIDES = (8, 16, 32)


SHAPES = ((H, W), (H, W + 32))  # Fixed values: the stand-in's image shapes, even and odd orders


def _anchor_count(h, w):
    return sum(-(-h // st) * -(-w // st) * len(ANCHOR_RATIOS) for st in ANCHOR_STRIDES)


def _anchor_cte():
    """CTE ``anc``: every anchor of the shapes that occur in the data."""
    parts = []
    for h, w in SHAPES:
        offset = 0
        for lvl, (s, st) in enumerate(zip(ANCHOR_SCALES, ANCHOR_STRIDES)):
            n, m = -(-h // st), -(-w // st)
            combos = ", ".join(f"({k}, {s} / sqrt({r}), {s} * sqrt({r}))" for k, r in enumerate(ANCHOR_RATIOS))
            parts.append(f"""SELECT {h} AS height, {w} AS width, {lvl} AS level, {offset} + (c.id * {len(ANCHOR_RATIOS)} + k.k) AS anchor_id,
   (c.id // {m}) * {st} - 0.5 * k.h AS y1, (c.id % {m}) * {st} - 0.5 * k.w AS x1,
   (c.id // {m}) * {st} + 0.5 * k.h AS y2, (c.id % {m}) * {st} + 0.5 * k.w AS x2
 FROM range({n * m}) c(id), (VALUES {combos}) k(k, h, w)""")
            offset += n * m * len(ANCHOR_RATIOS)
    return f"""sizes AS (SELECT o_orderkey AS image_id, {H} AS height, CAST({W} + 32 * (o_orderkey % 2) AS INTEGER) AS width FROM orders),
anc AS (SELECT a.* FROM ({' UNION ALL '.join(parts)}) a SEMI JOIN sizes ON sizes.height = a.height AND sizes.width = a.width)"""


def _anchor_sql():
    return f"""WITH {_anchor_cte()}
SELECT height, width, level, CAST(anchor_id AS BIGINT) AS anchor_id,
  round(y1, 6) AS y1, round(x1, 6) AS x1, round(y2, 6) AS y2, round(x2, 6) AS x2 FROM anc"""


GRID = A.AnchorGrid(ANCHOR_SCALES, ANCHOR_RATIOS, ANCHOR_STRIDES)


@register("pyramid_anchors", _anchor_sql())
def q_pyramid_anchors(spark, sf_dir):
    return finish(A.grid_anchors(S.image_sizes(spark, sf_dir).select("height", "width").distinct(), GRID))


@register("boxes_from_masks", f"""
WITH {BOX_SQL},
runs AS (SELECT image_id, gt_id AS instance_id, x, x * 128 + y1 + 1 AS start, y2 - y1 AS length
         FROM gt, LATERAL (SELECT unnest(range(x1, x2)) AS x))
SELECT image_id, instance_id, CAST(min((start - 1) % 128) AS BIGINT) AS y1, CAST(min(x) AS BIGINT) AS x1,
       CAST(max((start - 1) % 128 + length - 1) + 1 AS BIGINT) AS y2, CAST(max(x) + 1 AS BIGINT) AS x2
FROM runs GROUP BY image_id, instance_id""")
def q_boxes_from_masks(spark, sf_dir):
    return B.boxes_from_runs(S.mask_runs(spark, sf_dir), H)


_RUNS_SQL = """runs AS (SELECT image_id, gt_id AS instance_id, x * 128 + y1 + 1 AS start, y2 - y1 AS length
         FROM gt, LATERAL (SELECT unnest(range(x1, x2)) AS x)),
pruns AS (SELECT image_id, pred_id AS instance_id, x * 128 + y1 + 1 AS start, y2 - y1 AS length
         FROM pred, LATERAL (SELECT unnest(range(x1, x2)) AS x))"""


def _rle_sql(src):
    return f"""m AS (SELECT image_id, instance_id, start, length,
                 CASE WHEN start <= max(start + length) OVER (PARTITION BY image_id, instance_id ORDER BY start, length
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS nw FROM {src}),
i AS (SELECT *, sum(nw) OVER (PARTITION BY image_id, instance_id ORDER BY start, length
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM m),
r AS (SELECT image_id, instance_id, min(start) AS s, max(start + length) - min(start) AS l FROM i
      GROUP BY image_id, instance_id, isl),
enc AS (SELECT image_id, instance_id, string_agg(s || ' ' || l, ' ' ORDER BY s) AS rle FROM r GROUP BY 1, 2)"""


@register("mask_rle", f"""
WITH {BOX_SQL}, {_RUNS_SQL}, {_rle_sql('runs')}
SELECT image_id, instance_id, rle FROM enc""")
def q_mask_rle(spark, sf_dir):
    return MK.run_length_encode(S.masks(spark, sf_dir))


@register("mask_iou_pairs", f"""
WITH {BOX_SQL}, {PAIRS_SQL}
SELECT image_id, gt_id AS a_id, pred_id AS b_id, round(iou, 6) AS iou FROM pairs""")
def q_mask_iou_pairs(spark, sf_dir):
    j = MK.mask_iou_join(S.masks(spark, sf_dir), S.pred_masks(spark, sf_dir), H)
    return finish(j.select("image_id", "a_id", "b_id", "iou"))


@register("recall_at_iou", f"""
WITH {BOX_SQL}, {PAIRS_SQL},
best AS (SELECT image_id, pred_id, arg_max(gt_id, (iou, -gt_id)) AS gt_id, max(iou) AS iou FROM pairs GROUP BY 1, 2),
hit AS (SELECT image_id, count(DISTINCT gt_id) AS n_hit FROM best WHERE iou >= 0.5 GROUP BY 1),
ng AS (SELECT image_id, count(*) AS n_gt FROM gt GROUP BY 1)
SELECT image_id, coalesce(n_hit, 0) AS n_hit, n_gt, round(coalesce(n_hit, 0) / n_gt, 6) AS recall
FROM ng LEFT JOIN hit USING (image_id)""")
def q_recall_at_iou(spark, sf_dir):
    return finish(D.recall_at_iou(S.pred_boxes(spark, sf_dir), S.gt_boxes(spark, sf_dir), 0.5))


@register("confusion_pairs", f"""
WITH {BOX_SQL}, {PAIRS_SQL}
SELECT image_id, gt_id, pred_id, gt_class, pred_class, score, round(iou, 6) AS iou,
  CASE WHEN gt_class = pred_class THEN 'match' ELSE 'wrong' END AS kind
FROM pairs WHERE iou > 0.3""")
def q_confusion_pairs(spark, sf_dir):
    return finish(B.confusion_pairs(S.gt_boxes(spark, sf_dir), S.pred_boxes(spark, sf_dir), 0.3))


_REG_SQL = """cls AS (SELECT 'region' AS source, r_regionkey AS source_class_id, r_name AS name FROM region
        UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation
        UNION ALL SELECT 'region', r_regionkey, r_name FROM region),
ids AS (SELECT source, CAST(source_class_id AS BIGINT) AS source_class_id, min(name) AS name,
               CAST(row_number() OVER (ORDER BY source, source_class_id) AS INTEGER) AS class_id FROM cls GROUP BY 1, source_class_id),
reg AS (SELECT '' AS source, CAST(0 AS BIGINT) AS source_class_id, 'BG' AS name, 0 AS class_id, [0] AS active_class_ids
        UNION ALL SELECT ids.*, list_prepend(0, list_sort(list(class_id) OVER (PARTITION BY source))) FROM ids)"""


@register("class_registry", f"""
WITH {_REG_SQL}
SELECT source, source_class_id, name, class_id, split_part(name, ',', 1) AS short_name,
  array_to_string(active_class_ids, ',') AS active_class_ids FROM reg""")
def q_class_registry(spark, sf_dir):
    reg = B.build_class_registry(S.class_sources(spark, sf_dir))
    return reg.withColumns({"short_name": clean_name("name"),
                            "active_class_ids": F.array_join(F.col("active_class_ids").cast("array<string>"), ",")})


@register("coco_results", f"""
WITH {BOX_SQL}, {_REG_SQL}, {_RUNS_SQL}, {_rle_sql('pruns')}
SELECT p.image_id, p.pred_id, r.source_class_id, CAST(p.x1 AS DOUBLE) AS bx, CAST(p.y1 AS DOUBLE) AS by,
  CAST(p.x2 - p.x1 AS DOUBLE) AS bw, CAST(p.y2 - p.y1 AS DOUBLE) AS bh, round(p.score, 6) AS score, e.rle
FROM pred p LEFT JOIN reg r ON r.class_id = p.class_id
LEFT JOIN enc e ON e.image_id = p.image_id AND e.instance_id = p.pred_id""")
def q_coco_results(spark, sf_dir):
    reg = B.build_class_registry(S.class_sources(spark, sf_dir))
    rle = MK.run_length_encode(S.pred_masks(spark, sf_dir))
    out = D.coco_results(S.pred_boxes(spark, sf_dir), reg, rle)
    return finish(out.drop("source", "name", "active_class_ids"))


@register("detections_to_image", f"""
WITH {BOX_SQL},
n AS (SELECT image_id, pred_id, class_id, score,
        (y1 + 16) / 159.0 AS y1, (x1 + 16) / 159.0 AS x1, (y2 + 16 - 1) / 159.0 AS y2, (x2 + 16 - 1) / 159.0 AS x2 FROM pred),
w AS (SELECT 16 / 159.0 AS wy1, 16 / 159.0 AS wx1, (144 - 1) / 159.0 AS wy2, (144 - 1) / 159.0 AS wx2),
b AS (SELECT image_id, pred_id, class_id, score,
   CAST(round_even((y1 - wy1) / (wy2 - wy1) * 127, 0) AS INTEGER) AS y1,
   CAST(round_even((x1 - wx1) / (wx2 - wx1) * 127, 0) AS INTEGER) AS x1,
   CAST(round_even((y2 - wy1) / (wy2 - wy1) * 127 + 1, 0) AS INTEGER) AS y2,
   CAST(round_even((x2 - wx1) / (wx2 - wx1) * 127 + 1, 0) AS INTEGER) AS x2 FROM n, w)
SELECT image_id, pred_id, class_id, score, y1, x1, y2, x2 FROM b WHERE (y2 - y1) * (x2 - x1) > 0 AND class_id > 0""")
def q_detections_to_image(spark, sf_dir):
    """Predictions placed in a 160 x 160 padded input (16 px border), normalised, then mapped
    back to the 128 x 128 original (round trip through F17 and F20)."""
    p = S.pred_boxes(spark, sf_dir)
    shifted = p.select("image_id", "pred_id", "class_id", "score",
                       *[(F.col(c) + 16).alias(c) for c in ("y1", "x1", "y2", "x2")])
    n = shifted.select("image_id", "pred_id", "class_id", "score", *FB.norm_boxes(FB.box_cols(""), 160, 160, prefix=""))
    back = B.detections_to_image(n, 160, 160, (16, 16, 144, 144), H, W)
    return back.select("image_id", "pred_id", "class_id", "score", "y1", "x1", "y2", "x2")


def _resize_sql(mode, min_dim, max_dim):
    scale = f"greatest(1.0, {min_dim} / least(h, w))"
    if mode == "square":
        scale = f"CASE WHEN round_even(greatest(h, w) * {scale}, 0) > {max_dim} THEN {max_dim} / greatest(h, w) ELSE {scale} END"
    nh = f"CAST(CASE WHEN ({scale}) != 1 THEN round_even(h * ({scale}), 0) ELSE h END AS INTEGER)"
    nw = f"CAST(CASE WHEN ({scale}) != 1 THEN round_even(w * ({scale}), 0) ELSE w END AS INTEGER)"
    if mode == "square":
        top = f"CAST(floor(({max_dim} - {nh}) / 2) AS INTEGER)"
        left = f"CAST(floor(({max_dim} - {nw}) / 2) AS INTEGER)"
        bottom = f"{max_dim} - {nh} - {top}"
        right = f"{max_dim} - {nw} - {left}"
    else:
        def pads(n):
            first = f"CASE WHEN {n} % 64 > 0 THEN CAST(floor(({n} - {n} % 64 + 64 - {n}) / 2) AS INTEGER) ELSE 0 END"
            second = f"CASE WHEN {n} % 64 > 0 THEN {n} - {n} % 64 + 64 - {n} - ({first}) ELSE 0 END"
            return first, second
        top, bottom = pads(nh)
        left, right = pads(nw)
    return (f"SELECT image_id, '{mode}' AS mode, round({scale}, 6) AS scale, {nh} AS new_h, {nw} AS new_w, "
            f"{top} AS top_pad, {bottom} AS bottom_pad, {left} AS left_pad, {right} AS right_pad FROM sz")


@register("resize_geometry", f"""
WITH sz AS (SELECT o_orderkey AS image_id, CAST(64 + (o_orderkey * 13) % 900 AS DOUBLE) AS h,
                   CAST(64 + (o_custkey * 7) % 1200 AS DOUBLE) AS w FROM orders)
{_resize_sql('square', 800, 1024)} UNION ALL {_resize_sql('pad64', 256, None)}""")
def q_resize_geometry(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("image_id"),
        (64 + F.pmod(F.col("o_orderkey") * 13, F.lit(900))).alias("h"),
        (64 + F.pmod(F.col("o_custkey") * 7, F.lit(1200))).alias("w"))
    out = None
    for mode, mn, mx in (("square", 800, 1024), ("pad64", 256, None)):
        g = FB.resize_geometry("h", "w", mode, min_dim=mn, max_dim=mx)
        part = o.select("image_id", F.lit(mode).alias("mode"), g.alias("g")).select(
            "image_id", "mode", "g.scale", "g.new_h", "g.new_w", "g.top_pad", "g.bottom_pad", "g.left_pad", "g.right_pad")
        out = part if out is None else out.unionByName(part)
    return finish(out)


# ---- greedy steps: the oracles repeat the greedy as a recursion over its order ----

def _nms_sql(boxes: str, id_col: str, by: str, thr: float) -> str:
    """CTEs ranking ``boxes`` and walking each group in order; ``kept`` has (by, id_col)."""
    area = lambda t: f"(({t}.y2 - {t}.y1) * ({t}.x2 - {t}.x1))"
    inter = "(least(a.y2, b.y2) - greatest(a.y1, b.y1)) * (least(a.x2, b.x2) - greatest(a.x1, b.x1))"
    same = " AND ".join(f"a.{c} = b.{c}" for c in by.split(", "))
    step = " AND ".join(f"k.{c} = r.{c}" for c in by.split(", "))
    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY score DESC, {id_col}) AS rk FROM {boxes}),
sup AS (SELECT {', '.join(f'b.{c}' for c in by.split(', '))}, b.rk, list(a.rk) AS hi FROM rk a JOIN rk b ON {same} AND a.rk < b.rk
        AND least(a.y2, b.y2) > greatest(a.y1, b.y1) AND least(a.x2, b.x2) > greatest(a.x1, b.x1)
        WHERE CAST({inter} AS DOUBLE) / ({area('a')} + {area('b')} - {inter}) > {thr} GROUP BY ALL),
rs AS (SELECT rk.*, coalesce(sup.hi, []) AS hi FROM rk LEFT JOIN sup USING ({by}, rk)),
walk AS (SELECT {by}, rk, [rk] AS keep FROM rs WHERE rk = 1
  UNION ALL SELECT {', '.join(f'r.{c}' for c in by.split(', '))}, r.rk,
    CASE WHEN list_has_any(k.keep, r.hi) THEN k.keep ELSE list_append(k.keep, r.rk) END
  FROM walk k JOIN rs r ON {step} AND r.rk = k.rk + 1),
last AS (SELECT {by}, arg_max(keep, rk) AS keep FROM walk GROUP BY {by}),
kept AS (SELECT rs.* EXCLUDE (rk, hi) FROM rs JOIN last USING ({by}) WHERE list_contains(keep, rk))"""


def _match_sql(ths, pairs: str = "pairs") -> str:
    """CTEs walking the candidate pairs of each (image, threshold) in greedy order; result ``matched``."""
    return f"""th AS (SELECT unnest([{', '.join(str(float(t)) for t in ths)}]) AS iou_thr),
cand AS (SELECT image_id, iou_thr, pred_id, gt_id, iou,
    row_number() OVER (PARTITION BY image_id, iou_thr ORDER BY score DESC, pred_id, iou DESC, gt_id) AS rk
  FROM {pairs}, th WHERE gt_class = pred_class AND iou >= iou_thr),
mw AS (SELECT image_id, iou_thr, rk, [pred_id] AS ps, [gt_id] AS gs, [rk] AS taken FROM cand WHERE rk = 1
  UNION ALL SELECT c.image_id, c.iou_thr, c.rk,
    CASE WHEN list_contains(ps, c.pred_id) OR list_contains(gs, c.gt_id) THEN ps ELSE list_append(ps, c.pred_id) END,
    CASE WHEN list_contains(ps, c.pred_id) OR list_contains(gs, c.gt_id) THEN gs ELSE list_append(gs, c.gt_id) END,
    CASE WHEN list_contains(ps, c.pred_id) OR list_contains(gs, c.gt_id) THEN taken ELSE list_append(taken, c.rk) END
  FROM mw JOIN cand c ON c.image_id = mw.image_id AND c.iou_thr = mw.iou_thr AND c.rk = mw.rk + 1),
ml AS (SELECT image_id, iou_thr, arg_max(taken, rk) AS taken FROM mw GROUP BY 1, 2),
matched AS (SELECT c.* EXCLUDE (rk) FROM cand c JOIN ml USING (image_id, iou_thr) WHERE list_contains(taken, rk))"""


_AP_SQL = """ng AS (SELECT image_id, count(*) AS n_gt FROM gt GROUP BY 1),
pr AS (SELECT pred.image_id, th.iou_thr, pred.pred_id, score, CAST(m.pred_id IS NOT NULL AS INTEGER) AS tp
       FROM pred CROSS JOIN th LEFT JOIN matched m ON m.image_id = pred.image_id AND m.pred_id = pred.pred_id AND m.iou_thr = th.iou_thr),
cum AS (SELECT *, sum(tp) OVER w / row_number() OVER w AS prec FROM pr
        WINDOW w AS (PARTITION BY image_id, iou_thr ORDER BY score DESC, pred_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
env AS (SELECT *, max(prec) OVER (PARTITION BY image_id, iou_thr ORDER BY score DESC, pred_id
                                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM cum),
ap AS (SELECT image_id, iou_thr, sum(tp * e) / any_value(n_gt) AS ap FROM env JOIN ng USING (image_id) GROUP BY 1, 2)"""
AP_THRESHOLDS = [round(0.5 + 0.05 * i, 2) for i in range(10)]


@register("nms_predictions", f"""
WITH RECURSIVE {BOX_SQL}, {_nms_sql('pred', 'pred_id', 'image_id', 0.3)}
SELECT * FROM kept""")
def q_nms_predictions(spark, sf_dir):
    p = S.pred_boxes(spark, sf_dir)
    return D.non_max_suppression(p, 0.3, "pred_id", by=("image_id",))


@register("match_detections", f"""
WITH RECURSIVE {BOX_SQL}, {PAIRS_SQL}, {_match_sql([0.5])}
SELECT image_id, pred_id, gt_id, round(iou, 6) AS iou FROM matched""")
def q_match_detections(spark, sf_dir):
    return finish(D.match_detections(S.pred_boxes(spark, sf_dir), S.gt_boxes(spark, sf_dir), 0.5))


@register("average_precision", f"""
WITH RECURSIVE {BOX_SQL}, {PAIRS_SQL}, {_match_sql([0.5])}, {_AP_SQL}
SELECT image_id, round(ap, 6) AS ap FROM ap""", headline=True)
def q_average_precision(spark, sf_dir):
    pred, gt = S.pred_boxes(spark, sf_dir), S.gt_boxes(spark, sf_dir)
    return finish(D.average_precision(pred, gt, D.match_detections(pred, gt, 0.5)))


@register("ap_range", f"""
WITH RECURSIVE {BOX_SQL}, {PAIRS_SQL}, {_match_sql(AP_THRESHOLDS)}, {_AP_SQL}
SELECT image_id, round(avg(ap), 6) AS map_50_95 FROM ap GROUP BY image_id""", headline=True)
def q_ap_range(spark, sf_dir):
    pred, gt = S.pred_boxes(spark, sf_dir), S.gt_boxes(spark, sf_dir)
    per = D.ap_range(pred, gt)
    return finish(per.groupBy("image_id").agg(F.avg("ap").alias("map_50_95")))


@register("mask_match_detections", f"""
WITH RECURSIVE {BOX_SQL},
gc AS (SELECT image_id, gt_id, class_id, x, y1 + x % 3 AS s, y2 AS e FROM gt, LATERAL (SELECT unnest(range(x1, x2)) AS x) WHERE y1 + x % 3 < y2),
pc AS (SELECT image_id, pred_id, class_id, score, x, y1 AS s, y2 AS e FROM pred, LATERAL (SELECT unnest(range(x1, x2)) AS x)),
ga AS (SELECT image_id, gt_id, sum(e - s) AS area FROM gc GROUP BY 1, 2),
pa AS (SELECT image_id, pred_id, sum(e - s) AS area FROM pc GROUP BY 1, 2),
inter AS (SELECT gc.image_id, gt_id, pred_id, any_value(gc.class_id) AS gt_class, any_value(pc.class_id) AS pred_class, any_value(score) AS score,
    sum(least(gc.e, pc.e) - greatest(gc.s, pc.s)) AS n
  FROM gc JOIN pc ON gc.image_id = pc.image_id AND gc.x = pc.x AND least(gc.e, pc.e) > greatest(gc.s, pc.s) GROUP BY 1, 2, 3),
pairs AS (SELECT inter.*, CAST(n AS DOUBLE) / (ga.area + pa.area - n) AS iou FROM inter JOIN ga USING (image_id, gt_id) JOIN pa USING (image_id, pred_id)),
{_match_sql([0.5])}
SELECT image_id, pred_id, gt_id, round(iou, 6) AS iou FROM matched""")
def q_mask_match_detections(spark, sf_dir):
    """Matching by mask overlap; the gt masks have a ragged upper edge, so mask and box overlap differ."""
    pred, gt = S.pred_boxes(spark, sf_dir), S.gt_boxes(spark, sf_dir)
    pairs = D.mask_pairs(pred, gt, S.pred_masks(spark, sf_dir), S.masks(spark, sf_dir, ragged=3), H)
    return finish(D.match_detections(pred, gt, 0.5, pairs=pairs))


@register("refine_detections", f"""
WITH RECURSIVE {BOX_SQL},
conf AS (SELECT p.image_id, p.pred_id AS roi_id, p.class_id, 0.5 + 5 * p.score AS score,
    greatest(least(CAST(g.y1 AS DOUBLE), {H}), 0) AS y1, greatest(least(CAST(g.x1 AS DOUBLE), {W}), 0) AS x1,
    greatest(least(CAST(g.y2 AS DOUBLE), {H}), 0) AS y2, greatest(least(CAST(g.x2 AS DOUBLE), {W}), 0) AS x2
  FROM pred p JOIN gt g ON g.image_id = p.image_id AND g.gt_id = p.pred_id WHERE 0.5 + 5 * p.score >= 0.7),
{_nms_sql('conf', 'roi_id', 'image_id, class_id', 0.3)}
SELECT image_id, roi_id, class_id, round(score, 6) AS score, round(y1, 6) AS y1, round(x1, 6) AS x1, round(y2, 6) AS y2, round(x2, 6) AS x2
FROM kept""")
def q_refine_detections(spark, sf_dir):
    """Class rows from predictions: the predicted class with prob 0.5 + 5 * score and the
    deltas that move the box onto its gt, background with the rest; refined, filtered,
    class-wise NMS, top 100."""
    p = S.pred_boxes(spark, sf_dir)
    g = S.gt_boxes(spark, sf_dir).select("image_id", F.col("gt_id").alias("pred_id"),
                                         *[F.col(c).alias(f"g_{c}") for c in ("y1", "x1", "y2", "x2")])
    j = p.join(g, ["image_id", "pred_id"])
    d = FB.box_refinement(FB.box_cols(""), FB.box_cols("g_"), std=B.BBOX_STD)
    fg = j.select("image_id", F.col("pred_id").alias("roi_id"), "y1", "x1", "y2", "x2", "class_id",
                  (F.lit(0.5) + 5 * F.col("score")).alias("prob"), *d)
    bg = fg.select("image_id", "roi_id", "y1", "x1", "y2", "x2", F.lit(0).alias("class_id"),
                   (1 - F.col("prob")).alias("prob"), *[F.lit(0.0).alias(f"d{c}") for c in "yxhw"])
    return finish(D.refine_detections(fg.unionByName(bg), (0, 0, H, W), min_conf=0.7, nms_thr=0.3))


@register("propose_regions", f"""
WITH RECURSIVE {BOX_SQL},
win AS (SELECT image_id, pred_id AS anchor_id, score, least(y1 / 127.0, 1) AS y1, least(x1 / 127.0, 1) AS x1,
          least(y2 / 127.0, 1) AS y2, least(x2 / 127.0, 1) AS x2 FROM pred),
{_nms_sql('win', 'anchor_id', 'image_id', 0.7)}
SELECT image_id, anchor_id, score, round(y1, 6) AS y1, round(x1, 6) AS x1, round(y2, 6) AS y2, round(x2, 6) AS x2 FROM kept""")
def q_propose_regions(spark, sf_dir):
    p = S.pred_boxes(spark, sf_dir)
    scored = p.select("image_id", F.col("pred_id").alias("anchor_id"), "score",
                      *[(F.col(c) / 127.0).alias(c) for c in ("y1", "x1", "y2", "x2")],
                      *[F.lit(0.0).alias(c) for c in ("dy", "dx", "dh", "dw")])
    return finish(D.propose(scored, pre_nms=6000, nms_thr=0.7, post_nms=1000))


def _hash_sql(seed, *cols):
    return f"CAST('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(cols)})), 1, 7) AS BIGINT)"


def _delta_sql(box, to, std):
    """Four refinement columns from alias ``box`` to alias ``to``."""
    bh, bw, gh, gw = f"({box}.y2 - {box}.y1)", f"({box}.x2 - {box}.x1)", f"({to}.y2 - {to}.y1)", f"({to}.x2 - {to}.x1)"
    return (f"round((({to}.y1 + 0.5 * {gh}) - ({box}.y1 + 0.5 * {bh})) / {bh} / {std[0]}, 6) AS dy, "
            f"round((({to}.x1 + 0.5 * {gw}) - ({box}.x1 + 0.5 * {bw})) / {bw} / {std[1]}, 6) AS dx, "
            f"round(ln(CAST({gh} AS DOUBLE) / {bh}) / {std[2]}, 6) AS dh, round(ln(CAST({gw} AS DOUBLE) / {bw}) / {std[3]}, 6) AS dw")


def _iou_sql(a, b):
    inter = f"(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1)) * (least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"
    return (f"CAST({inter} AS DOUBLE) / (({a}.y2 - {a}.y1) * ({a}.x2 - {a}.x1) + ({b}.y2 - {b}.y1) * ({b}.x2 - {b}.x1) - {inter})")


RPN_PER_IMAGE, RPN_SEED = 64, 7
_N_P = [(w, _anchor_count(h, w), B.next_prime(_anchor_count(h, w))) for h, w in SHAPES]


@register("rpn_anchor_targets", f"""
WITH {BOX_SQL}, {_anchor_cte()},
img AS (SELECT * FROM sizes SEMI JOIN gt USING (image_id)),
pr AS (SELECT g.image_id, g.gt_id, a.anchor_id, {_iou_sql('g', 'a')} AS iou
  FROM gt g JOIN img USING (image_id) JOIN anc a ON a.height = img.height AND a.width = img.width
    AND least(g.y2, a.y2) > greatest(g.y1, a.y1) AND least(g.x2, a.x2) > greatest(g.x1, a.x1)),
per AS (SELECT image_id, anchor_id, max(iou) AS mi, arg_max(gt_id, (iou, -gt_id)) AS gt_id FROM pr GROUP BY 1, 2),
best AS (SELECT DISTINCT image_id, anchor_id FROM (SELECT image_id, gt_id, arg_max(anchor_id, (iou, -anchor_id)) AS anchor_id FROM pr GROUP BY 1, 2)),
lab AS (SELECT per.*, CASE WHEN best.image_id IS NOT NULL OR mi >= 0.7 THEN 1 WHEN mi < 0.3 THEN -1 ELSE 0 END AS match
        FROM per LEFT JOIN best ON best.image_id = per.image_id AND best.anchor_id = per.anchor_id),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id
          ORDER BY md5(concat_ws('|', '{RPN_SEED}', image_id, anchor_id)), anchor_id) AS rn FROM lab WHERE match = 1) WHERE rn <= {RPN_PER_IMAGE // 2}),
np AS (SELECT image_id, count(*) AS n FROM pos GROUP BY 1),
barred AS (SELECT image_id, anchor_id FROM lab WHERE match <> -1),
nb AS (SELECT image_id, count(*) AS k FROM barred GROUP BY 1),
np_(width, n, p) AS (VALUES {', '.join(f'({w}, {n}, {p})' for w, n, p in _N_P)}),
par AS (SELECT img.image_id, s.n, s.p, {RPN_PER_IMAGE} - coalesce(np.n, 0) AS want, coalesce(nb.k, 0) AS k,
          1 + {_hash_sql(RPN_SEED + 1, 'img.image_id')} % (s.p - 1) AS a, {_hash_sql(RPN_SEED + 2, 'img.image_id')} % s.p AS b
        FROM img JOIN np_ s ON s.width = img.width LEFT JOIN np ON np.image_id = img.image_id LEFT JOIN nb ON nb.image_id = img.image_id),
steps AS (SELECT *, unnest(range(least(p, want + k + p - n))) AS j FROM par),
free AS (SELECT image_id, (a * j + b) % p AS anchor_id, j, want FROM steps WHERE (a * j + b) % p < n),
neg AS (SELECT image_id, anchor_id FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY j) AS rn
          FROM free ANTI JOIN barred USING (image_id, anchor_id)) WHERE rn <= want)
SELECT pos.image_id, pos.anchor_id, 1 AS match, {_delta_sql('a', 'g', B.RPN_STD)}
FROM pos JOIN img USING (image_id) JOIN gt g ON g.image_id = pos.image_id AND g.gt_id = pos.gt_id
  JOIN anc a ON a.height = img.height AND a.width = img.width AND a.anchor_id = pos.anchor_id
UNION ALL SELECT image_id, anchor_id, -1, NULL, NULL, NULL, NULL FROM neg""", headline=True)
def q_rpn_anchor_targets(spark, sf_dir):
    gt = S.gt_boxes(spark, sf_dir)
    images = S.image_sizes(spark, sf_dir).join(gt.select("image_id").distinct(), "image_id", "left_semi")
    return finish(A.label_grid_anchors(GRID, gt, images, per_image=RPN_PER_IMAGE, seed=RPN_SEED))


ROIS, ROI_SEED, NEAR = 20, 3, int(20 * 0.9)


def _rois_sql():
    """CTE ``rois``: the random boxes of D16."""
    u = [f"{_hash_sql(ROI_SEED + i, 'b.image_id', 'b.k')} / 268435456.0" for i in range(4)]

    def lo(a, b, side):
        return f"greatest(least(floor(least({a}, {b})), {side} - 1.0), 0.0)"

    def hi(a, b, side, low):
        return f"greatest(greatest(least(floor(greatest({a}, {b})), CAST({side} AS DOUBLE)), 0.0), {low} + 1)"
    return f"""img AS (SELECT s.* FROM (SELECT o_orderkey AS image_id, {H} AS height, CAST({W} + 32 * (o_orderkey % 2) AS INTEGER) AS width FROM orders) s SEMI JOIN gt USING (image_id)),
gn AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY gt_id) - 1 AS r FROM gt),
gc AS (SELECT image_id, count(*) AS g FROM gt GROUP BY 1),
b2 AS (SELECT img.*, t.k, coalesce(gc.g, 0) AS g FROM img CROSS JOIN range({ROIS}) t(k) LEFT JOIN gc USING (image_id)),
b3 AS (SELECT b.*, gn.y1, gn.x1, gn.y2, gn.x2, (b.k < {NEAR} AND b.g > 0) AS near,
         {u[0]} AS u0, {u[1]} AS u1, {u[2]} AS u2, {u[3]} AS u3
       FROM b2 b LEFT JOIN gn ON gn.image_id = b.image_id AND b.k < {NEAR} AND b.g > 0 AND gn.r = b.k % b.g),
c AS (SELECT *, CASE WHEN near THEN y1 - (y2 - y1) + u0 * 2 * (y2 - y1) ELSE u0 * height END AS ya,
         CASE WHEN near THEN y2 - (y2 - y1) + u1 * 2 * (y2 - y1) ELSE u1 * height END AS yb,
         CASE WHEN near THEN x1 - (x2 - x1) + u2 * 2 * (x2 - x1) ELSE u2 * width END AS xa,
         CASE WHEN near THEN x2 - (x2 - x1) + u3 * 2 * (x2 - x1) ELSE u3 * width END AS xb FROM b3),
d AS (SELECT *, {lo('ya', 'yb', 'height')} AS ry, {lo('xa', 'xb', 'width')} AS rx FROM c),
rois AS (SELECT image_id, k AS roi_id, CAST(near AS INTEGER) AS near_gt, CAST(ry AS INTEGER) AS y1, CAST(rx AS INTEGER) AS x1,
         CAST({hi('ya', 'yb', 'height', 'ry')} AS INTEGER) AS y2, CAST({hi('xa', 'xb', 'width', 'rx')} AS INTEGER) AS x2 FROM d)"""


@register("random_rois", f"WITH {BOX_SQL}, {_rois_sql()}\nSELECT * FROM rois")
def q_random_rois(spark, sf_dir):
    gt = S.gt_boxes(spark, sf_dir)
    images = S.image_sizes(spark, sf_dir).join(gt.select("image_id").distinct(), "image_id", "left_semi")
    return B.random_rois(gt, images, ROIS, seed=ROI_SEED)


@register("training_rois", f"""
WITH {BOX_SQL}, {_rois_sql()},
pr AS (SELECT r.image_id, r.roi_id, g.gt_id, {_iou_sql('r', 'g')} AS iou FROM rois r JOIN gt g ON g.image_id = r.image_id
    AND least(g.y2, r.y2) > greatest(g.y1, r.y1) AND least(g.x2, r.x2) > greatest(g.x1, r.x1)),
best AS (SELECT image_id, roi_id, max(iou) AS mi, arg_max(gt_id, (iou, -gt_id)) AS gt_id FROM pr GROUP BY 1, 2),
rb AS (SELECT r.*, coalesce(mi, 0) AS mi, best.gt_id FROM rois r LEFT JOIN best ON best.image_id = r.image_id AND best.roi_id = r.roi_id),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat_ws('|', '5', image_id, roi_id)), roi_id) AS rn
          FROM rb WHERE mi >= 0.5) WHERE rn <= 5),
np AS (SELECT image_id, count(*) AS n FROM pos GROUP BY 1),
neg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY md5(concat_ws('|', '6', image_id, roi_id)), roi_id) AS rn
          FROM rb WHERE mi < 0.5) x JOIN np USING (image_id) WHERE rn <= CAST(floor(n * (1.0 / 0.33 - 1.0)) AS INTEGER) AND rn <= 10)
SELECT r.image_id, r.roi_id, g.class_id, {_delta_sql('r', 'g', B.BBOX_STD)}
FROM pos r JOIN gt g ON g.image_id = r.image_id AND g.gt_id = r.gt_id
UNION ALL SELECT image_id, roi_id, 0, 0.0, 0.0, 0.0, 0.0 FROM neg""")
def q_training_rois(spark, sf_dir):
    gt = S.gt_boxes(spark, sf_dir)
    images = S.image_sizes(spark, sf_dir).join(gt.select("image_id").distinct(), "image_id", "left_semi")
    rois = B.random_rois(gt, images, ROIS, seed=ROI_SEED)
    return finish(B.sample_training_rois(rois, gt, per_image=16, seed=5))


@register("confident_nonempty", f"""
WITH {BOX_SQL}, {_RUNS_SQL},
ne AS (SELECT image_id, instance_id FROM pruns GROUP BY image_id, instance_id HAVING sum(length) > 0)
SELECT p.image_id, p.pred_id AS instance_id, p.class_id, p.score, p.y1, p.x1, p.y2, p.x2
FROM pred p SEMI JOIN ne ON ne.image_id = p.image_id AND ne.instance_id = p.pred_id
WHERE p.class_id > 0 AND p.score >= 0.05""")
def q_confident_nonempty(spark, sf_dir):
    """P14 + P17: confident predictions whose mask has pixels."""
    p = confidence_filter(S.pred_boxes(spark, sf_dir), 0.05)
    inst = p.withColumnRenamed("pred_id", "instance_id")
    return keep_nonempty_instances(inst, S.pred_mask_runs(spark, sf_dir))


@register("mask_overlap_submission", f"""
WITH {BOX_SQL}, {_RUNS_SQL},
px AS (SELECT r.image_id, r.instance_id, p.score, unnest(range(r.start, r.start + r.length)) AS pos
       FROM runs r JOIN pred p ON p.image_id = r.image_id AND p.pred_id = r.instance_id),
kept AS (SELECT image_id, instance_id, pos FROM (
   SELECT *, row_number() OVER (PARTITION BY image_id, pos ORDER BY score DESC, instance_id) AS rk FROM px) WHERE rk = 1),
isl AS (SELECT image_id, instance_id, pos, pos - row_number() OVER (PARTITION BY image_id, instance_id ORDER BY pos) AS g FROM kept),
rr AS (SELECT image_id, instance_id, min(pos) AS s, count(*) AS l FROM isl GROUP BY image_id, instance_id, g),
enc AS (SELECT image_id, instance_id, string_agg(s || ' ' || l, ' ' ORDER BY s) AS rle FROM rr GROUP BY 1, 2)
SELECT o.o_orderkey AS ImageId, enc.instance_id, coalesce(enc.rle, '') AS EncodedPixels
FROM orders o LEFT JOIN enc ON enc.image_id = o.o_orderkey""")
def q_mask_overlap_submission(spark, sf_dir):
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"))
    scores = S.pred_boxes(spark, sf_dir).select("image_id", F.col("pred_id").alias("instance_id"), "score")
    return MK.submission_rle(images, S.masks(spark, sf_dir), scores)


# Class id -> submission label id.
LABEL_MAP = {3: 33, 4: 34, 2: 35, 1: 36, 8: 38, 6: 39}


@register("video_submission", f"""
WITH {BOX_SQL}, {_RUNS_SQL},
px AS (SELECT image_id, instance_id, unnest(range(start, start + length)) AS pos FROM pruns),
rm AS (SELECT image_id, instance_id, ((pos - 1) % 128) * 128 + (pos - 1) // 128 AS rpos FROM px),
isl AS (SELECT *, rpos - row_number() OVER (PARTITION BY image_id, instance_id ORDER BY rpos) AS g FROM rm),
rr AS (SELECT image_id, instance_id, min(rpos) AS s, count(*) AS l FROM isl GROUP BY 1, 2, g),
enc AS (SELECT image_id, instance_id, string_agg(s || ' ' || l, '|' ORDER BY s) || '|' AS ep, sum(l) AS pc FROM rr GROUP BY 1, 2)
SELECT 'img_' || CAST(p.image_id AS VARCHAR) AS ImageId,
  CASE p.class_id {' '.join(f'WHEN {k} THEN {v}' for k, v in LABEL_MAP.items())} END AS LabelId,
  p.score AS Confidence, CAST(enc.pc AS BIGINT) AS PixelCount, enc.ep AS EncodedPixels
FROM pred p JOIN enc ON enc.image_id = p.image_id AND enc.instance_id = p.pred_id
WHERE p.class_id IN ({', '.join(str(k) for k in LABEL_MAP)}) AND enc.pc > 0""")
def q_video_submission(spark, sf_dir):
    det = S.pred_boxes(spark, sf_dir).select(
        "image_id", F.col("pred_id").alias("instance_id"), "class_id", "score",
        F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".jpg")).alias("file_name"))
    return MK.video_submission(S.pred_masks(spark, sf_dir), det, LABEL_MAP, H, W)
