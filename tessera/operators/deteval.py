"""Detection post-processing and scoring.

The greedy steps (NMS, matching) run as rounds over candidate pairs, one path at every
size: each round takes every box or pair that is first among all it competes with, which
is what the greedy would take, and drops what that decides. The pairs are those of
``boxes.iou_join`` (overlapping boxes only), so a crowded image spreads over many tasks.
A round is a few aggregations and one checkpoint; the number of rounds is the longest
chain of boxes that depend on each other, not the size of an image.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.boxes import BBOX_STD, apply_deltas_clip, iou_join
from tessera.operators.window import top_k_per_group
from tessera.session import cut_lineage

__all__ = ["non_max_suppression", "propose", "refine_detections", "detection_pairs", "mask_pairs", "match_detections",
           "average_precision", "ap_range", "recall_at_iou", "coco_results"]


def non_max_suppression(df: DataFrame, thr: float, id_col: str, by=("image_id",), score: str = "score",
                        max_out: int | None = None, cell: float = 32) -> DataFrame:
    """Greedy NMS per group (D4): best score first (ties: smaller id), boxes with IoU > ``thr``
    to it dropped; returns the kept rows, optionally the best ``max_out`` per group. ``cell`` is
    the grid size of the pair join in the boxes' own units (pixels, or a fraction).

    Suppression edges hi -> lo join boxes that overlap with IoU > thr, hi first in greedy order.
    A box without an undecided box before it on an edge is kept (if one of them had been kept it
    would be gone); boxes after a kept one are dropped; the rest go to the next round."""
    by = list(by)
    keys = [*by, id_col]
    boxes = df.select(*keys, score, "y1", "x1", "y2", "x2")
    pairs = iou_join(boxes, boxes, id_col, id_col, image=by, cell=cell, a_cols=(score,), b_cols=(score,),
                     a_prefix="h_", b_prefix="l_")
    hs, ls, hid, lid = (F.col(c) for c in (f"h_{score}", f"l_{score}", f"h_{id_col}", f"l_{id_col}"))
    before = (hs > ls) | ((hs == ls) & (hid < lid))
    edges = cut_lineage(pairs.filter(before & (F.col("iou") > F.lit(thr))).select(*by, hid.alias("_hi"), lid.alias("_lo")))
    dropped = None
    hi, lo = [*by, "_hi"], [*by, "_lo"]
    while True:
        # free: on an edge as its first box, and behind no other box
        free = edges.select(*hi).distinct().join(edges.select(*by, F.col("_lo").alias("_hi")).distinct(), hi, "left_anti")
        gone = edges.join(free, hi, "left_semi").select(*lo).distinct()
        gone = cut_lineage(gone)
        if gone.isEmpty():
            break
        dropped = gone if dropped is None else dropped.unionByName(gone)
        left = edges.join(gone, lo, "left_anti")
        edges = cut_lineage(left.join(gone.select(*by, F.col("_lo").alias("_hi")), hi, "left_anti"))
    kept = df if dropped is None else df.join(dropped.withColumnRenamed("_lo", id_col), keys, "left_anti")
    if max_out:
        kept = top_k_per_group(kept, by, score, max_out, tie_break=[id_col])
    return kept


def _window_cell(window) -> float:
    """Pair-join grid cell in the window's units: an eighth of its larger side."""
    return max(float(window[2]) - float(window[0]), float(window[3]) - float(window[1])) / 8


def propose(anchors_scored: DataFrame, window=(0.0, 0.0, 1.0, 1.0), pre_nms: int = 6000, nms_thr: float = 0.7,
            post_nms: int = 1000, std=(0.1, 0.1, 0.2, 0.2)) -> DataFrame:
    """Region proposals (D7): best pre_nms anchors per image by score, deltas applied (std
    scaled), clipped to the window, NMS at nms_thr, best post_nms kept. Input rows:
    image_id, anchor_id, score, y1..x2 (normalised), dy, dx, dh, dw."""
    top = top_k_per_group(anchors_scored, ["image_id"], "score", pre_nms, tie_break=["anchor_id"])
    win = tuple(F.lit(float(v)) for v in window)
    moved = apply_deltas_clip(top, [F.col(c) for c in ("dy", "dx", "dh", "dw")], win, std=std)
    moved = moved.select("image_id", "anchor_id", "score", "y1", "x1", "y2", "x2")
    return non_max_suppression(moved, nms_thr, "anchor_id", max_out=post_nms, cell=_window_cell(window))


def refine_detections(class_rows: DataFrame, window, min_conf: float = 0.7, nms_thr: float = 0.3,
                      max_inst: int = 100) -> DataFrame:
    """Final detections (D8). Input long form: image_id, roi_id, y1..x2, class_id, prob,
    dy, dx, dh, dw (one row per roi and class). Per roi the most probable class and its
    deltas (std scaled) refine the box, clipped to the window; background and low
    confidence dropped; class-wise NMS; best ``max_inst`` per image."""
    best = class_rows.groupBy("image_id", "roi_id").agg(
        F.max_by(F.struct("class_id", "prob", "dy", "dx", "dh", "dw", "y1", "x1", "y2", "x2"),
                 F.struct(F.col("prob"), -F.col("class_id"))).alias("b"))
    b = best.select("image_id", "roi_id", "b.*").withColumnRenamed("prob", "score")
    win = tuple(F.lit(float(v)) for v in window)
    ref = apply_deltas_clip(b, [F.col(c) for c in ("dy", "dx", "dh", "dw")], win, std=BBOX_STD)
    ref = ref.filter((F.col("class_id") > 0) & (F.col("score") >= min_conf)) \
             .select("image_id", "roi_id", "class_id", "score", "y1", "x1", "y2", "x2")
    kept = non_max_suppression(ref, nms_thr, "roi_id", by=("image_id", "class_id"), cell=_window_cell(window))
    return top_k_per_group(kept, ["image_id"], "score", max_inst, tie_break=["roi_id"])


def detection_pairs(pred: DataFrame, gt: DataFrame, cell: int = 32) -> DataFrame:
    """Candidate pairs of overlapping boxes with scores, classes and box IoU."""
    pairs = iou_join(pred.select("image_id", "pred_id", "class_id", "score", "y1", "x1", "y2", "x2"),
                     gt.select("image_id", "gt_id", "class_id", "y1", "x1", "y2", "x2"),
                     "pred_id", "gt_id", cell=cell, a_cols=("class_id", "score"), b_cols=("class_id",),
                     a_prefix="p_", b_prefix="g_")
    return pairs.select("image_id", F.col("p_pred_id").alias("pred_id"), F.col("g_gt_id").alias("gt_id"),
                        F.col("p_score").alias("score"), F.col("p_class_id").alias("pred_class"),
                        F.col("g_class_id").alias("gt_class"), "iou")


def mask_pairs(pred: DataFrame, gt: DataFrame, pred_runs: DataFrame, gt_runs: DataFrame, height: int) -> DataFrame:
    """Candidate pairs with mask IoU instead of box IoU; runs as in ``masks.mask_iou_join``."""
    from tessera.operators.masks import mask_iou_join, pack_runs

    def labelled(runs, boxes, key, cols):
        m = pack_runs(runs).withColumnRenamed("instance_id", key)
        return m.join(boxes.select("image_id", key, *cols), ["image_id", key])
    j = mask_iou_join(labelled(gt_runs, gt, "gt_id", ["class_id"]), labelled(pred_runs, pred, "pred_id", ["class_id", "score"]),
                      height, "gt_id", "pred_id", a_cols=("class_id",), b_cols=("class_id", "score"))
    return j.select("image_id", F.col("b_id").alias("pred_id"), F.col("a_id").alias("gt_id"), F.col("b_score").alias("score"),
                    F.col("b_class_id").alias("pred_class"), F.col("a_class_id").alias("gt_class"), "iou")


def match_detections(pred: DataFrame, gt: DataFrame, thr: float = 0.5, min_overlap: float = 0.0,
                     cell: int = 32, thresholds=None, pairs: DataFrame | None = None) -> DataFrame:
    """Greedy matching per image (D10): (image_id, [iou_thr,] pred_id, gt_id, iou) of matched
    predictions. Predictions in score order (ties: smaller id) take the best free gt of their
    class with IoU >= thr (ties: smaller gt id). ``thresholds`` evaluates several IoU thresholds
    in one pass; ``pairs`` brings other candidates (``mask_pairs`` for masks).

    The greedy takes pairs in one total order (score desc, prediction id, IoU desc, gt id) and
    keeps a pair when both ends are free. A pair that is first among all pairs of its prediction
    and of its gt is kept by it; each round keeps those and drops the pairs that touch them. Pairs
    that share no end with another go past the rounds and are not laid out a threshold a row."""
    ths = [float(t) for t in (thresholds if thresholds is not None else [thr])]
    pairs = detection_pairs(pred, gt, cell) if pairs is None else pairs
    pairs = pairs.filter((F.col("pred_class") == F.col("gt_class")) & (F.col("iou") >= F.lit(max(min(ths), min_overlap))))
    g = ["image_id", "iou_thr"]
    p_key, g_key = [*g, "pred_id"], [*g, "gt_id"]
    at = F.explode(F.array(*[F.lit(t) for t in ths])).alias("iou_thr")
    cols = ["image_id", "pred_id", "gt_id", "score", "iou"]
    # a pair whose ends are in no other pair is matched at every threshold it reaches; rounds are for the rest
    by_pred, by_gt = Window.partitionBy("image_id", "pred_id"), Window.partitionBy("image_id", "gt_id")
    pairs = pairs.select(*cols).filter(F.col("pred_id").isNotNull() & F.col("gt_id").isNotNull())
    pairs = pairs.withColumn("_p", F.count(F.lit(1)).over(by_pred)).withColumn("_g", F.count(F.lit(1)).over(by_gt))
    alone = (F.col("_p") == 1) & (F.col("_g") == 1)
    pairs = cut_lineage(pairs.select(*cols, alone.alias("_alone")))
    sure = pairs.filter("_alone").select("image_id", "pred_id", "gt_id", "iou", at).filter("iou >= iou_thr")
    e = cut_lineage(pairs.filter("NOT _alone").select(*cols, at).filter("iou >= iou_thr").select(*g, "pred_id", "gt_id", "score", "iou"))
    parts = [sure.select(*g, "pred_id", "gt_id", "iou")]
    while not e.isEmpty():
        best_gt = e.groupBy(*p_key).agg(F.max_by(F.struct("gt_id", "iou"), F.struct(F.col("iou"), -F.col("gt_id"))).alias("b"))
        best_pred = e.groupBy(*g_key).agg(F.max_by("pred_id", F.struct(F.col("score"), -F.col("pred_id"))).alias("pred_id"))
        new = best_gt.select(*p_key, "b.*").join(best_pred, [*g, "pred_id", "gt_id"], "left_semi")
        new = cut_lineage(new.select(*g, "pred_id", "gt_id", "iou"))
        parts.append(new)
        e = cut_lineage(e.join(new.select(*p_key), p_key, "left_anti").join(new.select(*g_key), g_key, "left_anti"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out if thresholds is not None else out.drop("iou_thr")


def _ap_core(pred: DataFrame, matches: DataFrame, gt_counts: DataFrame, thresholds) -> DataFrame:
    """AP per image for every threshold, as columns ap0, ap1, ...

    Predictions are ranked once per image in score order (ties: smaller id) with one true-positive
    flag per threshold (W7). The recall step at a true positive is 1 / n_gt, so AP is the sum of the
    precision envelope over true positives, over n_gt. Running counts (W4) and the envelope from
    the right (W5) go by ranges of the order: no image is gathered into one task."""
    from tessera.operators.ranks import prefix_sums, range_buckets, suffix_max
    n = range(len(thresholds))
    flags = matches.groupBy("image_id", "pred_id").agg(
        *[F.max((F.col("iou_thr") == F.lit(float(t))).cast("long")).alias(f"tp{i}") for i, t in enumerate(thresholds)])
    t = pred.select("image_id", "pred_id", "score").join(flags, ["image_id", "pred_id"], "left") \
            .fillna(0, subset=[f"tp{i}" for i in n])
    t = t.select("image_id", F.struct((-F.col("score")).alias("s"), F.col("pred_id").alias("p")).alias("_ord"),
                 F.lit(1).alias("_one"), *[f"tp{i}" for i in n])
    t = range_buckets(t, "_ord")
    t = prefix_sums(t, "_ord", ["_one", *[f"tp{i}" for i in n]], partition_cols=["image_id"])
    t = t.withColumns({f"prec{i}": (F.col(f"tp{i}_before") + F.col(f"tp{i}")) / (F.col("_one_before") + 1) for i in n})
    t = suffix_max(t, "_ord", {f"prec{i}": f"env{i}" for i in n}, partition_cols=["image_id"])
    t = t.groupBy("image_id").agg(*[F.sum(F.col(f"tp{i}") * F.col(f"env{i}")).alias(f"_s{i}") for i in n])
    return t.join(gt_counts, "image_id").select("image_id", *[(F.col(f"_s{i}") / F.col("n_gt")).alias(f"ap{i}") for i in n])


def _images_ap(pred: DataFrame, gt: DataFrame, matches: DataFrame, thresholds) -> DataFrame:
    """Every image with ap0, ap1, ...: null without gt, 0 without predictions."""
    n_gt = gt.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_gt"))
    ap = _ap_core(pred, matches, n_gt, thresholds)
    images = pred.select("image_id").union(gt.select("image_id")).distinct()
    out = images.join(n_gt, "image_id", "left").join(ap, "image_id", "left")
    return out.select("image_id", *[F.when(F.col("n_gt").isNotNull(), F.coalesce(F.col(f"ap{i}"), F.lit(0.0))).alias(f"ap{i}")
                                    for i in range(len(thresholds))])


def average_precision(pred: DataFrame, gt: DataFrame, matches: DataFrame) -> DataFrame:
    """AP per image at one threshold (D11, W4-W7): sum of recall steps x precision envelope.
    No predictions -> 0; no gt -> null."""
    return _images_ap(pred, gt, matches.withColumn("iou_thr", F.lit(0.0)), [0.0]).withColumnRenamed("ap0", "ap")


def ap_range(pred: DataFrame, gt: DataFrame, thresholds=None, cell: int = 32, pairs: DataFrame | None = None) -> DataFrame:
    """AP per (image, IoU threshold) (D11, D12). Default thresholds 0.50, 0.55, ..., 0.95."""
    ths = [float(t) for t in (thresholds or [round(0.5 + 0.05 * i, 2) for i in range(10)])]
    wide = _images_ap(pred, gt, match_detections(pred, gt, cell=cell, thresholds=ths, pairs=pairs), ths)
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("iou_thr"), F.col(f"ap{i}").alias("ap")) for i, t in enumerate(ths)]))
    return wide.select("image_id", rows.alias("r")).select("image_id", "r.*")


def recall_at_iou(pred: DataFrame, gt: DataFrame, thr: float, cell: int = 32) -> DataFrame:
    """Per image: share of gt boxes that are the best partner (argmax IoU, smaller id on ties)
    of some prediction with IoU >= thr (D13). Images without overlaps -> 0."""
    pairs = iou_join(pred.select("image_id", "pred_id", "y1", "x1", "y2", "x2"),
                     gt.select("image_id", "gt_id", "y1", "x1", "y2", "x2"), "pred_id", "gt_id",
                     cell=cell, a_prefix="p_", b_prefix="g_")
    best = pairs.groupBy("image_id", "p_pred_id").agg(
        F.max_by("g_gt_id", F.struct(F.col("iou"), -F.col("g_gt_id"))).alias("gt_id"), F.max("iou").alias("iou"))
    hit = best.filter(F.col("iou") >= thr).groupBy("image_id").agg(F.countDistinct("gt_id").alias("n_hit"))
    n_gt = gt.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_gt"))
    out = n_gt.join(hit, "image_id", "left").fillna(0, subset=["n_hit"])
    return out.select("image_id", "n_hit", "n_gt", (F.col("n_hit") / F.col("n_gt")).alias("recall"))


def coco_results(pred: DataFrame, registry: DataFrame, rle: DataFrame | None = None) -> DataFrame:
    """Result rows (D14): image, source class id, [x, y, w, h] (corners to one decimal), the
    score as it is, mask RLE."""
    from tessera.functions.boxes import to_xywh
    from tessera.operators.joins import class_map_join
    p = class_map_join(pred, registry, direction="to_source")
    out = p.select("image_id", "pred_id", "source_class_id", *to_xywh(tuple(F.col(c) for c in ("y1", "x1", "y2", "x2"))),
                   "score")
    if rle is not None:
        out = out.join(rle.withColumnRenamed("instance_id", "pred_id"), ["image_id", "pred_id"], "left")
    return out
