"""Box-table operators.

Boxes are rows ``(image_id, <id>, y1, x1, y2, x2, ...)``. Box pairs are only
formed for boxes that overlap: both sides are cut onto a pixel grid inside the
image, joined on (image, cell), and each overlapping pair is kept only in the
cell that holds the top-left corner of its intersection, so it appears once
without a distinct. A crowded image therefore costs its overlapping pairs,
never all of its pairs.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.boxes import apply_box_deltas, box_refinement, clip, iou
from tessera.operators.window import cap_per_group, hash_int

__all__ = ["iou_join", "argmax_match", "generate_anchors", "generate_pyramid_anchors", "boxes_from_runs",
           "label_anchors", "sample_training_rois", "apply_deltas_clip", "detections_to_image",
           "random_rois", "confusion_pairs", "build_class_registry", "RPN_STD", "BBOX_STD"]

# Fixed values of the detection configuration (delta standard deviations).
RPN_STD = (0.1, 0.1, 0.2, 0.2)
BBOX_STD = (0.1, 0.1, 0.2, 0.2)


def _cells(df: DataFrame, cell: int, keep) -> DataFrame:
    ys = F.sequence(F.floor(F.col("y1") / cell).cast("int"),
                    F.floor((F.col("y2") - F.lit(1e-9)) / cell).cast("int"))
    xs = F.sequence(F.floor(F.col("x1") / cell).cast("int"),
                    F.floor((F.col("x2") - F.lit(1e-9)) / cell).cast("int"))
    return (df.select(*keep, F.explode(ys).alias("_cy"))
              .select("*", F.explode(xs).alias("_cx")))


def iou_join(a: DataFrame, b: DataFrame, a_id: str, b_id: str, image: str = "image_id",
             cell: int = 32, a_cols=(), b_cols=(), a_prefix: str = "a_", b_prefix: str = "b_",
             b_on=None) -> DataFrame:
    """Every overlapping pair of boxes of the same image with its IoU.

    Output: image, a_id, b_id, a_*/b_* extra columns, iou (> 0). Non-overlapping
    pairs have IoU 0 and are not emitted. ``a`` and ``b`` may be the same frame.
    ``b_on``: ``b`` has no image column and applies to every image that agrees with it in these
    columns (anchors of an image shape)."""
    img = [image] if isinstance(image, str) else list(image)
    shared = list(b_on) if b_on is not None else []
    ka = [*img, *shared, a_id, "y1", "x1", "y2", "x2", *a_cols]
    kb = [*(img if b_on is None else shared), b_id, "y1", "x1", "y2", "x2", *b_cols]
    ca = _cells(a, cell, ka).withColumnsRenamed({c: f"{a_prefix}{c}" for c in ka if c not in img and c not in shared})
    cb = _cells(b, cell, kb).withColumnsRenamed({c: f"{b_prefix}{c}" for c in kb if c not in img and c not in shared})
    j = ca.join(cb, [*(img if b_on is None else shared), "_cy", "_cx"], "inner")
    A = tuple(F.col(f"{a_prefix}{n}") for n in ("y1", "x1", "y2", "x2"))
    B = tuple(F.col(f"{b_prefix}{n}") for n in ("y1", "x1", "y2", "x2"))
    iy = F.greatest(A[0], B[0])
    ix = F.greatest(A[1], B[1])
    overlap = (F.least(A[2], B[2]) > iy) & (F.least(A[3], B[3]) > ix)
    home = (F.floor(iy / cell) == F.col("_cy")) & (F.floor(ix / cell) == F.col("_cx"))
    j = j.filter(overlap & home).drop("_cy", "_cx")
    return j.withColumn("iou", iou(A, B))


def argmax_match(pairs: DataFrame, left: str, right: str, score: str = "iou", group=("image_id",)) -> DataFrame:
    """Flags the best partner of each left row and the best left row of each right partner.
    Ties: smaller id wins (first index, as argmax)."""
    g = list(group)
    wl = Window.partitionBy(*g, left).orderBy(F.desc(score), right)
    wr = Window.partitionBy(*g, right).orderBy(F.desc(score), left)
    return pairs.withColumns({"best_for_left": (F.row_number().over(wl) == 1).cast("int"),
                              "best_for_right": (F.row_number().over(wr) == 1).cast("int")})


def generate_anchors(spark, scales, ratios, shape, feature_stride: int, anchor_stride: int = 1,
                     level: int = 0) -> DataFrame:
    """Grid of anchors (D1): heights s/sqrt(r), widths s*sqrt(r), centres on the stride grid.
    Row order of the reference: y, then x, then (ratio, scale) combinations."""
    combos = [(s, r) for r in ratios for s in scales]
    sizes = F.array(*[F.struct(F.lit(s / math.sqrt(r)).alias("h"), F.lit(s * math.sqrt(r)).alias("w"))
                      for s, r in combos])
    ny = len(range(0, shape[0], anchor_stride))
    nx = len(range(0, shape[1], anchor_stride))
    g = spark.range(ny * nx).select(
        (F.floor(F.col("id") / nx) * anchor_stride * feature_stride).cast("double").alias("cy"),
        (F.pmod(F.col("id"), F.lit(nx)) * anchor_stride * feature_stride).cast("double").alias("cx"),
        F.col("id").alias("_cell"))
    a = g.select("*", F.posexplode(sizes).alias("_k", "_hw"))
    return a.select(
        F.lit(level).alias("level"),
        (F.col("_cell") * len(combos) + F.col("_k")).alias("local_id"),
        (F.col("cy") - 0.5 * F.col("_hw.h")).alias("y1"), (F.col("cx") - 0.5 * F.col("_hw.w")).alias("x1"),
        (F.col("cy") + 0.5 * F.col("_hw.h")).alias("y2"), (F.col("cx") + 0.5 * F.col("_hw.w")).alias("x2"))


def generate_pyramid_anchors(spark, scales, ratios, image_shape, strides, anchor_stride: int = 1) -> DataFrame:
    """D1 per pyramid level, level shape ceil(size / stride) (D2). anchor_id is global in
    level order, as the reference concatenates them."""
    out, offset = None, 0
    for lvl, (s, st) in enumerate(zip(scales, strides)):
        shape = (math.ceil(image_shape[0] / st), math.ceil(image_shape[1] / st))
        a = generate_anchors(spark, [s], ratios, shape, st, anchor_stride, level=lvl)
        n = len(range(0, shape[0], anchor_stride)) * len(range(0, shape[1], anchor_stride)) * len(ratios)
        a = a.withColumn("anchor_id", F.col("local_id") + offset).drop("local_id")
        offset += n
        out = a if out is None else out.unionByName(a)
    return out


def boxes_from_runs(runs: DataFrame, height: int, keys=("image_id", "instance_id")) -> DataFrame:
    """Bounding box of each mask from its column-major 1-based runs (D3): min/max of set
    pixels, upper corner + 1; an instance whose runs are all empty gets zeros."""
    k = list(keys)
    seg = _split_runs_by_column(runs, height, k)
    b = seg.groupBy(*k).agg(
        F.min("y_start").alias("y1"), F.min("x").alias("x1"),
        (F.max("y_end") + 1).alias("y2"), (F.max("x") + 1).alias("x2"))
    allk = runs.select(*k).distinct()
    return allk.join(b, k, "left").fillna(0, subset=["y1", "x1", "y2", "x2"])


def split_runs(runs: str, height: int) -> Column:
    """The array of (start, length) cut at column boundaries: an array of (x, y_start, y_end), inclusive."""
    def columns(r):
        s, e = r["start"] - 1, r["start"] + r["length"] - 2
        lo, hi = F.floor(s / height).cast("long"), F.floor(e / height).cast("long")
        return F.transform(F.sequence(lo, hi), lambda x: F.struct(
            x.alias("x"), (F.greatest(s, x * height) - x * height).alias("y_start"),
            (F.least(e, x * height + height - 1) - x * height).alias("y_end")))
    return F.flatten(F.transform(F.filter(runs, lambda r: r["length"] > 0), columns))


def _split_runs_by_column(runs: DataFrame, height: int, keys) -> DataFrame:
    """Column-major runs cut at column boundaries: (keys, x, y_start, y_end) inclusive."""
    if "runs" not in runs.columns:
        runs = runs.select(*keys, F.array(F.struct("start", "length")).alias("runs"))
    return runs.select(*keys, F.inline(split_runs("runs", height)))


def label_anchors(anchors: DataFrame, gt: DataFrame, images: DataFrame, per_image: int = 256,
                  pos_thr: float = 0.7, neg_thr: float = 0.3, seed: int = 0, cell: int = 32, shape=()) -> DataFrame:
    """RPN anchor targets (D5): (image_id, anchor_id, match 1/-1, dy, dx, dh, dw).

    ``anchors`` holds one set per image shape (columns ``shape``, also in ``images``; ids 0, 1,
    ... inside a set). IoU < neg_thr is negative unless a crowd box (class_id < 0) overlaps with
    IoU >= 0.001; the best anchor of each gt and every anchor with IoU >= pos_thr are positive;
    positives capped at per_image / 2, negatives drawn uniformly from all other anchors of the
    image up to per_image - positives, both repeatable per image. Deltas go to the best gt,
    divided by the RPN std devs."""
    shape = list(shape)
    size = images.select("image_id", *shape)
    boxes = gt.select("image_id", "gt_id", "class_id", "y1", "x1", "y2", "x2")
    if shape:
        boxes = boxes.join(size, "image_id")
    pairs = iou_join(boxes, anchors.select("anchor_id", "y1", "x1", "y2", "x2", *shape),
                     "gt_id", "anchor_id", cell=cell, a_cols=("class_id",), a_prefix="g_", b_prefix="a_", b_on=shape)
    pairs = pairs.withColumnRenamed("a_anchor_id", "anchor_id").withColumnRenamed("g_gt_id", "gt_id")
    real = F.col("g_class_id") > 0
    # per anchor its best gt (highest IoU, then smaller gt id), per gt its best anchor (then smaller anchor id)
    per_anchor = pairs.groupBy("image_id", "anchor_id").agg(
        F.max(F.when(real, F.col("iou"))).alias("max_iou"),
        F.max_by(F.when(real, F.struct(*[F.col(f"g_{c}").alias(c) for c in ("y1", "x1", "y2", "x2")])),
                 F.when(real, F.struct(F.col("iou"), -F.col("gt_id")))).alias("g"),
        F.first(F.struct(*[F.col(f"a_{c}").alias(c) for c in ("y1", "x1", "y2", "x2")])).alias("a"),
        F.max((~real & (F.col("iou") >= 0.001)).cast("int")).alias("_crowd"))
    best_of_gt = pairs.filter(real).groupBy("image_id", "gt_id").agg(
        F.max_by("anchor_id", F.struct(F.col("iou"), -F.col("anchor_id"))).alias("anchor_id")) \
        .select("image_id", "anchor_id").distinct().withColumn("_best", F.lit(1))
    lab = per_anchor.join(best_of_gt, ["image_id", "anchor_id"], "left").fillna({"max_iou": 0.0, "_best": 0})
    match = (F.when((F.col("_best") == 1) | (F.col("max_iou") >= pos_thr), 1)
             .when((F.col("max_iou") < neg_thr) & (F.col("_crowd") == 0), -1).otherwise(0))
    # the labels of touched anchors feed three branches below: written once to the checkpoint folder
    from tessera.session import cut_lineage
    lab = cut_lineage(lab.withColumn("match", match))
    pos = cap_per_group(lab.filter(F.col("match") == 1), ["image_id"], per_image // 2, seed, ["anchor_id"])
    n_pos = pos.groupBy("image_id").agg(F.count(F.lit(1)).alias("_np"))
    barred = lab.filter(F.col("match") != -1).select("image_id", "anchor_id")
    neg = _draw_anchors(size, anchors, barred, n_pos, per_image, seed, shape)
    d = box_refinement(tuple(F.col(f"a.{c}") for c in ("y1", "x1", "y2", "x2")),
                       tuple(F.col(f"g.{c}") for c in ("y1", "x1", "y2", "x2")), std=RPN_STD)
    pos_out = pos.select("image_id", "anchor_id", F.lit(1).alias("match"), *d)
    neg_out = neg.select("image_id", "anchor_id", F.lit(-1).alias("match"),
                         *[F.lit(None).cast("double").alias(f"d{n}") for n in ("y", "x", "h", "w")])
    return pos_out.unionByName(neg_out)


def next_prime(n: int) -> int:
    n = max(2, n)
    while any(n % k == 0 for k in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def _draw_anchors(size: DataFrame, anchors: DataFrame, barred: DataFrame, n_pos: DataFrame, per_image: int, seed: int,
                  shape) -> DataFrame:
    """Per image ``per_image`` - positives anchors, uniform over all that are not ``barred``.

    Every image walks its own permutation of the anchor ids: step j goes to (a j + b) mod p with
    p the first prime from the number of anchors on and a, b drawn for the image. As many steps
    are made as the barred ids and the gap up to p can spoil, so the draw never falls short."""
    counts = anchors.groupBy(*shape).agg(F.count(F.lit(1)).alias("_n"))
    # one row per image shape
    rows = [(*[r[c] for c in shape], r["_n"], next_prime(r["_n"])) for r in counts.collect()]
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in counts.schema.fields] + ["_p long"])
    sets = anchors.sparkSession.createDataFrame(rows, ddl)
    spoiled = barred.groupBy("image_id").agg(F.count(F.lit(1)).alias("_k"))
    per = (size.join(sets, shape) if shape else size.crossJoin(sets)).join(spoiled, "image_id", "left") \
        .join(n_pos, "image_id", "left").fillna(0, subset=["_k", "_np"])
    per = per.withColumns({"_a": 1 + F.pmod(hash_int(seed + 1, "image_id"), F.col("_p") - 1),
                           "_b": F.pmod(hash_int(seed + 2, "image_id"), F.col("_p")),
                           "_want": F.lit(per_image) - F.col("_np")})
    last = F.least(F.col("_p"), F.col("_want") + F.col("_k") + F.col("_p") - F.col("_n")) - 1
    steps = per.filter((F.col("_want") > 0) & (F.col("_n") > 0)).select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_j"))
    steps = steps.withColumn("anchor_id", F.pmod(F.col("_a") * F.col("_j") + F.col("_b"), F.col("_p"))).filter("anchor_id < _n")
    free = steps.join(barred, ["image_id", "anchor_id"], "left_anti")
    w = Window.partitionBy("image_id").orderBy("_j")
    free = free.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= F.lit(per_image)).filter("_rn <= _want")
    return free.select("image_id", "anchor_id")


#: Pairs of rois and boxes worked on at once, and images.
ROI_PAIRS, ROI_ROWS = 1 << 18, 2048


def sample_training_rois(rois: DataFrame, gt: DataFrame, per_image: int = 200, pos_frac: float = 0.33,
                         pos_thr: float = 0.5, seed: int = 0, cell: int = 32) -> DataFrame:
    """Detection-head targets (D6): positives IoU >= pos_thr with a non-crowd gt, negatives
    below it and not overlapping a crowd box (IoU >= 0.001); positives capped at
    pos_frac * per_image, negatives at positives * (1/pos_frac - 1); positives get the
    class and std-scaled deltas of their best gt. Mask crops are not built. ``cell`` is of no
    effect: an image is one row with its rois and boxes, so no grid is needed and no pair of them is ever a row."""
    sides = ("y1", "x1", "y2", "x2")
    per = rois.groupBy("image_id").agg(F.collect_list(F.struct("roi_id", *[F.col(c).cast("double").alias(c) for c in sides])).alias("rois"))
    box = F.struct((-F.col("gt_id")).alias("o"), "class_id", *[F.col(c).cast("double").alias(c) for c in sides])
    boxes = gt.groupBy("image_id").agg(F.sort_array(F.collect_list(box), asc=False).alias("boxes"))  # of equal ones the first counts
    t = per.join(boxes, "image_id", "left").select("image_id", F.col("image_id").cast("string").alias("name"), "rois", "boxes")
    if not isinstance(rois.schema["roi_id"].dataType, T.IntegralType):  # the text of a whole number needs no Spark
        t = t.withColumn("names", F.transform("rois", lambda r: r["roi_id"].cast("string")))
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((rois, "image_id"), (rois, "roi_id"), (gt, "class_id"))]
    run = functools.partial(_image_rois, int(per_image * pos_frac), 1.0 / pos_frac - 1.0, pos_thr, seed)
    out = t.mapInArrow(run, f"image_id {kinds[0]}, roi_id {kinds[1]}, class_id {kinds[2]}, neg boolean, d array<double>")
    delta = box_refinement(*(tuple(F.get("d", F.lit(k + j)) for j in range(4)) for k in (0, 4)), std=BBOX_STD)
    names = [f"d{x}" for x in ("y", "x", "h", "w")]
    return out.select("image_id", "roi_id", F.when(F.col("neg"), F.lit(0)).otherwise(F.col("class_id")).alias("class_id"),
                      *[F.when(F.col("neg"), F.lit(0.0)).otherwise(x).alias(n) for x, n in zip(delta, names)])


def _image_rois(cap: int, per_positive: float, pos_thr: float, seed: int, batches):
    """Rows of images with their rois and boxes to the sampled rois: (image_id, roi_id, class_id, neg, sides of the roi
    and of its box, null for negatives)."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROI_ROWS):
            yield _sampled_rois(cap, per_positive, pos_thr, seed, batch.slice(at, ROI_ROWS))


def _sampled_rois(cap: int, per_positive: float, pos_thr: float, seed: int, part: pa.RecordBatch) -> pa.RecordBatch:
    n_rois, n_boxes = (pc.fill_null(pc.list_value_length(part.column(c)), 0).to_numpy() for c in ("rois", "boxes"))
    ids, *roi = part.column("rois").flatten().flatten()
    _, classes, *box = part.column("boxes").flatten().flatten()
    roi, box = (np.stack([s.to_numpy(zero_copy_only=False) for s in x], axis=1) for x in (roi, box))
    kind = classes.to_numpy(zero_copy_only=False)
    image, begin = np.repeat(np.arange(part.num_rows), n_rois), np.cumsum(n_boxes) - n_boxes
    pairs = np.concatenate([[0], np.cumsum(n_boxes[image])])
    top, best, crowd, at = np.full(len(roi), -1.0), np.zeros(len(roi), int), np.zeros(len(roi), bool), 0
    while at < len(roi):  # a bounded number of pairs at once
        end = max(at + 1, int(np.searchsorted(pairs, pairs[at] + ROI_PAIRS, side="right")) - 1)
        m = n_boxes[image[at:end]]
        r = np.repeat(np.arange(at, end), m)
        b = np.arange(len(r)) + np.repeat(begin[image[at:end]] - (pairs[at:end] - pairs[at]), m)
        inter = _common(roi[r], box[b])
        some = np.flatnonzero(inter > 0)
        r, b, inter = r[some], b[some], inter[some]
        iou_ = inter / (_area(roi[r]) + _area(box[b]) - inter)
        crowd[r[(kind[b] < 0) & (iou_ >= 0.001)]] = True
        real = kind[b] > 0
        r, b, iou_ = r[real], b[real], iou_[real]
        np.maximum.at(top, r, iou_)
        first = np.flatnonzero(iou_ == top[r])[::-1]  # the first of equal ones is set last
        best[r[first]] = b[first]
        at = end
    most = np.maximum(top, 0.0)
    name = part.column("name")
    names = part.column("names").flatten() if "names" in part.schema.names else None

    def drawn(some: np.ndarray, least: np.ndarray, by: int) -> np.ndarray:
        """Of these rois the first ``least`` of their image, in the order of ``cap_per_group``."""
        count = np.bincount(image[some], minlength=part.num_rows)
        keep = [some[(count <= least)[image[some]]]]
        over = some[((count > least) & (least > 0))[image[some]]]
        images, first = np.unique(image[over], return_index=True)
        head = ["|".join([str(by), *filter(None.__ne__, [x])]) for x in name.take(pa.array(images)).to_pylist()]
        own = ids.take(pa.array(over)).to_pylist()
        text = [*map(str, own)] if names is None else names.take(pa.array(over)).to_pylist()
        for i, begin, end in zip(range(len(images)), first, [*first[1:], len(over)]):
            order = sorted(range(begin, end), key=lambda j: (hashlib.md5(  # noqa: B023
                (f"{head[i]}|{text[j]}" if own[j] is not None else head[i]).encode()).hexdigest(), own[j] is not None, own[j]))  # noqa: B023
            keep.append(over[order[:least[images[i]]]])
        return np.concatenate(keep).astype(int)

    pos = drawn(np.flatnonzero(most >= pos_thr), np.full(part.num_rows, cap), seed)
    found = np.bincount(image[pos], minlength=part.num_rows)
    neg = drawn(np.flatnonzero((most < pos_thr) & ~crowd), np.floor(found * per_positive).astype(int), seed + 1)
    has = top[pos] >= 0
    d = np.concatenate([roi[pos[has]], box[best[pos[has]]]], axis=1)
    size = np.where(has, 8, 0)
    offsets = pa.array(np.concatenate([[0], np.cumsum(size), np.full(len(neg), size.sum())]).astype(np.int32),
                       mask=np.concatenate([~has, np.ones(len(neg), bool), [False]]))
    both = pa.array(np.concatenate([pos, neg]))
    label = pa.array(np.concatenate([best[pos], np.zeros(len(neg), int)]), mask=np.concatenate([~has, np.ones(len(neg), bool)]))
    return pa.RecordBatch.from_arrays(
        [part.column("image_id").take(pa.array(image[np.concatenate([pos, neg])])), ids.take(both), classes.take(label),
         pa.array(np.repeat([False, True], [len(pos), len(neg)])), pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))],
        names=["image_id", "roi_id", "class_id", "neg", "d"])


def _area(box: np.ndarray) -> np.ndarray:
    return (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Areas that boxes share, row by row."""
    return np.maximum(np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0]), 0) \
        * np.maximum(np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]), 0)


def apply_deltas_clip(df: DataFrame, deltas, window, std=None) -> DataFrame:
    """Boxes moved by deltas then clipped into the window (part of D7, D8)."""
    moved = apply_box_deltas(tuple(F.col(c) for c in ("y1", "x1", "y2", "x2")), deltas, std=std, prefix="_n")
    wy1, wx1, wy2, wx2 = window
    out = df.select("*", *moved)
    return out.withColumns({
        "y1": clip(F.col("_ny1"), wy1, wy2), "x1": clip(F.col("_nx1"), wx1, wx2),
        "y2": clip(F.col("_ny2"), wy1, wy2), "x2": clip(F.col("_nx2"), wx1, wx2)}).drop("_ny1", "_nx1", "_ny2", "_nx2")


def detections_to_image(df: DataFrame, image_h: int, image_w: int, window, orig_h, orig_w) -> DataFrame:
    """Normalised detections inside a padded window -> original pixel boxes, zero-area
    boxes dropped (D9). Padding rows (class 0) are dropped first."""
    from tessera.functions.boxes import window_to_image
    from tessera.operators.clean import degenerate_box_filter
    d = df.filter(F.col("class_id") > 0)
    win = tuple(F.lit(float(v)) for v in window)
    boxes = window_to_image(tuple(F.col(c) for c in ("y1", "x1", "y2", "x2")), win, image_h, image_w,
                            orig_h, orig_w, prefix="_p")
    d = d.select("*", *boxes).drop("y1", "x1", "y2", "x2")
    d = d.withColumnsRenamed({"_py1": "y1", "_px1": "x1", "_py2": "y2", "_px2": "x2"})
    return degenerate_box_filter(d)


def _u(seed: int, *cols) -> Column:
    return hash_int(seed, *cols).cast("double") / float(1 << 28)


#: Rois of one task, which an image's own are collected from later.
TASK_ROIS = 1 << 21


def random_rois(gt: DataFrame, images: DataFrame, n: int, seed: int = 0, near_frac: float = 0.9) -> DataFrame:
    """n random boxes per image (D16): near_frac of them drawn around the gt boxes (corners
    within one box size of the gt), the rest anywhere in the image; sides at least 1 px.
    Uniforms come from the md5 of (seed, image, index), so the draw is repeatable."""
    n_near = int(n * near_frac)
    # a roi is drawn around the gt of rank k % (number of gt), so the first n_near of an image are enough
    first = gt.select("image_id", "gt_id", F.struct("y1", "x1", "y2", "x2").alias("_box"))
    first = first.withColumn("_rn", F.row_number().over(Window.partitionBy("image_id").orderBy("gt_id"))).filter(F.col("_rn") <= n_near)
    near = first.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("_rn", "_box"))).alias("_near_gt")) if n_near else \
        gt.select("image_id", F.array(F.struct(F.lit(1).alias("_rn"), F.struct("y1", "x1", "y2", "x2").alias("_box"))).alias("_near_gt")).limit(0)
    k = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k")
    # dealt before they are made, into more tasks than usual where there are too many rois for those
    tasks = -(-images.count() * n // TASK_ROIS)
    if tasks > int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        images = images.repartition(tasks, "image_id")
    b = images.join(near, "image_id", "left").select("image_id", "height", "width", "_near_gt", k)
    b = b.withColumn("_g", F.coalesce(F.size("_near_gt"), F.lit(0)))
    b = b.withColumn("_near", (F.col("k") < n_near) & (F.col("_g") > 0))
    b = b.withColumn("_at", F.when(F.col("_near"), F.get("_near_gt", F.pmod(F.col("k"), F.col("_g")))["_box"]))
    b = b.select("image_id", "height", "width", "k", "_near", "_at.*")
    u = [_u(seed + i, F.col("image_id"), F.col("k")) for i in range(4)]
    h = F.col("y2") - F.col("y1")
    w = F.col("x2") - F.col("x1")
    ny = [F.col("y1") - h + u[0] * 2 * h, F.col("y2") - h + u[1] * 2 * h]
    nx = [F.col("x1") - w + u[2] * 2 * w, F.col("x2") - w + u[3] * 2 * w]
    fy = [u[0] * F.col("height"), u[1] * F.col("height")]
    fx = [u[2] * F.col("width"), u[3] * F.col("width")]
    ya = F.when(F.col("_near"), ny[0]).otherwise(fy[0])
    yb = F.when(F.col("_near"), ny[1]).otherwise(fy[1])
    xa = F.when(F.col("_near"), nx[0]).otherwise(fx[0])
    xb = F.when(F.col("_near"), nx[1]).otherwise(fx[1])
    hh = F.col("height").cast("double")
    ww = F.col("width").cast("double")
    y1 = clip(F.floor(F.least(ya, yb)), F.lit(0.0), hh - 1)
    x1 = clip(F.floor(F.least(xa, xb)), F.lit(0.0), ww - 1)
    y2 = F.greatest(clip(F.floor(F.greatest(ya, yb)), F.lit(0.0), hh), y1 + 1)
    x2 = F.greatest(clip(F.floor(F.greatest(xa, xb)), F.lit(0.0), ww), x1 + 1)
    return b.select("image_id", F.col("k").alias("roi_id"), F.col("_near").cast("int").alias("near_gt"),
                    y1.cast("int").alias("y1"), x1.cast("int").alias("x1"),
                    y2.cast("int").alias("y2"), x2.cast("int").alias("x2"))


def confusion_pairs(gt: DataFrame, pred: DataFrame, thr: float = 0.5, cell: int = 32) -> DataFrame:
    """Each gt x prediction overlap above thr, marked match / wrong by class."""
    p = iou_join(gt.select("image_id", "gt_id", "class_id", "y1", "x1", "y2", "x2"),
                 pred.select("image_id", "pred_id", "class_id", "score", "y1", "x1", "y2", "x2"),
                 "gt_id", "pred_id", cell=cell, a_cols=("class_id",), b_cols=("class_id", "score"),
                 a_prefix="g_", b_prefix="p_")
    p = p.filter(F.col("iou") > thr)
    return p.select("image_id", F.col("g_gt_id").alias("gt_id"), F.col("p_pred_id").alias("pred_id"),
                    F.col("g_class_id").alias("gt_class"), F.col("p_class_id").alias("pred_class"),
                    F.col("p_score").alias("score"), "iou",
                    F.when(F.col("g_class_id") == F.col("p_class_id"), "match").otherwise("wrong").alias("kind"))


def build_class_registry(classes: DataFrame) -> DataFrame:
    """Dense class ids (D18): background = 0, then (source, source_class_id) in sorted order;
    duplicate (source, id) pairs keep their first name (smallest). Small dimension table.
    ``active_class_ids`` lists the class ids of the row's source, background first: the classes
    that an image of that source may hold."""
    from tessera.operators.ranks import row_number_by_key
    d = classes.groupBy("source", F.col("source_class_id").cast("long").alias("source_class_id")).agg(F.min("name").alias("name"))
    ranked = row_number_by_key(d, [], ["source", "source_class_id"], "_rn").select(
        "source", "source_class_id", "name", (F.col("_rn") + 1).cast("int").alias("class_id"))
    active = ranked.groupBy("source").agg(
        F.concat(F.array(F.lit(0)), F.array_sort(F.collect_list("class_id"))).alias("active_class_ids"))
    bg = classes.sparkSession.createDataFrame([("", 0, "BG", 0, [0])], "source string, source_class_id long, name string, "
                                              "class_id int, active_class_ids array<int>")
    return bg.unionByName(ranked.join(active, "source").select(*bg.columns))
