"""Anchors of a regular grid by arithmetic.

The anchors of an image are a function of its shape: level, row, column and side ratio give the box and the
id. So no anchor table is needed: a box solves for the index ranges of the anchors it can match, per level
and ratio, and only those are written out. A pair's IoU is at most the IoU of its two sides along either
axis, which turns a least IoU into a largest distance between the centres. No key is shared between images
beyond the image's own, and the work grows with the pairs that count, not with the anchors. An image is labelled where
its boxes are, in one row; only images of very many boxes write and move their pairs.
"""

from __future__ import annotations

import functools
import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.boxes import box_refinement
from tessera.operators.boxes import RPN_STD, _area, _common, iou_join, next_prime
from tessera.operators.window import hash_int, hash_order
from tessera.session import cut_lineage

__all__ = ["AnchorGrid", "grid_anchors", "label_grid_anchors"]

SIDES = ("y1", "x1", "y2", "x2")
#: Relative slack for the rounding of bounds; what passes by it is compared exactly afterwards.
SLACK = 1e-9


@dataclass(frozen=True)
class AnchorGrid:
    """One square size per pyramid level in several height-to-width ratios, centres every
    ``anchor_stride`` cells of the level's feature map (size / stride, rounded up)."""

    scales: tuple
    ratios: tuple
    strides: tuple
    anchor_stride: int = 1

    def shapes(self) -> list[tuple[int, int, float, float]]:
        """(level, place of the ratio, height, width) of every kind of anchor."""
        return [(lvl, k, s / math.sqrt(r), s * math.sqrt(r))
                for lvl, s in enumerate(self.scales) for k, r in enumerate(self.ratios)]

    def step(self, level: int) -> int:
        return self.anchor_stride * self.strides[level]

    def _count(self, side: Column, stride) -> Column:
        """Centres along one side of the image."""
        return F.ceil(F.ceil(side / stride) / F.lit(self.anchor_stride)).cast("long")

    def firsts(self, height: Column, width: Column) -> list[Column]:
        """Id of the first anchor of every level, and the number of anchors last."""
        out = [F.lit(0).cast("long")]
        for stride in self.strides:
            n = self._count(height, F.lit(stride)) * self._count(width, F.lit(stride)) * len(self.ratios)
            out.append(out[-1] + n)
        return out

    def total(self, height: Column, width: Column) -> Column:
        """Number of anchors of an image."""
        return self.firsts(height, width)[-1]

    def with_kinds(self, df: DataFrame) -> DataFrame:
        """One row per row of ``df`` (with height and width) and level and ratio, described by the struct ``a``."""
        kinds = F.array(*[F.struct(F.lit(lvl).alias("level"), F.lit(self.strides[lvl]).alias("stride"), F.lit(k).alias("k"),
                                   F.lit(h).alias("h"), F.lit(w).alias("w")) for lvl, k, h, w in self.shapes()])
        t = df.withColumn("_first", F.array(*self.firsts(F.col("height"), F.col("width"))[:-1])).select("*", F.explode(kinds).alias("_k"))
        c = lambda name: F.col(f"_k.{name}")
        a = F.struct(c("level").alias("level"), c("k").alias("k"), c("h").alias("h"), c("w").alias("w"),
                     (c("stride") * self.anchor_stride).alias("step"), self._count(F.col("height"), c("stride")).alias("ny"),
                     self._count(F.col("width"), c("stride")).alias("nx"), F.col("_first")[c("level")].alias("first"))
        return t.withColumn("a", a).drop("_first", "_k")

    def at(self, kind: str, i: Column, j: Column) -> list[Column]:
        """Id and box of the anchor of a kind in row ``i`` and column ``j``."""
        c = lambda name: F.col(f"{kind}.{name}")
        cy, cx = (i * c("step")).cast("double"), (j * c("step")).cast("double")
        return [(c("first") + (i * c("nx") + j) * len(self.ratios) + c("k")).alias("anchor_id"),
                (cy - 0.5 * c("h")).alias("y1"), (cx - 0.5 * c("w")).alias("x1"),
                (cy + 0.5 * c("h")).alias("y2"), (cx + 0.5 * c("w")).alias("x2")]


def grid_anchors(shapes: DataFrame, grid: AnchorGrid) -> DataFrame:
    """All anchors of every image shape (D1, D2): (height, width, level, anchor_id, box), ids in the order
    level, row, column, ratio. ``shapes`` has one row per shape, any number of them."""
    t = grid.with_kinds(shapes.select("height", "width"))
    t = t.filter((F.col("a.ny") > 0) & (F.col("a.nx") > 0))
    t = t.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("a.ny") - 1)).alias("i"))
    t = t.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("a.nx") - 1)).alias("j"))
    return t.select("height", "width", F.col("a.level").alias("level"), *grid.at("a", F.col("i"), F.col("j")))


#: Boxes worked on at once, and pairs written out at once.
BOXES, PAIRS = 512, 1 << 20
#: Pairs grouped in one task, about 300 bytes of its memory each.
TASK_PAIRS = 1 << 21
#: Pairs a box is reckoned with as long as they are not made.
PAIRS_A_BOX = 16
#: An image of more boxes than this is not one row; images and their boxes worked on at once.
CROWDED = 256
ROWS, ROW_BOXES = 1024, 4096


def _pairs_of(grid: AnchorGrid, box: np.ndarray, shape: np.ndarray, real: np.ndarray, least: np.ndarray):
    """(box, anchor id, anchor box, iou, best) of the anchors with an IoU of at least ``least`` with a box, and
    of each real box's best anchor (of equal ones the smallest id).

    For a box and a kind of anchor, an IoU bounds the common length along each axis from below and so the
    distance of the centres from above: the anchors in question are a range of rows times one of columns.
    The best IoU of a kind is that of the grid position nearest to the box's centre."""
    side = box[:, 2:] - box[:, :2]
    centre = box[:, :2] + 0.5 * side
    kinds, first = [], np.zeros(len(box), np.int64)
    for lvl, stride in enumerate(grid.strides):
        n = np.ceil(np.ceil(shape / stride) / grid.anchor_stride).astype(np.int64)  # rows, columns
        for k, r in enumerate(grid.ratios):
            size = np.array([grid.scales[lvl] / math.sqrt(r), grid.scales[lvl] * math.sqrt(r)])
            step = grid.step(lvl)
            nearest = np.clip(np.round(centre / step), 0, n - 1) * step
            common = np.clip(np.minimum(np.minimum(size, side), (size + side) / 2 - np.abs(nearest - centre)), 0, None)
            inner = common.prod(axis=1)
            top = inner / (size.prod() + side.prod(axis=1) - inner)
            kinds.append((n, first, k, size, step, common, np.where(n.min(axis=1) > 0, top, 0.0)))
        first = first + n.prod(axis=1) * len(grid.ratios)
    best = np.max([kind[-1] for kind in kinds], axis=0)
    found = []
    for n, first, k, size, step, common, top in kinds:
        need = (least / (1 + least) * (1 - SLACK))[:, None] * (size + side)
        reach = np.where((np.minimum(size, side) >= need).all(axis=1)[:, None], (size + side) / 2 - need, -1.0)
        winner = (real & (best > 0) & (top >= best * (1 - SLACK)))[:, None]
        reach = np.where(winner, np.maximum(reach, (size + side) / 2 - common), reach)
        low = np.maximum(np.ceil((centre - reach) / step - 1e-6), 0).astype(np.int64)
        high = np.minimum(np.floor((centre + reach) / step + 1e-6), n - 1).astype(np.int64)
        count = np.where((reach >= 0).all(axis=1), np.clip(high - low + 1, 0, None).prod(axis=1), 0)
        at = 0
        while at < len(box):  # a bounded number of pairs at once
            end = max(at + 1, at + int(np.searchsorted(np.cumsum(count[at:]), PAIRS, side="right")))
            b = np.repeat(np.arange(at, end), count[at:end])
            q = np.arange(len(b)) - np.repeat(np.cumsum(count[at:end]) - count[at:end], count[at:end])
            columns = (high - low + 1)[b, 1]
            i, j = low[b, 0] + q // np.maximum(columns, 1), low[b, 1] + q % np.maximum(columns, 1)
            cy, cx = (i * step).astype(float), (j * step).astype(float)
            anchor = np.stack([cy - 0.5 * size[0], cx - 0.5 * size[1], cy + 0.5 * size[0], cx + 0.5 * size[1]], axis=1)
            g = box[b]
            inter = _common(g, anchor)
            iou = inter / (_area(g) + _area(anchor) - inter)
            some = (inter > 0) & ((iou >= least[b]) | winner[b, 0])
            found.append((b[some], (first[b] + (i * n[b, 1] + j) * len(grid.ratios) + k)[some], anchor[some], iou[some]))
            at = end
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros((0, 4)), np.zeros(0), np.zeros(0, bool)
    b, ids, anchor, iou = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, -iou, b))
    b, ids, anchor, iou = b[order], ids[order], anchor[order], iou[order]
    is_best = np.ones(len(b), bool)
    is_best[1:] = b[1:] != b[:-1]
    is_best &= real[b]
    kept = is_best | (iou >= least[b])
    return b[kept], ids[kept], anchor[kept], iou[kept], is_best[kept]


def anchor_pairs(grid: AnchorGrid, boxes: DataFrame, least_real: float, least_other: float = 0.001) -> DataFrame:
    """Anchors that overlap a box enough, by arithmetic: (image_id, gt_id, class_id, box, anchor_id, a_box, iou,
    best). ``boxes`` has height and width of the image. Boxes of class > 0 pair from IoU ``least_real`` on and
    with their best anchor in any case, others from ``least_other`` on. Boxes without area have no pair."""
    plain = boxes.filter((F.col("y2") > F.col("y1")) & (F.col("x2") > F.col("x1"))).select(
        "image_id", "gt_id", "class_id", *[F.col(c).cast("double").alias(c) for c in (*SIDES, "height", "width")])
    ids = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields[:3])
    names = [*plain.columns[:7], "anchor_id", *[f"a_{s}" for s in SIDES], "iou", "best"]

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BOXES):
                part = batch.slice(a, BOXES)
                n = np.stack([part.column(c).to_numpy() for c in range(3, 9)], axis=1)
                real = part.column(2).to_numpy(zero_copy_only=False) > 0
                b, anchor_id, anchor, iou, best = _pairs_of(grid, n[:, :4], n[:, 4:], real, np.where(real, least_real, least_other))
                rows = pa.array(b)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).take(rows) for c in range(7)], pa.array(anchor_id, pa.int64()),
                     *[pa.array(anchor[:, c]) for c in range(4)], pa.array(iou), pa.array(best)],
                    names)

    sides = ", ".join(f"{c} double" for c in SIDES)
    return plain.mapInArrow(run, f"{ids}, {sides}, anchor_id long, {', '.join(f'a_{c} double' for c in SIDES)}, iou double, best boolean")


def label_grid_anchors(grid: AnchorGrid, gt: DataFrame, images: DataFrame, per_image: int = 256, pos_thr: float = 0.7,
                       neg_thr: float = 0.3, seed: int = 0) -> DataFrame:
    """RPN anchor targets (D5): (image_id, anchor_id, match 1/-1, dy, dx, dh, dw).

    ``images`` has image_id, height and width. The rules are those of ``boxes.label_anchors``: an anchor is
    positive from IoU ``pos_thr`` with a box of class > 0 on, or as the best anchor of one; negative below
    ``neg_thr`` unless a box of another class has IoU >= 0.001 with it; at most per_image / 2 positives, and
    negatives drawn uniformly from the image's other anchors up to per_image.

    Only pairs that can change a label count: those from IoU ``neg_thr`` on, and those of the
    other boxes from 0.001 on. The best anchor of a box comes from the grid position nearest to its centre;
    one below ``neg_thr`` meets the other boxes of its image, which may be nearer to it.

    An image is one row with its boxes, so its pairs are made, labelled and drawn from in one place and none is
    written or moved. Images of more than ``CROWDED`` boxes are labelled pair by pair instead."""
    size = images.select("image_id", "height", "width")
    gt = gt.filter(F.col("image_id").isNotNull())
    few = gt.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = few.groupBy(F.least("n", F.lit(CROWDED + 1)).alias("n")).count().collect()  # at most CROWDED + 1 rows
    boxes = sum(r["n"] * r["count"] for r in sizes)
    rule = functools.partial(_targets_by_pairs, grid, per_image=per_image, pos_thr=pos_thr, neg_thr=neg_thr, seed=seed)
    if any(r["n"] > CROWDED for r in sizes):
        crowded = F.broadcast(cut_lineage(few.filter(F.col("n") > CROWDED).select("image_id")))
        by_pairs = rule(gt.join(crowded, "image_id", "left_semi"), size.join(crowded, "image_id", "left_semi"))
        gt, size = (x.join(crowded, "image_id", "left_anti") for x in (gt, size))
    else:
        nothing = lambda df: df.sparkSession.createDataFrame([], df.schema)
        by_pairs = rule(nothing(gt), nothing(size))
    tasks = -(-boxes * PAIRS_A_BOX // TASK_PAIRS)
    more = tasks > int(gt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    real, area = F.coalesce(F.col("class_id") > 0, F.lit(False)), (F.col("y2") > F.col("y1")) & (F.col("x2") > F.col("x1"))
    one = F.struct((-F.col("gt_id")).alias("o"), *[F.col(c).cast("double").alias(c) for c in SIDES], real.alias("real"))
    rows = gt.filter(area).select("image_id", one.alias("b"))
    rows = (rows.repartition(tasks, "image_id") if more else rows).groupBy("image_id").agg(
        F.sort_array(F.collect_list("b"), asc=False).alias("boxes"))  # of equal boxes the smaller gt_id comes first
    t = size.join(rows, "image_id", "left").select(
        "image_id", grid.total(F.col("height"), F.col("width")).alias("n"), F.col("height").cast("double").alias("height"),
        F.col("width").cast("double").alias("width"), hash_int(seed + 1, "image_id").alias("a"), hash_int(seed + 2, "image_id").alias("z"),
        F.concat_ws("|", F.lit(str(seed)), F.col("image_id").cast("string")).alias("name"), "boxes")
    run = functools.partial(_image_targets, grid, per_image, pos_thr, min(neg_thr, pos_thr))
    out = t.mapInArrow(run, f"image_id {size.schema['image_id'].dataType.simpleString()}, anchor_id long, match int, d array<double>")
    delta = box_refinement(*(tuple(F.get("d", F.lit(k + j)) for j in range(4)) for k in (0, 4)), std=RPN_STD)
    return out.select("image_id", "anchor_id", "match", *delta).unionByName(by_pairs)


def _image_targets(grid: AnchorGrid, per_image: int, pos_thr: float, least: float, batches):
    """Rows of images with their boxes to the images' anchors: (image_id, anchor_id, match, sides of the anchor and of
    its box, null for negatives)."""
    primes = {}
    for batch in batches:
        some = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(batch.column("boxes")), 0).to_numpy())])
        at = 0
        while at < batch.num_rows:
            end = min(max(at + 1, int(np.searchsorted(some, some[at] + ROW_BOXES, side="right")) - 1), at + ROWS, batch.num_rows)
            yield _targets(grid, per_image, pos_thr, least, batch.slice(at, end - at), primes)
            at = end


def _targets(grid: AnchorGrid, per_image: int, pos_thr: float, least: float, part: pa.RecordBatch, primes: dict) -> pa.RecordBatch:
    n, height, width, a, z = (part.column(c).to_numpy() for c in ("n", "height", "width", "a", "z"))
    rows = part.num_rows
    counts = pc.fill_null(pc.list_value_length(part.column("boxes")), 0).to_numpy()
    owner, begin = np.repeat(np.arange(rows), counts), np.cumsum(counts) - counts
    _, *sides, real = part.column("boxes").flatten().flatten()
    box, real = np.stack([s.to_numpy() for s in sides], axis=1), real.to_numpy(zero_copy_only=False)
    shape = np.stack([height, width], axis=1)[owner]
    b, ids, anchor, iou, best = _pairs_of(grid, box, shape, real, np.where(real, least, 0.001))
    weak = np.flatnonzero(best & (iou < least))
    if len(weak):  # the best anchor of a box that is far from it may be nearer to another one
        m = counts[owner[b[weak]]]
        near = np.repeat(begin[owner[b[weak]]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
        w = np.repeat(weak, m)
        inter = _common(box[near], anchor[w])
        value = inter / (_area(box[near]) + _area(anchor[w]) - inter)
        some = (inter > 0) & real[near]
        b, ids, anchor, iou, best = (np.concatenate([x, y[some]]) for x, y in (
            (b, near), (ids, ids[w]), (anchor, anchor[w]), (iou, value), (best, np.ones(len(w), bool))))
    # every touched anchor once, with its best box of class > 0; none of them can be negative
    step = int(ids.max(initial=0)) + 1
    key, top = owner[b] * step + ids, np.where(real[b], iou, -1.0)
    order = np.lexsort((b, -top, key))
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    any_best = np.maximum.reduceat(best[order], first) if len(first) else np.zeros(0, bool)
    barred, one = key[first], order[first]
    positive = any_best | (np.maximum(top[one], 0.0) >= pos_thr)
    one, image = one[positive], barred[positive] // step
    found, cap = np.bincount(image, minlength=rows), per_image // 2
    if (found > cap).any():  # drawn
        names, keep = part.column("name"), found[image] <= cap
        for i in np.flatnonzero(found > cap):
            k = np.flatnonzero(image == i)
            drawn = sorted(k, key=lambda j: (hashlib.md5(f"{names[i].as_py()}|{ids[one[j]]}".encode()).hexdigest(), ids[one[j]]))
            keep[drawn[:cap]] = True
        one, image = one[keep], image[keep]
    # the images' own permutations of their anchor ids, see boxes._draw_anchors
    want = per_image - np.bincount(image, minlength=rows)
    p = np.array([_prime(primes, v) for v in n.tolist()], np.int64)
    a, z = 1 + a % (p - 1), z % p
    steps = np.where((want > 0) & (n > 0), np.minimum(p, want + np.bincount(barred // step, minlength=rows) + p - n), 0)
    walker = np.repeat(np.arange(rows), steps)
    j = np.arange(len(walker)) - np.repeat(np.cumsum(steps) - steps, steps)
    met = (a[walker] * j + z[walker]) % p[walker]
    free = met < n[walker]
    known = met < step  # ids beyond the largest touched one are no key
    spot = np.searchsorted(barred, walker * step + met)
    free &= ~(known & (barred[np.minimum(spot, len(barred) - 1)] == walker * step + met)) if len(barred) else True
    walker, met = walker[free], met[free]
    rank = np.arange(len(walker)) - np.searchsorted(walker, walker)
    taken = rank < want[walker]
    walker, met = walker[taken], met[taken]

    has = np.where(top[one] >= 0, 8, 0)  # an anchor has no box only if every one is positive
    d = np.concatenate([anchor[one], box[b[one]]], axis=1)[has > 0]
    offsets = pa.array(np.concatenate([[0], np.cumsum(has), np.full(len(met), has.sum())]).astype(np.int32),
                       mask=np.concatenate([has == 0, np.ones(len(met), bool), [False]]))
    return pa.RecordBatch.from_arrays(
        [part.column("image_id").take(pa.array(np.concatenate([image, walker]))), pa.array(np.concatenate([ids[one], met])),
         pa.array(np.repeat([1, -1], [len(one), len(met)]).astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))],
        names=["image_id", "anchor_id", "match", "d"])


def _prime(primes: dict, n: int) -> int:
    if n not in primes:
        primes[n] = next_prime(n)
    return primes[n]


def _targets_by_pairs(grid: AnchorGrid, gt: DataFrame, size: DataFrame, per_image: int, pos_thr: float, neg_thr: float,
                      seed: int) -> DataFrame:
    """``label_grid_anchors`` for images of any number of boxes: every pair is a row."""
    boxes = gt.select("image_id", "gt_id", "class_id", *SIDES).join(size, "image_id")
    least, real = min(neg_thr, pos_thr), F.col("class_id") > 0
    # two branches read the pairs: written once to the checkpoint folder
    p = cut_lineage(anchor_pairs(grid, boxes, least))
    weak = p.filter(F.col("best") & (F.col("iou") < least)).select("image_id", "anchor_id", *[F.col(f"a_{s}").alias(s) for s in SIDES])
    weak = iou_join(weak.dropDuplicates(["image_id", "anchor_id"]), gt.filter(real), "anchor_id", "gt_id", b_cols=("class_id",),
                    a_prefix="a_", b_prefix="").withColumnRenamed("a_anchor_id", "anchor_id").withColumn("best", F.lit(True))
    # dealt by image before they are grouped: no task sorts all pairs of its boxes first, nothing moves again below;
    # into more tasks than usual where there are too many pairs for those
    tasks = -(-p.count() // TASK_PAIRS)
    more = tasks > int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = p.unionByName(weak.select(*p.columns)).repartition(*([tasks] if more else []), "image_id")
    p = p.select("image_id", "anchor_id", F.when(real, F.col("iou")).alias("iou"),
                 F.when(real, F.struct(F.col("iou"), (-F.col("gt_id")).alias("_o"), *SIDES)).alias("g"),
                 F.struct(*[F.col(f"a_{s}").alias(s) for s in SIDES]).alias("box"), (~real).cast("int").alias("_crowd"),
                 F.col("best").cast("int").alias("_best"))
    lab = p.groupBy("image_id", "anchor_id").agg(
        F.max("iou").alias("iou"), F.max("g").alias("g"), F.max("box").alias("box"), F.max("_crowd").alias("_crowd"),
        F.max("_best").alias("_best"))
    top = F.coalesce(F.col("iou"), F.lit(0.0))
    match = F.when((F.col("_best") == 1) | (top >= pos_thr), 1).when((top < neg_thr) & (F.col("_crowd") == 0), -1).otherwise(0)
    lab = lab.withColumn("match", match).filter("match <> -1")

    # one row per image: its positives in their drawn order and the anchors that cannot be negative
    drawn = F.struct(hash_order(seed, "image_id", "anchor_id").alias("_r"), F.col("anchor_id"), F.col("box"), F.col("g"))
    per = lab.groupBy("image_id").agg(F.collect_list(F.when(F.col("match") == 1, drawn)).alias("_pos"),
                                      F.collect_list("anchor_id").alias("_barred"))
    t = size.withColumn("_n", grid.total(F.col("height"), F.col("width"))).withColumn("_p", _next_prime("_n"))
    t = t.join(per, "image_id", "left")
    t = t.withColumn("_pos", F.slice(F.array_sort(F.coalesce("_pos", F.array().cast(per.schema["_pos"].dataType))), 1, per_image // 2))
    t = t.withColumn("_barred", F.coalesce("_barred", F.array().cast("array<bigint>")))
    t = t.select("image_id", "_pos", "_barred", "_n", "_p", (F.lit(per_image) - F.size("_pos")).alias("_want"))
    a, z = 1 + F.pmod(hash_int(seed + 1, "image_id"), F.col("_p") - 1), F.pmod(hash_int(seed + 2, "image_id"), F.col("_p"))
    last = F.least(F.col("_p"), F.col("_want") + F.size("_barred") + F.col("_p") - F.col("_n")) - 1
    # the image's own permutation of its anchor ids, see boxes._draw_anchors; a and z are bound once an image
    walk = F.transform(F.array(F.struct(a.alias("a"), z.alias("z"))), lambda s: F.transform(
        F.sequence(F.lit(0).cast("long"), last), lambda j: F.pmod(s["a"] * j + s["z"], F.col("_p"))))[0]
    free = F.array_except(F.filter(walk, lambda x: x < F.col("_n")), F.col("_barred"))
    free = F.when((F.col("_want") > 0) & (F.col("_n") > 0), F.slice(free, F.lit(1), F.greatest(F.col("_want"), F.lit(0))))
    nothing = F.lit(None).cast(per.schema["_pos"].dataType.elementType)
    pos = F.transform("_pos", lambda x: F.struct(F.lit(1).alias("match"), x["anchor_id"].alias("anchor_id"), x.alias("d")))
    neg = F.transform(F.coalesce(free, F.array().cast("array<bigint>")),
                      lambda x: F.struct(F.lit(-1).alias("match"), x.alias("anchor_id"), nothing.alias("d")))
    out = t.select("image_id", F.explode(F.concat(pos, neg)).alias("r")).select("image_id", "r.anchor_id", "r.match", "r.d")
    delta = box_refinement(tuple(F.col(f"d.box.{s}") for s in SIDES), tuple(F.col(f"d.g.{s}") for s in SIDES), std=RPN_STD)
    return out.select("image_id", "anchor_id", "match", *delta)


def _next_prime(n: str) -> Column:
    """First prime from ``n`` on; the images' shapes repeat, so each batch computes its few values once."""
    @F.pandas_udf("long")
    def primes(values: pd.Series) -> pd.Series:
        return values.map({v: next_prime(int(v)) for v in values.unique()})

    return primes(F.col(n))
