"""Anchors by arithmetic (D1, D2, D5) against the anchor table and a dense rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import anchors
from tessera.operators import boxes as B
from tessera.operators.anchors import AnchorGrid, anchor_pairs, grid_anchors, label_grid_anchors

GRIDS = [AnchorGrid((16, 32, 64), (0.5, 1.0, 2.0), (8, 16, 32)), AnchorGrid((8, 40), (1.0, 3.0), (4, 16), anchor_stride=2)]
BOX = "image_id long, gt_id int, class_id int, y1 int, x1 int, y2 int, x2 int"


def table(spark, grid, shapes):
    """The anchors as the explicit generator makes them, per shape."""
    out = None
    for h, w in shapes:
        a = B.generate_pyramid_anchors(spark, grid.scales, grid.ratios, (h, w), grid.strides, grid.anchor_stride)
        a = a.select(F.lit(h).alias("height"), F.lit(w).alias("width"), "*")
        out = a if out is None else out.unionByName(a)
    return out


def some_boxes(rng, images, n):
    rows = []
    for image in range(images):
        for g in range(n):
            y, x = (int(v) for v in rng.integers(-10, 110, 2))
            h, w = (int(v) for v in rng.choice([0, 2, 3, 5, 9, 16, 23, 32, 45, 64, 100], 2))
            rows.append((image, g, int(rng.choice([1, 2, -1], p=[0.6, 0.3, 0.1])), y, x, y + h, x + w))
    return rows


@pytest.mark.parametrize("grid", GRIDS)
def test_same_labels_as_the_anchor_table(spark, grid):
    rng = np.random.default_rng(len(grid.scales))
    rows = some_boxes(rng, 12, 6) + [(12, 0, 1, 0, 0, 128, 160), (12, 1, -1, 5, 5, 90, 90), (13, 0, 3, 40, 40, 42, 42)]
    rows = [r for r in rows if r[5] > r[3] and r[6] > r[4]]
    shapes = [(128, 128), (120, 160)]
    images = spark.createDataFrame([(i, *shapes[i % 2]) for i in range(15)], "image_id long, height int, width int")
    gt = spark.createDataFrame(rows, BOX).repartition(4)
    anchors = table(spark, grid, shapes).drop("level")
    assert sorted(map(tuple, grid_anchors(images.select("height", "width").distinct(), grid).drop("level").collect())) == \
        sorted(map(tuple, anchors.select("height", "width", "anchor_id", "y1", "x1", "y2", "x2").collect()))
    old = B.label_anchors(anchors, gt, images, per_image=40, seed=9, shape=("height", "width"))
    new = label_grid_anchors(grid, gt, images, per_image=40, seed=9)
    key = lambda r: (r[0], r[1])
    a, b = sorted(map(tuple, old.collect()), key=key), sorted(map(tuple, new.collect()), key=key)
    assert len(a) == 15 * 40 and a == b


def test_pairs_against_every_anchor(spark):
    grid, rng = GRIDS[0], np.random.default_rng(8)
    rows = some_boxes(rng, 4, 30) + [(4, 0, 1, 5000, 5000, 5010, 5010)]
    images = spark.createDataFrame([(i, 128, 150) for i in range(5)], "image_id long, height int, width int")
    got = anchor_pairs(grid, spark.createDataFrame(rows, BOX).join(images, "image_id"), 0.3).collect()
    got = {(r.image_id, r.gt_id, r.anchor_id): (r.iou, r.best) for r in got}
    anchors = [r for r in table(spark, grid, [(128, 150)]).orderBy("anchor_id").collect()]
    a = np.array([[r.y1, r.x1, r.y2, r.x2] for r in anchors])
    expected = {}
    for image, g, cls, y1, x1, y2, x2 in rows:
        if y2 <= y1 or x2 <= x1:
            continue
        inter = np.maximum(np.minimum(a[:, 2], y2) - np.maximum(a[:, 0], y1), 0) * np.maximum(np.minimum(a[:, 3], x2) - np.maximum(a[:, 1], x1), 0)
        iou = inter / ((y2 - y1) * (x2 - x1) + (a[:, 2] - a[:, 0]) * (a[:, 3] - a[:, 1]) - inter)
        best = int(np.argmax(iou)) if cls > 0 and iou.max() > 0 else -1
        for k in np.flatnonzero(iou >= (0.3 if cls > 0 else 0.001)).tolist() + [best]:
            if k >= 0:
                expected[image, g, k] = (float(iou[k]), k == best)
    assert got == expected


def test_no_boxes_no_images_and_empty_feature_maps(spark):
    grid = GRIDS[0]
    images = spark.createDataFrame([(1, 128, 128), (2, 0, 0), (3, 1, 1)], "image_id long, height int, width int")
    none = spark.createDataFrame([], BOX)
    out = label_grid_anchors(grid, none, images, per_image=64).groupBy("image_id", "match").count().collect()
    assert {(r.image_id, r.match, r["count"]) for r in out} == {(1, -1, 64), (3, -1, 9)}
    assert label_grid_anchors(grid, none, images.limit(0)).collect() == []


def test_plan_has_no_table_of_anchors(spark):
    """At the size of real photos (262 000 anchors an image) no plan holds or joins the anchors."""
    grid = AnchorGrid((32, 64, 128, 256, 512), (0.5, 1, 2), (4, 8, 16, 32, 64))
    images = spark.createDataFrame([(1, 1024, 1024)], "image_id long, height int, width int")
    gt = spark.createDataFrame([(1, 0, 1, 100, 200, 400, 420), (1, 1, 2, 10, 10, 18, 14), (1, 2, -1, 500, 0, 1000, 1000)], BOX)
    pairs = anchor_pairs(grid, gt.join(images, "image_id"), 0.3)
    assert pairs.filter("class_id > 0").count() < 3000
    out = label_grid_anchors(grid, gt, images, per_image=256)
    rows = out.collect()
    assert len(rows) == 256 and len({r.anchor_id for r in rows}) == 256 and max(r.anchor_id for r in rows) < 261888
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "anchor_id" not in "".join(x for x in plan.splitlines() if "Join" in x and "_cy" not in x)


def test_pairs_move_once_and_are_sorted_only_where_they_arrive(spark):
    images = spark.createDataFrame([(i, 128, 128) for i in range(4)], "image_id long, height int, width int")
    gt = spark.createDataFrame(some_boxes(np.random.default_rng(3), 4, 5), BOX)
    plan = label_grid_anchors(GRIDS[0], gt, images, per_image=40)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("REPARTITION_BY_COL", 1)
    assert "functions=[max(iou" in above and "partial_max" in above and "partial_collect_list" in above
    assert "partial_max" not in below and "partial_collect_list" not in below
    assert not [line for line in above.splitlines() if "Exchange hashpartitioning" in line and "anchor_id" in line]


def test_many_pairs_are_dealt_to_more_tasks(spark, monkeypatch):
    images = spark.createDataFrame([(i, 128, 128) for i in range(40)], "image_id long, height int, width int")
    gt = spark.createDataFrame(some_boxes(np.random.default_rng(4), 40, 5), BOX)
    few = label_grid_anchors(GRIDS[0], gt, images, per_image=40).collect()
    monkeypatch.setattr(anchors, "TASK_PAIRS", 50)
    many = label_grid_anchors(GRIDS[0], gt, images, per_image=40)
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, many.collect())) == sorted(map(str, few))


@pytest.mark.parametrize("crowded", [1, 3, 256])
def test_images_as_rows_and_by_pairs_give_the_same(spark, monkeypatch, crowded):
    """crowded images are labelled pair by pair, the others in their row, also where positives are drawn."""
    monkeypatch.setattr(anchors, "CROWDED", crowded)
    monkeypatch.setattr(anchors, "ROW_BOXES", 7)
    grid, shapes = GRIDS[0], [(128, 128), (120, 160)]
    rows = [r for r in some_boxes(np.random.default_rng(11), 12, 6) if r[5] > r[3] and r[6] > r[4]]
    rows += [(20, g, 1, 10 * g, 10 * g, 10 * g + 32, 10 * g + 32) for g in range(8)]
    rows += [(None, 0, 1, 0, 0, 32, 32), (1, 99, None, 60, 60, 90, 90), (2, None, 1, 60, 60, 90, 90)]
    images = spark.createDataFrame([(i, *shapes[i % 2]) for i in range(22)], "image_id long, height int, width int")
    gt = spark.createDataFrame(rows, BOX)
    table_ = table(spark, grid, shapes).drop("level")
    known = gt.filter("image_id IS NOT NULL AND class_id IS NOT NULL AND gt_id IS NOT NULL")
    key = lambda r: (r[0], r[1])
    for per_image in (4, 40):
        old = B.label_anchors(table_, known, images, per_image=per_image, seed=9, shape=("height", "width"))
        new = label_grid_anchors(grid, known, images, per_image=per_image, seed=9)
        assert sorted(map(tuple, old.collect()), key=key) == sorted(map(tuple, new.collect()), key=key)
    odd = sorted(map(str, label_grid_anchors(grid, gt, images, per_image=40, seed=9).collect()))
    monkeypatch.setattr(anchors, "CROWDED", 0)
    assert odd == sorted(map(str, label_grid_anchors(grid, gt, images, per_image=40, seed=9).collect()))


def test_pairs_of_images_are_not_written(spark, monkeypatch):
    written, cut = [], anchors.cut_lineage
    monkeypatch.setattr(anchors, "cut_lineage", lambda df: written.append(cut(df)) or written[-1])
    images = spark.createDataFrame([(i, 128, 128) for i in range(10)], "image_id long, height int, width int")
    gt = spark.createDataFrame(some_boxes(np.random.default_rng(3), 10, 5), BOX)
    out = label_grid_anchors(GRIDS[0], gt, images, per_image=40)
    assert sum(w.count() for w in written) == 0 and out.count() == 400
    rows, plan = out._jdf.queryExecution().executedPlan().toString().split("MapInArrow", 1)
    assert "Exchange hashpartitioning" not in rows
