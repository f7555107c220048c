"""Counts by the tree of equally full cells (J9-J11, J13, A25) against brute force, hot places included."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import celltree as T
from tessera.operators import spatial as G

POINT = "point_id long, lat double, lon double, label int"
BOX = "zone_id long, lat_bl double, lat_tr double, lon_bl double, lon_tr double"


def hav(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(1.0, h)))


@pytest.fixture
def small_cells(monkeypatch):
    monkeypatch.setattr(T, "LEAF", 4)
    monkeypatch.setattr(T, "FAN", 4)


def places(rng, n):
    """Points with nine tenths in one spot, some around the date line and a pole, and equal ones."""
    hot = np.tile([[10.0, 20.0]], (n * 9 // 10, 1)) + rng.normal(size=(n * 9 // 10, 2)) * 1e-4
    hot[::2] = [10.0, 20.0]
    rest = np.concatenate([np.stack([rng.uniform(-1, 1, n // 20), rng.choice([-179.99, 179.99], n // 20)], 1),
                           np.stack([rng.uniform(89.9, 90, n // 20), rng.uniform(-180, 180, n // 20)], 1)])
    return np.concatenate([hot, rest])


def test_circles_and_boxes_against_brute_force(spark, small_cells):
    rng = np.random.default_rng(2)
    xy = places(rng, 600)
    rows = [(i, float(a), float(b), i % 3) for i, (a, b) in enumerate(xy)] + [(9000, None, 1.0, 0), (9001, 1.0, float("nan"), 0)]
    pts = spark.createDataFrame(rows, POINT).repartition(7)
    centres = [(10.0, 20.0), (10.0001, 20.0), (0.0, 180.0), (0.0, -180.0), (90.0, 0.0), (-45.0, 3.0), (10.001, 20.001)]
    c = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(centres)] + [(50, None, 1.0)], "zone_id long, lat double, lon double")
    radii = [0.0, 0.01, 0.05, 5.0, 300.0, 30000.0]
    got = {r.zone_id: r for r in G.radius_count(c, pts, radii, class_col="label", classes=[0, 1, 2, 7]).collect()}
    for k, (a, b) in enumerate(centres):
        d = hav(a, b, xy[:, 0], xy[:, 1])
        for r in radii:
            for cls in (0, 1, 2, 7):
                name = f"n_within_{cls}_{str(r).replace('.', '_')}"
                assert got[k][name] == int(((d <= r) & (np.arange(len(xy)) % 3 == cls)).sum()), (k, name)
    assert all(v == 0 for v in got[50][1:])
    near = {r.zone_id: r.near_any for r in G.within_distance_of_any(c, pts, 5.0).collect()}
    assert near == {**{k: int(hav(a, b, xy[:, 0], xy[:, 1]).min() <= 5.0) for k, (a, b) in enumerate(centres)}, 50: 0}

    boxes = [(0, 10.0, 10.0, 20.0, 20.0), (1, 9.9999, 10.0, 19.0, 20.00005), (2, -90.0, 90.0, -180.0, 180.0), (3, 50.0, 60.0, 0.0, 1.0),
             (4, 10.0, 9.0, 20.0, 21.0), (5, None, 1.0, 0.0, 1.0)] + [(10 + i, 10 - 1e-5 * i, 10 + 2e-5 * i, 20 - 1e-5 * i, 20 + 1e-5) for i in range(30)]
    z = spark.createDataFrame(boxes, BOX)
    got = {r.zone_id: r for r in G.zone_attribute_counts(z, pts, {"one": F.col("label") == 1}).collect()}
    some = {r.zone_id: r.has_point for r in G.point_in_box_exists(z, pts).collect()}
    for k, *b in boxes:
        if None in b:
            hit = np.zeros(len(xy), bool)
        else:
            hit = (xy[:, 0] >= b[0]) & (xy[:, 0] <= b[1]) & (xy[:, 1] >= b[2]) & (xy[:, 1] <= b[3])
        ones = int((hit & (np.arange(len(xy)) % 3 == 1)).sum())
        assert (got[k].n_total, got[k].n_one, some[k]) == (int(hit.sum()), ones, int(hit.any())), k
        assert got[k].share_one == (ones / hit.sum() if hit.any() else None)


def test_no_points_and_no_zones(spark):
    none = spark.createDataFrame([], POINT)
    z = spark.createDataFrame([(1, 0.0, 1.0, 0.0, 1.0)], BOX)
    assert [r.n_points for r in G.point_in_box_count(z, none).collect()] == [0]
    one = spark.createDataFrame([(1, 0.5, 0.5, 0)], POINT)
    assert G.point_in_box_count(z.limit(0), one).collect() == [] and [r.n_points for r in G.point_in_box_count(z, one).collect()] == [1]


def test_a_crowded_place_is_spread_and_not_paired(spark):
    """Nine tenths of the points in one spot: the largest task holds under three times the median, leaves
    keep their bound, and only leaves on the border of a zone pair points."""
    rng = np.random.default_rng(4)
    xy = places(rng, 40000)
    pts = spark.createDataFrame([(i, float(a), float(b), 0) for i, (a, b) in enumerate(xy)], POINT).repartition(5)
    tree = T.cell_tree(pts, {"n": F.lit(True)})
    sizes = sorted(r["count"] for r in tree.points.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    leaves = [r["count"] for r in tree.points.groupBy("leaf").count().collect()]
    assert max(leaves) <= T.LEAF and sum(leaves) == len(xy) and len(leaves) < 2 * len(xy) / T.LEAF + 16
    z = spark.createDataFrame([(k, 10.0 - 2e-4 * k, 10.0 + 2e-4 * k, 19.9, 20.1) for k in range(1, 40)], BOX)
    out = T.counts_in_boxes(z, tree, ["n"])
    got = {r.zone_id: r.n for r in out.collect()}
    assert all(got[k] == int(((np.abs(xy[:, 0] - 10) <= 2e-4 * k + 1e-12) & (np.abs(xy[:, 1] - 20) <= 0.1)).sum()) for k in (2, 9, 39))
    inner = (xy[:, 0] == 10.0).sum()
    joined = _rows_of_joins(out)
    assert joined < len(z.collect()) * inner / 4, (joined, inner)


def _rows_of_joins(df) -> int:
    """Rows that the last join (leaves with points) of an executed plan put out."""
    df = df.filter("zone_id >= 0")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, stack = 0, [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            stack.append(node.plan())
            continue
        if "Join" in name and node.metrics().contains("numOutputRows"):
            total = max(total, node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    assert math.isfinite(total)
    return total
