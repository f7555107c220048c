"""Spatial counts and neighbours.

Spark has no spatial index, and a theta join of zones x points would be a
nested loop. Counts in boxes and circles go down a tree of cells that hold
equally many points (``celltree``); nearest neighbours go down a pyramid of cells.
Every step is an EQUI join on a cell; only cells on a zone's border pair points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.geo import haversine_km
from tessera.operators.celltree import CellTree, cell_tree, counts_in_boxes, counts_in_circles
from tessera.session import cut_lineage

__all__ = ["point_tree", "point_in_box_count", "point_in_box_exists", "zone_attribute_counts", "radius_count", "knn_euclidean",
           "knn_distances", "knn_stats", "within_distance_of_any"]


def point_tree(points: DataFrame, conditions: dict | None = None) -> CellTree:
    """Tree of the points for the box operators: all points first, then each named condition. One tree
    serves any number of them."""
    return cell_tree(points, {"": F.lit(True), **(conditions or {})})


def point_in_box_count(zones: DataFrame, points: DataFrame | CellTree, name: str = "n_points") -> DataFrame:
    """Points with lat_bl <= lat <= lat_tr and lon_bl <= lon <= lon_tr (both ends inclusive);
    0 for zones without points (J9)."""
    tree = points if isinstance(points, CellTree) else point_tree(points)
    return counts_in_boxes(zones, tree, [name, *tree.measures[1:]]).select("zone_id", name)


def point_in_box_exists(zones: DataFrame, points: DataFrame | CellTree, name: str = "has_point") -> DataFrame:
    """1 when at least one point lies in the zone."""
    n = point_in_box_count(zones, points, "_n")
    return n.select("zone_id", (F.col("_n") > 0).cast("int").alias(name))


def zone_attribute_counts(zones: DataFrame, points: DataFrame | CellTree, conditions: dict, total: str = "n_total") -> DataFrame:
    """Per zone: number of points and, for each named condition, count and share."""
    tree = points if isinstance(points, CellTree) else point_tree(points, conditions)
    out = counts_in_boxes(zones, tree, [total] + [f"n_{n}" for n in conditions])
    return out.withColumns({f"share_{n}": F.try_divide(F.col(f"n_{n}").cast("double"), F.col(total).cast("double"))
                            for n in conditions})


def radius_count(centres: DataFrame, points: DataFrame, radii_km, prefix: str = "n_within_",
                 class_col: str | None = None, classes=()) -> DataFrame:
    """Points within r km of each centre, for every radius in one pass (J11); 0 if none.

    With ``class_col`` every class of the declared list ``classes`` gets its own columns
    (``<prefix><class>_<radius>``), all counted in the same descent."""
    tails = [str(r).replace(".", "_") for r in radii_km]
    if class_col:
        tree = cell_tree(points, {str(c): F.col(class_col) == F.lit(c) for c in classes})
        names = [[f"{prefix}{c}_{t}" for c in classes] for t in tails]
    else:
        tree, names = cell_tree(points, {"n": F.lit(True)}), [[f"{prefix}{t}"] for t in tails]
    return counts_in_circles(centres, tree, radii_km, names)


#: Levels of the cell pyramid that one step of the descent goes down, and its deepest level
#: (cells of 0.01 m on the earth).
DESCENT = 3
MAX_LEVEL = 30


def _unit_cell(c: Column, level) -> Column:
    """Cell of a coordinate in [0, 2] at a level: 2^level cells along each axis."""
    n = F.pow(F.lit(2.0), F.lit(level))
    return F.least(F.floor(c * n / 2), n - 1).cast("long")


def _sphere(df: DataFrame) -> DataFrame:
    """Points on the unit sphere, shifted to [0, 2]: no seam at the date line or the poles."""
    la, lo = F.radians("lat"), F.radians("lon")
    return df.withColumns({"_x": F.cos(la) * F.cos(lo) + 1, "_y": F.cos(la) * F.sin(lo) + 1, "_z": F.sin(la) + 1})


def knn_distances(centres: DataFrame, points: DataFrame, k: int, class_col: str | None = None, classes=()) -> DataFrame:
    """Exact k nearest points of each centre: (zone_id, [class,] point_id, dist, rank), rank 1..k.

    With ``class_col`` the k nearest of every class of the declared list ``classes``, in the
    same pass. Points are counted in a pyramid of cells (an octree on the unit sphere). Every
    centre descends it, DESCENT levels a step: each kept cell is replaced by its nonempty
    children, the k-th smallest upper distance bound (weighted by the counts) is a radius
    that surely holds k points, and children wholly beyond it are dropped. The few cells left
    on the last level are joined with their points. Any centre is exact at any distance from
    the points, and the steps depend on the points' density only."""
    by = [class_col] if class_col else []
    pts = _sphere(points.select("point_id", "lat", "lon", *by))
    st = pts.agg(*[F.max(c) - F.min(c) for c in ("_x", "_y", "_z")], F.count(F.lit(1))).first()
    extent, n = max((v or 0.0) for v in st[:3]), int(st[3])
    # about k points a cell on the deepest level, if they were spread over a surface
    depth = math.ceil(math.log2(2 / max(extent, 2.0 ** -MAX_LEVEL)) + 0.5 * math.log2(max(1.0, n / k)))
    depth = int(min(MAX_LEVEL, max(DESCENT, -(-depth // DESCENT) * DESCENT)))
    axes = ("_x", "_y", "_z")
    cells = ["_cx", "_cy", "_cz"]
    at = lambda level: [_unit_cell(F.col(a), level).alias(c) for a, c in zip(axes, cells)]
    finest = pts.select(*by, *at(depth)).groupBy(*by, *cells).agg(F.count(F.lit(1)).alias("_n"))
    state = _sphere(centres.select("zone_id", "lat", "lon")).withColumnsRenamed({"lat": "zlat", "lon": "zlon"})
    if class_col:
        state = state.withColumn(class_col, F.explode(F.array(*[F.lit(v) for v in classes])))
    who = ["zone_id", *by]
    state = state.withColumns({f"_p{c}": F.lit(0).cast("long") for c in cells})
    for level in range(DESCENT, depth + 1, DESCENT):
        up = depth - level
        child = finest.groupBy(*by, *[F.shiftright(c, up).alias(c) for c in cells]).agg(F.sum("_n").alias("_n"))
        child = child.withColumns({f"_p{c}": F.shiftright(c, DESCENT) for c in cells})
        if level == DESCENT:
            child = F.broadcast(child)  # at most 8^DESCENT cells a class
        t = state.join(child, [*by, *[f"_p{c}" for c in cells]])
        size = 2.0 / 2 ** level
        low = high = F.lit(0.0)
        for a, c in zip(axes, cells):
            lo, hi = F.col(c) * size, (F.col(c) + 1) * size
            near = F.greatest(lo - F.col(a), F.col(a) - hi, F.lit(0.0))
            far = F.greatest(F.abs(F.col(a) - lo), F.abs(F.col(a) - hi))
            low, high = low + near * near, high + far * far
        t = t.withColumns({"_low": low, "_high": high})
        # the smallest upper bound whose cells hold k points; all cells if there are fewer points
        run = F.sum("_n").over(Window.partitionBy(*who).orderBy("_high").rangeBetween(Window.unboundedPreceding, 0))
        t = t.withColumn("_run", run)
        bound = F.coalesce(F.min(F.when(F.col("_run") >= k, F.col("_high"))).over(Window.partitionBy(*who)), F.lit(12.0))
        t = t.withColumn("_bound", bound).filter(F.col("_low") <= F.col("_bound") * (1 + 1e-9) + 1e-15)
        state = t.select(*who, "zlat", "zlon", *axes, *[F.col(c).alias(f"_p{c}") for c in cells])
    p = pts.select("point_id", "lat", "lon", *by, *[c.alias(f"_p{n}") for c, n in zip(at(depth), cells)])
    cand = state.drop(*axes).join(p, [*by, *[f"_p{c}" for c in cells]])
    cand = cand.select(*who, "point_id", haversine_km("zlat", "zlon", "lat", "lon").alias("dist"))
    w = Window.partitionBy(*who).orderBy("dist", "point_id")
    return cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= F.lit(int(k)))


def knn_stats(centres: DataFrame, points: DataFrame, ks=(3, 5, 10), prefix: str = "knn",
              class_col: str | None = None, classes=()) -> DataFrame:
    """Mean, max, population std of distances to the k nearest (each k), and the minimum.
    With ``class_col`` one row per zone and class of the declared list."""
    kmax = max(ks)
    nn = knn_distances(centres, points, kmax, class_col, classes)
    aggs = [F.min("dist").alias(f"{prefix}_min")]
    for k in ks:
        d = F.when(F.col("rank") <= k, F.col("dist"))
        aggs += [F.avg(d).alias(f"{prefix}{k}_mean"), F.max(d).alias(f"{prefix}{k}_max"),
                 F.stddev_pop(d).alias(f"{prefix}{k}_std")]
    zones, who = centres.select("zone_id"), ["zone_id"]
    if class_col:
        zones = zones.withColumn(class_col, F.explode(F.array(*[F.lit(v) for v in classes])))
        who.append(class_col)
    return zones.join(nn.groupBy(*who).agg(*aggs), who, "left")


def within_distance_of_any(a: DataFrame, b: DataFrame, d_km: float, name: str = "near_any") -> DataFrame:
    """1 if any row of ``b`` lies within ``d_km`` of the row of ``a``."""
    n = counts_in_circles(a, cell_tree(b, {"n": F.lit(True)}), [d_km], [["_n"]])
    return n.select("zone_id", (F.col("_n") > 0).cast("int").alias(name))


def _vector_blocks(df: DataFrame, key: str, vec: str, rows: int) -> DataFrame:
    """Rows packed as (block, keys, matrix, centre, radius, n): numpy blocks of ``rows`` vectors of one length.
    Vectors that are null, empty or hold a null or non-finite component are left out."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext
    key_type = df.schema[key].dataType.simpleString()
    src = df.select(F.col(key).alias("key"), F.transform(vec, lambda x: x.cast("double")).alias("v"))
    whole = F.forall("v", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    src = src.filter(F.col("v").isNotNull() & (F.size("v") > 0) & whole)

    def run(batches):
        part, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            keys, lists = batch.column(0), batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for d in np.unique(sizes):
                of_length = np.flatnonzero(sizes == d)
                for a in range(0, len(of_length), rows):
                    some = of_length[a:a + rows]
                    m = flat[starts[some][:, None] + np.arange(d)]
                    centre = m.mean(0)
                    radius = float(np.sqrt(((m - centre) ** 2).sum(1)).max())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part + n]), pa.array([keys.take(pa.array(some)).to_pylist()], pa.list_(keys.type)),
                         pa.array([m.tobytes()], pa.binary()), pa.array([centre.tolist()]), pa.array([radius]), pa.array([len(m)], pa.int32())],
                        ["block", "keys", "matrix", "centre", "radius", "n"])
                    n += 1

    return cut_lineage(src.mapInArrow(run, f"block long, keys array<{key_type}>, matrix binary, centre array<double>, "
                                           "radius double, n int"))


def _nearest(a, b, k: int, at_once: int = 1 << 15):
    """The k nearest rows of ``b`` of every row of ``a``: (row of a, row of b, distance), ties to the earlier row.
    One matrix product tells which rows can be among them; only their distances are worked out, from the differences."""
    import numpy as np
    with np.errstate(over="ignore", invalid="ignore"):
        aa, bb = (a * a).sum(1), (b * b).sum(1)
        about = aa[:, None] + bb - 2 * (a @ b.T)
        # rounding of the product: far below this, also with large components that nearly cancel
        slack = 8 * (a.shape[1] + 4) * np.finfo(float).eps * (aa + bb.max(initial=0.0))
        last = min(k, len(b)) - 1
        limit = np.partition(about, last, axis=1)[:, last] + 2 * slack
        maybe = ~(about > limit[:, None])  # also what is not a number
    found = []
    ends = np.cumsum(maybe.sum(1))
    at = 0
    while at < len(a):  # a bounded number of differences at once
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + at_once, side="right")))
        i, j = np.nonzero(maybe[at:end])
        with np.errstate(over="ignore"):
            d = np.sqrt(((b[j] - a[at + i]) ** 2).sum(1))
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        found.append((at + i[rank < k], j[rank < k], d[rank < k]))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def knn_euclidean(queries: DataFrame, refs: DataFrame, k: int, key: str, vec: str, ref_key: str = "_tk",
                  block_rows: int = 1024) -> DataFrame:
    """Exact k nearest reference rows of each query in Euclidean space over ``vec`` (array).

    Blocks of queries meet blocks of references. A block is a ball (centre, radius); a pair of
    blocks is dropped when no query of one can have a k-th neighbour in the other (triangle
    inequality against the smallest radius that surely holds k references). The pairs left are
    compared by a matrix product (see ``_nearest``), each returning k rows a query. Output: key, ref columns, dist, rank
    (ties: smaller ``ref_key``, which must be unique). Vectors meet those of their own length only; a
    query without a whole vector (null, empty, or with a null or non-finite component) has no neighbours,
    and such a reference is nobody's."""
    import numpy as np
    import pyarrow as pa
    q = _vector_blocks(queries, key, vec, block_rows)
    r = _vector_blocks(refs, ref_key, vec, block_rows)
    gap = F.sqrt(F.aggregate(F.zip_with("q_centre", "r_centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                             lambda acc, x: acc + x))
    meta_q = q.select(F.col("block").alias("q_block"), F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"))
    meta_r = r.select(F.col("block").alias("r_block"), F.col("centre").alias("r_centre"), F.col("radius").alias("r_radius"), "n")
    # one row per pair of blocks: the stated query set against all references, in blocks
    pairs = meta_q.join(meta_r, F.size("q_centre") == F.size("r_centre")).withColumn("_gap", gap)
    pairs = pairs.withColumns({"_low": F.col("_gap") - F.col("q_radius") - F.col("r_radius"),
                               "_high": F.col("_gap") + F.col("q_radius") + F.col("r_radius")})
    w = Window.partitionBy("q_block").orderBy("_high").rangeBetween(Window.unboundedPreceding, 0)
    pairs = pairs.withColumn("_run", F.sum("n").over(w))
    bound = F.min(F.when(F.col("_run") >= k, F.col("_high"))).over(Window.partitionBy("q_block"))
    pairs = pairs.withColumn("_bound", F.coalesce(bound, F.lit(float("inf")))) \
                 .filter(F.col("_low") <= F.col("_bound") * (1 + 1e-9)).select("q_block", "r_block")
    work = pairs.join(q.select(F.col("block").alias("q_block"), F.col("keys").alias("q_keys"), F.col("matrix").alias("q_matrix")),
                      "q_block") \
                .join(r.select(F.col("block").alias("r_block"), F.col("keys").alias("r_keys"), F.col("matrix").alias("r_matrix")),
                      "r_block").select("q_keys", "q_matrix", "r_keys", "r_matrix")
    types = dict(queries.dtypes)[key], dict(refs.dtypes)[ref_key]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                qk, rk = batch.column(0)[i].values, batch.column(2)[i].values
                a = np.frombuffer(batch.column(1)[i].as_py()).reshape(len(qk), -1)
                b = np.frombuffer(batch.column(3)[i].as_py()).reshape(len(rk), -1)
                names = rk.to_pylist()
                order = np.array(sorted(range(len(rk)), key=names.__getitem__))  # ties: smaller key first
                of, near, dist = _nearest(a, b[order], k)
                yield pa.RecordBatch.from_arrays([qk.take(pa.array(of)), rk.take(pa.array(order[near])), pa.array(dist)],
                                                 [key, ref_key, "dist"])

    found = work.mapInArrow(run, f"`{key}` {types[0]}, `{ref_key}` {types[1]}, dist double")
    top = found.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("dist", ref_key))) \
               .filter(F.col("rank") <= F.lit(int(k)))
    rest = [c for c in refs.columns if c not in (vec, ref_key)]
    return top.join(refs.select(ref_key, *rest), ref_key).select(key, ref_key, *rest, "dist", "rank")
