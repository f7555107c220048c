"""Cells that hold equally many points, in a tree: counts inside boxes and circles.

A grid of fixed step has cells as full as the map is dense. Here points are put in the order of a space-filling
curve (the bits of latitude and longitude in turn), cut into ranges of that order, and every LEAF consecutive
points of a range are a leaf; FAN consecutive leaves are a node, and so on up to the root. However the points
lie, a leaf has at most LEAF of them, and a place with very many points becomes many leaves of no extent.

A zone starts at the top. A node wholly inside it adds the node's counts, a node wholly outside is dropped,
any other is replaced by its children; only the leaves on the zone's border pair points. So the rows grow
with the border of a zone, not with its content.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.geo import EARTH_RADIUS_KM, haversine_km
from tessera.session import cut_lineage

__all__ = ["CellTree", "cell_tree", "counts_in_boxes", "counts_in_circles"]

LEAF, FAN = 256, 16
#: Bits of each axis in the curve's code.
BITS = 24
AXES = ("lat", "lon", "_x", "_y", "_z")


@dataclass
class CellTree:
    """``points``: lat, lon, one 0/1 column per measure, ``leaf``. ``levels``: from the top down to the leaves,
    (node, parent, bounds of every axis, sums of the measures). ``top``: the possible nodes of the top level,
    at most FAN."""

    points: DataFrame
    levels: list[DataFrame]
    top: list[int]
    measures: list[str]


def _code(lat: Column, lon: Column, bounds) -> Column:
    """Place on the curve through the bounds of the points: the bits of both cells in turn. Binary digits
    read as base 4 stand two bits apart."""
    parts = []
    for c, (lo, hi) in ((lat, bounds[0]), (lon, bounds[1])):
        cell = F.least(F.floor((c - lo) / max(hi - lo, 1e-300) * (1 << BITS)), F.lit((1 << BITS) - 1)).cast("long")
        parts.append(F.conv(F.bin(cell), 4, 10).cast("long"))
    return 2 * parts[0] + parts[1]


def cell_tree(points: DataFrame, measures: dict[str, Column]) -> CellTree:
    """Tree over the points (lat, lon in degrees), counting for every measure the points for which its
    condition holds. Points without a place are left out."""
    names = list(measures)
    la, lo = F.radians("lat"), F.radians("lon")
    p = points.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"),
                      *[F.coalesce(m.cast("boolean"), F.lit(False)).cast("int").alias(f"m{k}") for k, m in enumerate(measures.values())])
    p = p.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    b = p.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    bounds = [(b[0] or 0.0, b[1] or 0.0), (b[2] or 0.0, b[3] or 0.0)]
    ranges = max(8, int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    p = p.withColumns({"_code": _code(F.col("lat"), F.col("lon"), bounds), "_uid": F.monotonically_increasing_id()})
    p = p.repartitionByRange(ranges, "_code", "_uid").sortWithinPartitions("_code", "lat", "lon").drop("_code", "_uid")
    # place of a row in its range: the lower 33 bits of the id
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    p = cut_lineage(p.withColumns({"_range": F.spark_partition_id().cast("long"), "_row": row}))
    p = p.withColumn("_place", F.shiftright("_row", LEAF.bit_length() - 1))
    extent = [f(c).alias(f"{t}{c}") for c in AXES for f, t in ((F.min, "lo"), (F.max, "hi"))]
    sums = [F.sum(f"m{k}").alias(f"m{k}") for k in range(len(names))]
    sphere = {"_x": F.cos(la) * F.cos(lo), "_y": F.cos(la) * F.sin(lo), "_z": F.sin(la)}
    nodes = cut_lineage(p.withColumns(sphere).groupBy("_range", "_place").agg(*extent, *sums))
    most = nodes.agg(F.max("_place")).first()[0] or 0
    wide = [f(f"{t}{c}").alias(f"{t}{c}") for c in AXES for f, t in ((F.min, "lo"), (F.max, "hi"))]
    # nodes of a range are joined first, then ranges; a node's id tells the nodes of its level apart
    span = 1 << max(1, int(most).bit_length())
    up_bits = FAN.bit_length() - 1
    levels = []
    while True:
        here, place = F.col("_range"), F.col("_place")
        last = most == 0 and ranges <= FAN
        up = [here.alias("_range"), F.shiftright(place, up_bits).alias("_place")] if most else \
            [F.shiftright(here, up_bits).alias("_range"), place.alias("_place")]
        parent = F.lit(None).cast("long") if last else up[0] * span + up[1]
        levels.append(nodes.select((here * span + place).alias("node"), parent.alias("parent"),
                                   *[f"{t}{c}" for c in AXES for t in ("lo", "hi")], *[f"m{k}" for k in range(len(names))]))
        if last:
            break
        nodes = nodes.groupBy(*up).agg(*wide, *sums)
        if most:
            most >>= up_bits
        else:
            ranges = -(-ranges // FAN)
    leaf = (F.col("_range") * span + F.col("_place")).alias("leaf")
    return CellTree(p.select("lat", "lon", *[f"m{k}" for k in range(len(names))], leaf), levels[::-1], [r * span for r in range(ranges)], names)


def _counted(zones: DataFrame, shape: list[str], tree: CellTree, outside: Column, inside: list[Column], open_: Column,
             holds: list[Column]) -> DataFrame:
    """Sums of every measure inside every of several regions of a zone: (zone_id, s<region>_<measure>).

    ``outside``, ``inside`` (per region) and ``open_`` (some region cuts the node) judge a node's bounds,
    ``holds`` (per region) a point. Every level reads the open nodes of the level above from a written table."""
    measures = range(len(tree.measures))
    state = zones.select("zone_id", *shape, F.explode(F.array(*[F.lit(n).cast("long") for n in tree.top])).alias("at"))
    found = []
    for k, level in enumerate(tree.levels):
        # the first level is at most FAN rows
        t = state.join(F.broadcast(level), F.col("at") == F.col("node")) if k == 0 else state.join(level, F.col("at") == F.col("parent"))
        t = t.filter(~outside)
        found.append(t.filter(~open_).select("zone_id", *[F.when(hit, F.col(f"m{m}")).otherwise(0).alias(f"s{r}_{m}")
                                                            for r, hit in enumerate(inside) for m in measures]))
        state = t.filter(open_).select("zone_id", *shape, F.col("node").alias("at"))
        if k + 1 < len(tree.levels):
            state = cut_lineage(state)
    border = state.withColumnsRenamed({c: f"z_{c}" for c in shape}).join(tree.points, F.col("at") == F.col("leaf"))
    found.append(border.select("zone_id", *[F.when(hit, F.col(f"m{m}")).otherwise(0).cast("long").alias(f"s{r}_{m}")
                                             for r, hit in enumerate(holds) for m in measures]))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.groupBy("zone_id").agg(*[F.sum(f"s{r}_{m}").alias(f"s{r}_{m}") for r in range(len(holds)) for m in measures])


def _named(zones: DataFrame, sums: DataFrame, names: dict[str, str]) -> DataFrame:
    out = zones.select("zone_id").join(sums.select("zone_id", *[F.col(c).alias(n) for c, n in names.items()]), "zone_id", "left")
    return out.fillna(0, subset=list(names.values()))


def counts_in_boxes(zones: DataFrame, tree: CellTree, names: list[str]) -> DataFrame:
    """(zone_id, one count per measure, named ``names``) of the points with lat_bl <= lat <= lat_tr and
    lon_bl <= lon <= lon_tr; 0 without points or without a box."""
    c = F.col
    outside = (c("lolat") > c("lat_tr")) | (c("hilat") < c("lat_bl")) | (c("lolon") > c("lon_tr")) | (c("hilon") < c("lon_bl"))
    inside = (c("lolat") >= c("lat_bl")) & (c("hilat") <= c("lat_tr")) & (c("lolon") >= c("lon_bl")) & (c("hilon") <= c("lon_tr"))
    holds = (c("lat") >= c("z_lat_bl")) & (c("lat") <= c("z_lat_tr")) & (c("lon") >= c("z_lon_bl")) & (c("lon") <= c("z_lon_tr"))
    sums = _counted(zones, ["lat_bl", "lat_tr", "lon_bl", "lon_tr"], tree, outside, [inside], ~inside, [holds])
    return _named(zones, sums, {f"s0_{m}": n for m, n in enumerate(names)})


def counts_in_circles(centres: DataFrame, tree: CellTree, radii_km, names: list[list[str]]) -> DataFrame:
    """(zone_id, one count per radius and measure, named ``names[radius][measure]``) of the points within each
    radius of a centre (lat, lon); 0 if none. Nodes are judged by chords of the unit sphere, so neither the
    date line nor a pole is special; chords within rounding of a radius leave the node open."""
    z = centres.select("zone_id", F.col("lat").cast("double").alias("zlat"), F.col("lon").cast("double").alias("zlon"))
    la, lo = F.radians("zlat"), F.radians("zlon")
    z = z.withColumns({"cx": F.cos(la) * F.cos(lo), "cy": F.cos(la) * F.sin(lo), "cz": F.sin(la)})
    low = high = F.lit(0.0)
    for axis, own in (("_x", "cx"), ("_y", "cy"), ("_z", "cz")):
        a, b, v = F.col(f"lo{axis}"), F.col(f"hi{axis}"), F.col(own)
        near, far = F.greatest(a - v, v - b, F.lit(0.0)), F.greatest(v - a, b - v)
        low, high = low + near * near, high + far * far
    chords = [2 * math.sin(min(r / (2 * EARTH_RADIUS_KM), math.pi / 2)) if r >= 0 else -1.0 for r in radii_km]
    least = [c * (1 - 1e-9) - 1e-14 for c in chords]  # surely inside up to here
    most = [c * (1 + 1e-9) + 1e-14 for c in chords]   # surely outside from here on
    inside = [F.sqrt(high) <= c for c in least]
    open_ = F.lit(False)
    for i, c in zip(inside, most):
        open_ = open_ | (~i & (F.sqrt(low) <= c))
    dist = haversine_km("z_zlat", "z_zlon", "lat", "lon")
    sums = _counted(z, ["zlat", "zlon", "cx", "cy", "cz"], tree, F.sqrt(low) > max(most), inside, open_,
                    [dist <= F.lit(float(r)) for r in radii_km])
    return _named(centres, sums, {f"s{r}_{m}": n for r, row in enumerate(names) for m, n in enumerate(row)})
