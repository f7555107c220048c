"""Registered geo queries: zones x points from the embeddings stand-in (brute-force SQL oracles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.geo import distance_to_point
from tessera.functions.misc import log_root
from tessera.operators import spatial as G
from tessera.operators.clean import tag_filter
from tessera.plans.registry import finish, register
from tessera.sources import standins as S

GEO_SQL = """pts AS (SELECT vec_id AS point_id, 55.75 + embedding[1]::DOUBLE AS lat,
                 37.62 + embedding[2]::DOUBLE AS lon, label FROM embeddings),
rng AS (SELECT min(lat) AS la0, max(lat) AS la1, min(lon) AS lo0, max(lon) AS lo1 FROM pts),
cells AS (SELECT id, CASE WHEN id < 400 THEN id // 20 ELSE 40 + 20 * (id - 400) END AS zi,
    CASE WHEN id < 400 THEN id % 20 ELSE id - 400 END AS zj FROM range(420) t(id)),
zones AS (SELECT id AS zone_id,
    la0 + zi * ((la1 - la0) / 20) AS lat_bl, lo0 + zj * ((lo1 - lo0) / 20) AS lon_bl,
    la0 + (zi + 1) * ((la1 - la0) / 20) AS lat_tr, lo0 + (zj + 1) * ((lo1 - lo0) / 20) AS lon_tr
  FROM cells, rng),
zc AS (SELECT zone_id, (lat_bl + lat_tr) / 2 AS lat, (lon_bl + lon_tr) / 2 AS lon FROM zones)"""


def hav(a1, o1, a2, o2):
    return (f"(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({a2}) - radians({a1})) / 2), 2) + "
            f"cos(radians({a1})) * cos(radians({a2})) * pow(sin((radians({o2}) - radians({o1})) / 2), 2)))))")


#: Zones beyond the range of the points, up to some 30 ranges away.
FAR = 20


def _centres(spark, sf_dir):
    return S.zones(spark, sf_dir, far=FAR).select("zone_id", F.col("lat_c").alias("lat"), F.col("lon_c").alias("lon"))


# Point classes of the stand-in (tag 'label').
CLASS_SPECS = {"lbl3": {"equals": ("label", "3")},
               "not01": {"value_not_in": ("label", ["0", "1"])},
               "low": {"value_in": ("label", ["0", "1", "2"])}}


@register("zone_point_counts", f"""
WITH {GEO_SQL},
j AS (SELECT z.zone_id, p.label FROM zones z JOIN pts p
      ON p.lat >= z.lat_bl AND p.lat <= z.lat_tr AND p.lon >= z.lon_bl AND p.lon <= z.lon_tr)
SELECT z.zone_id, coalesce(count(j.zone_id), 0) AS n_total,
  count(*) FILTER (WHERE j.label = 3) AS n_lbl3,
  count(*) FILTER (WHERE j.label NOT IN (0, 1)) AS n_not01,
  count(*) FILTER (WHERE j.label IN (0, 1, 2)) AS n_low,
  CAST(count(j.zone_id) > 0 AS INTEGER) AS has_point,
  round(CAST(count(*) FILTER (WHERE j.label = 3) AS DOUBLE) / nullif(count(j.zone_id), 0), 6) AS share_lbl3,
  round(CAST(count(*) FILTER (WHERE j.label NOT IN (0, 1)) AS DOUBLE) / nullif(count(j.zone_id), 0), 6) AS share_not01,
  round(CAST(count(*) FILTER (WHERE j.label IN (0, 1, 2)) AS DOUBLE) / nullif(count(j.zone_id), 0), 6) AS share_low
FROM zones z LEFT JOIN j USING (zone_id) GROUP BY z.zone_id""", headline=False)
def q_zone_point_counts(spark, sf_dir):
    z = S.zones(spark, sf_dir, far=FAR)
    p = S.points(spark, sf_dir)
    conds = {n: tag_filter("tags", spec) for n, spec in CLASS_SPECS.items()}
    tree = G.point_tree(p, conds)
    counts = G.zone_attribute_counts(z, tree, conds)
    exists = G.point_in_box_exists(z, tree)
    return finish(counts.join(exists, "zone_id"))


RADII = [0.5, 1.0, 2.0, 5.0]


@register("zone_radius_counts", f"""
WITH {GEO_SQL},
d AS (SELECT zc.zone_id, {hav('zc.lat', 'zc.lon', 'p.lat', 'p.lon')} AS dist FROM zc, pts p)
SELECT zone_id, {", ".join(f"count(*) FILTER (WHERE dist <= {r}) AS n_within_{str(r).replace('.', '_')}" for r in RADII)}
FROM d GROUP BY zone_id""", headline=True)
def q_zone_radius_counts(spark, sf_dir):
    return G.radius_count(_centres(spark, sf_dir), S.points(spark, sf_dir), RADII)


@register("zone_knn_stats", f"""
WITH {GEO_SQL},
d AS (SELECT zc.zone_id, p.point_id, {hav('zc.lat', 'zc.lon', 'p.lat', 'p.lon')} AS dist FROM zc, pts p),
r AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY dist, point_id) AS rk FROM d)
SELECT zone_id, round(min(dist), 6) AS knn_min,
  {", ".join(f"round(avg(dist) FILTER (WHERE rk <= {k}), 6) AS knn{k}_mean, round(max(dist) FILTER (WHERE rk <= {k}), 6) AS knn{k}_max, round(stddev_pop(dist) FILTER (WHERE rk <= {k}), 6) AS knn{k}_std" for k in (3, 5, 10))}
FROM r WHERE rk <= 10 GROUP BY zone_id""", headline=True)
def q_zone_knn_stats(spark, sf_dir):
    return finish(G.knn_stats(_centres(spark, sf_dir), S.points(spark, sf_dir), (3, 5, 10)))


@register("zone_near_class", f"""
WITH {GEO_SQL}
SELECT zc.zone_id, CAST(EXISTS (SELECT 1 FROM pts p WHERE p.label = 3 AND
   {hav('zc.lat', 'zc.lon', 'p.lat', 'p.lon')} <= 0.55) AS INTEGER) AS near_any FROM zc""")
def q_zone_near_class(spark, sf_dir):
    p = S.points(spark, sf_dir)
    p3 = p.filter(tag_filter("tags", CLASS_SPECS["lbl3"])).select("point_id", "lat", "lon")
    return G.within_distance_of_any(_centres(spark, sf_dir), p3, 0.55)


@register("zone_centre_distance", f"""
WITH {GEO_SQL}
SELECT zone_id, round({hav('lat', 'lon', '55.75', '37.62')}, 6) AS dist_centre,
  round(sqrt(ln(1 + {hav('lat', 'lon', '55.75', '37.62')})), 6) AS dist_log_root
FROM zc""")
def q_zone_centre_distance(spark, sf_dir):
    c = _centres(spark, sf_dir)
    d = distance_to_point("lat", "lon", S.POINT_LAT0, S.POINT_LON0)
    return finish(c.select("zone_id", d.alias("dist_centre"), log_root(d).alias("dist_log_root")))


CLASSES = list(range(10))  # every label of the points


@register("zone_class_counts", f"""
WITH {GEO_SQL},
d AS (SELECT zc.zone_id, p.label, {hav('zc.lat', 'zc.lon', 'p.lat', 'p.lon')} AS dist FROM zc, pts p)
SELECT zone_id, {", ".join(f"count(*) FILTER (WHERE label = {c} AND dist <= {r}) AS n_within_{c}_{str(r).replace('.', '_')}" for r in (1.0, 5.0) for c in CLASSES)}
FROM d GROUP BY zone_id""")
def q_zone_class_counts(spark, sf_dir):
    """All point classes of a zone in one pass over one point table."""
    return G.radius_count(_centres(spark, sf_dir), S.points(spark, sf_dir), [1.0, 5.0], class_col="label", classes=CLASSES)


@register("zone_class_knn", f"""
WITH {GEO_SQL},
d AS (SELECT zc.zone_id, p.label, p.point_id, {hav('zc.lat', 'zc.lon', 'p.lat', 'p.lon')} AS dist FROM zc, pts p),
r AS (SELECT *, row_number() OVER (PARTITION BY zone_id, label ORDER BY dist, point_id) AS rk FROM d)
SELECT zone_id, label, round(min(dist), 6) AS knn_min,
  {", ".join(f"round(avg(dist) FILTER (WHERE rk <= {k}), 6) AS knn{k}_mean, round(max(dist) FILTER (WHERE rk <= {k}), 6) AS knn{k}_max, round(stddev_pop(dist) FILTER (WHERE rk <= {k}), 6) AS knn{k}_std" for k in (3, 5))}
FROM r WHERE rk <= 5 GROUP BY zone_id, label""")
def q_zone_class_knn(spark, sf_dir):
    """Nearest-neighbour statistics of every point class in one pass."""
    return finish(G.knn_stats(_centres(spark, sf_dir), S.points(spark, sf_dir), (3, 5), class_col="label", classes=CLASSES))


@register("zone_box_counts", f"""
WITH {GEO_SQL}
SELECT z.zone_id, count(p.point_id) AS n_points FROM zones z LEFT JOIN pts p
  ON p.lat >= z.lat_bl AND p.lat <= z.lat_tr AND p.lon >= z.lon_bl AND p.lon <= z.lon_tr GROUP BY z.zone_id""")
def q_zone_box_counts(spark, sf_dir):
    return G.point_in_box_count(S.zones(spark, sf_dir, far=FAR), S.points(spark, sf_dir))
