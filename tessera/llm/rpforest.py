"""Embedding near-dedup by a forest of random-projection trees with spill overlap.

Identical vectors are one class first, so copies cost one row. Every class goes
down ``TREES`` trees: each level projects on a random direction and splits near
the median; the ``SPILL`` share of vectors around the split goes to both sides.
The upper levels are fitted on a bounded sample (at most ``SAMPLE`` vectors a
tree and round, thresholds only), and every vector is routed through them; a
group that is still larger than ``GROUP`` gets another round. Below that, a task
holds one group and goes on splitting by its exact medians down to ``LEAF``
vectors. A node of which a tenth of the (sampled) pairs are links is not split
further but compared whole, on the upper levels in pairs of parts of ``TARGET``
vectors over several tasks; its comparisons are about ten times its links at
most. A table that is dense as a whole is compared once, without trees. A group
that is a small share of a large table is still cut on its way down.

All pairs of a leaf are compared by the exact double-precision cosine; pairs at
or above the threshold are links, and connected links are components.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component; vectors of different
dimension never link; rows with a null id link with nothing and are not kept;
repeated ids with equal vectors count as separate vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bytes_of, components, written

TREES = 12
SPILL = 0.08
SAMPLE = 16_384
#: Vectors that a task splits further by itself, and that a leaf compares.
GROUP = 20_000
TARGET = 4_000
LEAF = 200
#: Sampled vectors that a node is judged dense by, at least.
DENSE_LEAST = 8
SEED = 11


def _vectors(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vector): packed doubles, null where the vector takes no part."""
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                x = np.array([np.nan if c is None else c for c in v or []], np.float64)
                out.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "vector"])

    return rows.mapInArrow(run, f"id {id_type}, vector binary")


def _unit(column: pa.Array) -> np.ndarray:
    data, offsets = bytes_of(column)
    m = np.frombuffer(data.tobytes(), np.float64).reshape(len(offsets) - 1, -1)
    big = np.abs(m).max(1, keepdims=True)
    m = m / big  # no overflow in the norm
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _direction(tree: int, round_: int, level: int, dim: int) -> np.ndarray:
    d = np.random.default_rng([SEED, tree, round_, level, dim]).standard_normal(dim)
    return d / np.sqrt(d @ d)


def _edges(projected: np.ndarray) -> tuple[float, float]:
    """The spill band around the median: below the upper edge goes left, above the lower edge right."""
    lo, hi = np.quantile(projected, [0.5 - SPILL / 2, 0.5 + SPILL / 2])
    return float(lo), float(hi)


def fit_upper(sample: np.ndarray, tree: int, round_: int, depth: int, threshold: float) -> list[np.ndarray]:
    """Bands of every node of the first ``depth`` levels (level l has 2^l nodes).

    A dense node has the band (inf, inf), and so have the nodes below it: all its vectors go left, none is parted.
    """
    rng = np.random.default_rng([SEED, tree, round_])
    node, at, bands = np.zeros(len(sample), np.int64), np.arange(len(sample)), []
    for level in range(depth):
        projected = sample[at] @ _direction(tree, round_, level, sample.shape[1])
        band = np.zeros((1 << level, 2))
        order = np.argsort(node, kind="stable")
        edges = np.searchsorted(node[order], np.arange((1 << level) + 1))
        for k in range(1 << level):
            mine = order[edges[k]:edges[k + 1]]
            if (level and np.isinf(bands[-1][k // 2, 0])) or (len(mine) >= DENSE_LEAST and _dense(sample[at[mine]], threshold, rng)):
                band[k] = np.inf
            elif len(mine):
                band[k] = _edges(projected[mine])
        bands.append(band)
        left, right = projected <= band[node, 1], projected >= band[node, 0]
        node, at = np.concatenate([2 * node[left], 2 * node[right] + 1]), np.concatenate([at[left], at[right]])
    return bands


def route(unit: np.ndarray, tree: int, round_: int, bands: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every vector in the fitted levels; spilled vectors come more than once."""
    node, at = np.zeros(len(unit), np.int64), np.arange(len(unit))
    for level, band in enumerate(bands):
        projected = (unit @ _direction(tree, round_, level, unit.shape[1]))[at]
        left, right = projected <= band[node, 1], projected >= band[node, 0]
        node, at = np.concatenate([2 * node[left], 2 * node[right] + 1]), np.concatenate([at[left], at[right]])
    return at, node


def near_pairs(unit: np.ndarray, threshold: float, block: int = 2048):
    """All pairs i < j at or above the threshold, by blocks of the product."""
    for a in range(0, len(unit), block):
        for b in range(a, len(unit), block):
            i, j = np.nonzero(unit[a:a + block] @ unit[b:b + block].T >= threshold)
            ok = i + a < j + b
            yield i[ok] + a, j[ok] + b


def _dense(unit: np.ndarray, threshold: float, rng) -> bool:
    """Whether a tenth of the pairs of a small sample are links."""
    some = unit[rng.choice(len(unit), 64, replace=False)] if len(unit) > 64 else unit
    near = (some @ some.T >= threshold).sum() - len(some)
    return near >= 0.1 * len(some) * (len(some) - 1)


def split_and_compare(unit: np.ndarray, threshold: float, seed) -> tuple[np.ndarray, np.ndarray]:
    """Links found in one group by going on splitting it at random."""
    rng = np.random.default_rng(seed)
    todo, found_i, found_j = [np.arange(len(unit))], [], []
    while todo:
        at = todo.pop()
        x = unit[at]
        if len(at) > LEAF and not _dense(x, threshold, rng):
            d = rng.standard_normal(unit.shape[1])
            projected = x @ d
            lo, hi = _edges(projected)
            left, right = projected <= hi, projected >= lo
            if not (left.all() or right.all()):
                todo += [at[left], at[right]]
                continue
        for i, j in near_pairs(x, threshold):
            found_i.append(np.minimum(at[i], at[j]))
            found_j.append(np.maximum(at[i], at[j]))
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.unique(np.concatenate(found_i) * np.int64(len(unit)) + np.concatenate(found_j))
    return key // len(unit), key % len(unit)


def _descend(rows: DataFrame, round_: int, depths: dict[tuple[int, int, int], tuple[int, float]],
             threshold: float) -> tuple[DataFrame, set[tuple[int, int, int]]]:
    """Route the rows of the groups in ``depths`` ((tree, dim, node) -> (levels, sample share)) further
    down. Returns them and the dense nodes, which no round may split."""
    names = ["tree", "dim", "node"]
    spark = rows.sparkSession
    plan = spark.createDataFrame([(*k, share) for k, (_, share) in depths.items()],
                                 "tree int, dim int, node long, share double")
    sample = rows.join(F.broadcast(plan), names).where(  # one row per group: at most TREES x 2^levels of a round
        F.pmod(F.xxhash64("cid", F.lit(round_)), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    schema = "tree int, dim int, node long, bands binary"

    def fit(table: pa.Table) -> pa.Table:
        key = tuple(table.column(c)[0].as_py() for c in names)
        bands = fit_upper(_unit(table.column("vector")), key[0], round_, depths[key][0], threshold)
        return pa.table({c: pa.array([v], t) for c, v, t in zip(names, key, [pa.int32(), pa.int32(), pa.int64()], strict=True)}
                        | {"bands": pa.array([np.concatenate(bands).tobytes()], pa.binary())})

    fitted = sample.select(*names, "vector").groupBy(*names).applyInArrow(fit, schema)
    trees = {}
    for r in fitted.collect():  # thresholds only: 16 bytes a node
        flat = np.frombuffer(r["bands"], np.float64).reshape(-1, 2)
        levels = int(np.log2(len(flat) + 1))
        trees[r["tree"], r["dim"], r["node"]] = [flat[(1 << k) - 1:(1 << (k + 1)) - 1] for k in range(levels)]
    dense = {(t, d, (node << len(bands)) + 2 * int(k)) for (t, d, node), bands in trees.items()
             for k in np.flatnonzero(np.isinf(bands[-1][:, 0]))}
    shared = spark.sparkContext.broadcast(trees)

    def down(batches):
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(keys):
                groups.setdefault(key, []).append(k)
            for key, members in groups.items():
                part = batch.take(pa.array(members))
                if key not in shared.value:
                    yield part
                    continue
                at, leaf = route(_unit(part.column(4)), key[0], round_, shared.value[key])
                part = part.take(pa.array(at))
                node = (np.int64(key[2]) << np.int64(len(shared.value[key]))) + leaf
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(node), part.column(3), part.column(4)],
                                                 ["tree", "dim", "node", "cid", "vector"])

    return rows.mapInArrow(down, "tree int, dim int, node long, cid long, vector binary"), dense


def _dense_table(classes: DataFrame, dim: int, n: int, threshold: float) -> bool:
    """Whether a tenth of the pairs of about 512 vectors of one dimension are links."""
    drawn = F.pmod(F.xxhash64("cid", F.lit("dense")), F.lit(1 << 30)) < int(min(1.0, 512 / n) * (1 << 30))
    some = classes.where(F.col("dim") == dim).where(drawn).select("vector").limit(1024).toArrow()
    if some.num_rows < DENSE_LEAST:
        return False
    unit = _unit(some.column("vector"))
    return (unit @ unit.T >= threshold).sum() - len(unit) >= 0.1 * len(unit) * (len(unit) - 1)


def _compare_parts(rows: DataFrame, whole: dict[tuple[int, int, int], int], threshold: float) -> DataFrame:
    """All links of the nodes in ``whole`` ((tree, dim, node) -> vectors). A task holds two parts of a node."""
    keys = ["tree", "dim", "node"]
    plan = rows.sparkSession.createDataFrame([(*k, -(-n // TARGET)) for k, n in whole.items()],
                                             "tree int, dim int, node long, parts int")
    part = F.pmod(F.xxhash64("cid", F.lit("part")), "parts").cast("int")
    dealt = rows.join(F.broadcast(plan), keys).withColumn("part", part).select(
        *keys, "cid", "vector", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other"))
    dealt = dealt.select(*keys, F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "cid", "vector")

    def compare(table: pa.Table) -> pa.Table:
        cid, unit = table.column("cid").to_numpy(), _unit(table.column("vector"))
        first = table.column("part").to_numpy() == table.column("p")[0].as_py()
        if first.all() or not first.any():
            same = table.column("p")[0].as_py() == table.column("q")[0].as_py()
            found = list(near_pairs(unit, threshold)) if same else []
        else:
            left, right = np.flatnonzero(first), np.flatnonzero(~first)
            found = []
            for a in range(0, len(left), 2048):
                i, j = np.nonzero(unit[left[a:a + 2048]] @ unit[right].T >= threshold)
                found.append((left[a:a + 2048][i], right[j]))
        i, j = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ([], [])))
        return pa.table({"a": pa.array(np.minimum(cid[i], cid[j])), "b": pa.array(np.maximum(cid[i], cid[j]))})

    return dealt.groupBy(*keys, "p", "q").applyInArrow(compare, "a long, b long")


def links(classes: DataFrame, threshold: float = 0.9, trees: int = TREES) -> DataFrame:
    """Distinct pairs (a, b) of class ids found near each other; ``classes`` has cid, dim and vector."""
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    whole = {(0, d, 1): n for d, n in sizes.items() if n > GROUP // 2 and _dense_table(classes, d, n, threshold)}
    once = [d for _, d, _ in whole]
    rows = classes.select(F.explode(F.array(*[F.lit(t) for t in range(trees)])).alias("tree"), "dim",
                          F.lit(1).cast("long").alias("node"), "cid", "vector")
    rows = rows.where((F.col("tree") == 0) | ~F.col("dim").isin(once)) if once else rows
    large = {(t, d, 1): n for d, n in sizes.items() for t in range(trees) if n > GROUP // 2 and d not in once}
    dense = set(whole)
    round_ = 0
    while large:
        depths = {key: (int(np.clip(np.ceil(np.log2(n / TARGET)), 1, 11)), min(1.0, SAMPLE / n)) for key, n in large.items()}
        routed, found_dense = _descend(rows, round_, depths, threshold)
        rows = written(routed, "forest")
        dense |= found_dense
        counts = rows.groupBy("tree", "dim", "node").agg(F.count("*").alias("n"))
        if dense:
            known = rows.sparkSession.createDataFrame(sorted(dense), "tree int, dim int, node long")
            sized = counts.join(F.broadcast(known), ["tree", "dim", "node"])
            whole = {(r["tree"], r["dim"], r["node"]): r["n"] for r in sized.collect()}  # at most 2^levels a group and round
            counts = counts.join(F.broadcast(known), ["tree", "dim", "node"], "left_anti")
        before, large = large, {(r["tree"], r["dim"], r["node"]): r["n"] for r in
                                counts.where(F.col("n") > GROUP).limit(trees << 11).collect()}
        round_ += 1
        if large and max(large.values()) >= max(before.values()):
            whole |= large  # random directions no longer part them
            break
    keys = ["tree", "dim", "node"]

    def compare(table: pa.Table) -> pa.Table:
        cid = table.column("cid").to_numpy()
        key = [table.column(c)[0].as_py() for c in keys]
        i, j = split_and_compare(_unit(table.column("vector")), threshold, [SEED, *key])
        return pa.table({"a": pa.array(np.minimum(cid[i], cid[j])), "b": pa.array(np.maximum(cid[i], cid[j]))})

    split = rows
    if whole:
        known = rows.sparkSession.createDataFrame(sorted(whole), "tree int, dim int, node long")
        split = rows.join(F.broadcast(known), keys, "left_anti")
    found = split.groupBy(*keys).applyInArrow(compare, "a long, b long")
    if whole:
        found = found.unionByName(_compare_parts(rows, whole, threshold))
    return found.where("a < b").distinct()


def near_duplicates(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9,
                    trees: int = TREES) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` and ``kept``."""
    rows = written(_vectors(embeddings, id_col, vec_col), "vectors")
    member = rows.where("vector IS NOT NULL AND id IS NOT NULL")
    classes = member.groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("m"))
    classes = written(classes.select(F.col("least").cast("long").alias("cid"), "m", "vector",
                                     (F.length("vector") / 8).cast("int").alias("dim")), "classes")
    pairs = written(links(classes.select("cid", "dim", "vector"), threshold, trees), "links")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = classes.select(F.col("cid").alias("b"), "m")
    others = both.join(weight, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("m").alias("others"))
    grouped = components(pairs)
    told = classes.join(others, "cid", "left").join(grouped.withColumnRenamed("node", "cid"), "cid", "left")
    told = told.select("vector", (F.col("m") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                       F.coalesce("component", "cid").alias("component_id"))
    alone = rows.where("vector IS NULL OR id IS NULL").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    out = member.join(told, "vector").select("id", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
