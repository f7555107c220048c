"""Exact top-k inner products by norm buckets.

Candidates are sorted by length (Euclidean norm) and cut into buckets of at most
``BUCKET`` vectors. The queries, in blocks, first take their k best products from
the longest bucket; the k-th of them is a threshold that no later product below
it can beat. A bucket whose longest vector cannot reach a query block's smallest
need is never joined with it. Inside a bucket the threshold divided by both
lengths is a local cosine threshold, which chooses the pruning per query (Teflioudi
et al., 2015):

* high cosine: coordinate pruning, each of the query's FOCUS largest coordinates
  bounds the candidate's coordinate;
* otherwise: length pruning, a prefix of the bucket, multiplied as a block.

What is left is verified with the integer product, so the result is exact.

Defined results: vectors that are null, empty, or hold null or non-finite
components, and rows with a null id, take no part; vectors meet only vectors of
their own dimension; a candidate with the query's own id is left out; a repeated
query id asks once (its smallest vector); repeated candidate rows each count;
ties go to the smaller id; fewer than k candidates are all returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.blocks import rows_of
from tessera.llm.common import written

BUCKET = 4096
QUERY_BLOCK = 256
#: Coordinates that coordinate pruning looks at, and the cosine from which it is chosen.
FOCUS = 4
HIGH_COSINE = 0.8
SCALE = 256
_PACK = "bucket long, dim int, hi double, lo double, n int, ids binary, vectors binary"
_EXACT = float(2**53)


def integers(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Valid rows as (vec_id, dim, norm, vector): components floor(scale * x) as packed 64-bit integers."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            lens = column.value_lengths().to_numpy(zero_copy_only=False)
            flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
            ends = np.cumsum(lens)
            good = np.logical_and.reduceat(np.isfinite(flat), ends - lens) if len(lens) else np.zeros(0, bool)
            value = np.floor(np.where(np.isfinite(flat), flat, 0) * scale)
            if np.abs(value).max(initial=0) >= 2.0**62:
                raise ValueError("components beyond 2^62 / scale have no 64-bit product")
            norm = np.sqrt(np.add.reduceat(value * value, ends - lens)) if len(lens) else np.zeros(0)
            whole = value.astype("<i8")
            keep = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), pa.array(lens[keep].astype(np.int32)), pa.array(norm[keep]),
                 pa.array([whole[e - n:e].tobytes() for e, n in zip(ends[keep], lens[keep], strict=True)], pa.binary())],
                ["vec_id", "dim", "norm", "vector"])

    return rows.mapInArrow(run, "vec_id long, dim int, norm double, vector binary")


def _pack(size: int):
    """Rows sorted by (dim, length) as blocks of at most ``size`` vectors of one dimension."""
    def run(batches):
        part, n, held = TaskContext.get().partitionId() << 32, 0, []

        def flush(rows):
            nonlocal n
            dim, norms = rows[0][1], np.array([r[2] for r in rows])
            n += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part + n]), pa.array([dim], pa.int32()), pa.array([norms.max()]), pa.array([norms.min()]),
                 pa.array([len(rows)], pa.int32()), pa.array([np.array([r[0] for r in rows], "<i8").tobytes()], pa.binary()),
                 pa.array([b"".join(r[3] for r in rows)], pa.binary())], ["bucket", "dim", "hi", "lo", "n", "ids", "vectors"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (len(held) == size or held[0][1] != row[1]):
                    yield flush(held)
                    held = []
                held.append(row)
        if held:
            yield flush(held)
    return run


def packed(vectors: DataFrame, size: int) -> DataFrame:
    order = ["dim", F.col("norm").desc(), "vec_id", "vector"]
    return vectors.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack(size), _PACK)


def _matrix(row: dict, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(row[prefix + "ids"], "<i8"),
            np.frombuffer(row[prefix + "vectors"], "<i8").reshape(-1, row["dim"]))


def _products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Integer products of all rows of q and p; the fast float product while it is exact."""
    qf, pf = q.astype(np.float64), p.astype(np.float64)
    if np.sqrt((qf * qf).sum(1).max(initial=0) * (pf * pf).sum(1).max(initial=0)) * 1.01 < _EXACT:
        return (qf @ pf.T).astype(np.int64)
    return q @ p.T


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query (score, then smaller id) that reach ``least``."""
    ok = np.flatnonzero((scores >= least) & (ids != own))
    if len(ok) > k:
        cut = np.partition(scores[ok], len(ok) - k)[len(ok) - k]
        ok = ok[scores[ok] >= cut]
    ok = ok[np.lexsort((ids[ok], -scores[ok]))][:k]
    return scores[ok], ids[ok]


def bucket_scores(qids, q, qnorm, need, ids, p, pnorm, k: int):
    """Per query its best products in one bucket (rows by falling length), by the chosen pruning."""
    top = pnorm[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(qnorm * top > 0, need / (qnorm * top), -np.inf)
    alive = np.flatnonzero(~(cosine > 1 + 1e-9) | (need <= 0))
    high = alive[(cosine[alive] >= HIGH_COSINE)]
    low = np.setdiff1d(alive, high)
    if len(low):
        # length pruning: |p| >= need / |q|, a prefix of the bucket
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where((qnorm[low] > 0) & (need[low] > 0), need[low] / qnorm[low] * (1 - 1e-9), -np.inf)
        prefix = np.searchsorted(-pnorm, -reach, side="right")
        products = _products(q[low], p[:prefix.max(initial=0)])
        for j, i in enumerate(low.tolist()):
            yield i, *_best(products[j, :prefix[j]], ids[:prefix[j]], int(qids[i]), k, need[i])
    if len(high):
        unit = p / np.maximum(pnorm, 1e-300)[:, None]
        for i in high.tolist():
            # coordinate pruning: cos >= t bounds each coordinate of the unit candidate
            t = min(1.0, need[i] / (qnorm[i] * top) * (1 - 1e-9))
            qu = q[i] / qnorm[i]
            ok = np.ones(len(p), bool)
            for f in np.argsort(-np.abs(qu))[:FOCUS].tolist():
                slack = np.sqrt(max(0.0, (1 - t * t) * (1 - qu[f] * qu[f]))) + 1e-9
                if qu[f] > -t:  # the cone around the query misses the pole at -1
                    ok &= unit[:, f] >= qu[f] * t - slack
                if qu[f] < t:  # and the one at 1
                    ok &= unit[:, f] <= qu[f] * t + slack
            ok = np.flatnonzero(ok)
            yield i, *_best(_products(q[i:i + 1], p[ok])[0], ids[ok], int(qids[i]), k, need[i])


def _norms(m: np.ndarray) -> np.ndarray:
    m = m.astype(np.float64)
    return np.sqrt((m * m).sum(1))


def _seed(k: int):
    """Each query's k-th best product in the longest bucket of its dimension."""
    def run(batches):
        for row in rows_of(batches):
            qids, q = _matrix(row)
            ids, p = _matrix(row, "seed_")
            products = _products(q, p)
            need = np.full(len(qids), -np.inf)
            for i in range(len(qids)):
                found, _ = _best(products[i], ids, int(qids[i]), k, -np.inf)
                if len(found) == k:
                    need[i] = found[-1]
            qnorm = _norms(q)
            # the shortest candidate that could matter to any query of the block
            reach = np.where((need > 0) & (qnorm > 0), need / np.maximum(qnorm, 1e-300) * (1 - 1e-9), 0.0).min()
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["bucket"]]), pa.array([row["dim"]], pa.int32()), pa.array([row["ids"]], pa.binary()),
                 pa.array([row["vectors"]], pa.binary()), pa.array([need.tobytes()], pa.binary()), pa.array([reach])],
                ["block", "dim", "ids", "vectors", "need", "reach"])
    return run


def _search(k: int):
    def run(batches):
        for row in rows_of(batches):
            qids, q = _matrix(row)
            ids, p = _matrix(row, "bucket_")
            need = np.frombuffer(row["need"])
            out = [(np.full(len(found), qids[i]), names, found) for i, found, names in
                   bucket_scores(qids, q, _norms(q), need, ids, p, _norms(p), k)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                                                 ["query_id", "vec_id", "score"])
    return run


def search(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) from two tables made by ``integers``."""
    buckets = written(packed(candidates, BUCKET), "buckets")
    asked = queries.groupBy("vec_id").agg(F.min_by(F.struct("dim", "norm", "vector"), F.struct("dim", "vector")).alias("q"))
    asked = packed(asked.select("vec_id", "q.dim", "q.norm", "q.vector"), QUERY_BLOCK)
    longest = buckets.groupBy("dim").agg(F.max_by("bucket", F.struct("hi", F.col("n"), F.col("bucket"))).alias("bucket"))
    seed = buckets.join(longest.drop("dim"), "bucket", "left_semi")
    seed = seed.select("dim", F.col("ids").alias("seed_ids"), F.col("vectors").alias("seed_vectors"))
    blocks = written(asked.join(seed, "dim").mapInArrow(
        _seed(k), "block long, dim int, ids binary, vectors binary, need binary, reach double"), "queries")
    # which blocks meet, decided on lengths alone
    meet = blocks.select("block", "dim", "reach").join(buckets.select("bucket", "dim", "hi"), "dim").where("hi >= reach")
    work = meet.select("block", "bucket").join(blocks, "block").join(
        buckets.select("bucket", F.col("ids").alias("bucket_ids"), F.col("vectors").alias("bucket_vectors")), "bucket")
    found = work.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
