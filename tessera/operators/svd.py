"""Truncated SVD of a large sparse matrix by a randomised range finder.

The matrix comes as entries (row, column, value), is cut into blocks of a bounded number of entries and written
once. A product with a tall table of vectors joins each block with the vectors of its own rows or columns only;
what blocks share is added up by a map-side aggregation, so a row or column that is everywhere costs one vector
a block. A block holds whole rows, so it goes through matrix and transpose at once; rows longer than a block are
cut, and take the two products one after the other. Blocks are dealt once and stay there: a step moves vectors
only. What a step wrote and no later one reads is deleted at once, so steps do not add up on disk. Tall tables (row or column id, ``width`` numbers) stay distributed, on both sides of the matrix; they are
made orthonormal through the R of a QR factorisation whose partition factors are merged sixteen at a time, so at
most sixteen times ``width`` x ``width`` numbers reach the driver.

Starting from random vectors, the range is multiplied by the matrix and its transpose until the leading singular
values have settled. Between two orthonormal bases it goes through a Chebyshev polynomial of matrix and transpose
that holds down what lies below the last value of the range, so a slowly falling spectrum takes few passes.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage, forget, outlive, scratch, settings

__all__ = ["truncated_svd", "tall_r"]

FAN_IN = 16
EXTRA = 16  # vectors beyond k
BLOCK_CELLS = 1 << 27  # entries of a block times width: the more a block holds, the fewer blocks share a column
COLUMNS_A_TASK = 1 << 18  # vectors of a task
HALVED = 1 << 28  # bytes of the vectors that blocks get: beyond, the polynomial takes half of the directions at a time
CHUNK = 1 << 14  # entries multiplied at once
SETTLED, MAX_PASSES = 1e-6, 30  # relative change of a squared singular value; each pass gains several digits
DEGREE, SPREAD = 8, 1e10  # of the polynomial: highest degree, and how far it may pull the range's directions apart
LOST = 1e-12  # relative singular values below this are rounding
ILL = 1e-3


def _blocks(long: DataFrame, row_key: str, col_idx: str, value: str, size: int) -> DataFrame:
    """blk, the block's distinct rows and cols, and its entries as positions in those. A block is ``whole`` if it has
    every entry of its rows; only rows of more than ``size`` entries are cut into several blocks, of one row each."""
    v = F.col(value).cast("double")
    entries = long.select(F.col(row_key).alias("row"), F.col(col_idx).alias("col"),
                          F.when(F.abs(v) < float("inf"), v).otherwise(0.0).alias("v"))
    entries = entries.where("row IS NOT NULL AND col IS NOT NULL")
    types = {f.name: f.dataType.simpleString() for f in entries.schema.fields}

    def cut(batches):
        part, made = TaskContext.get().partitionId(), 0

        def block(some: pa.Table, whole: bool) -> pa.RecordBatch:
            nonlocal made
            made += 1
            rows, cols = (some.column(c).combine_chunks().dictionary_encode() for c in ("row", "col"))
            columns = [rows.dictionary, cols.dictionary, rows.indices.cast(pa.int32()), cols.indices.cast(pa.int32()),
                       some.column("v").combine_chunks()]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made - 1], pa.int64()), pa.array([whole]),
                 *(pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns)],
                names=["blk", "whole", "rows", "cols", "r", "c", "v"])

        held, n, cutting = [], 0, None  # cutting: the row of which a piece is written
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                n += batch.num_rows
            while n > size or (batch is None and n):
                some = pa.Table.from_batches(held)
                row = some.column("row").combine_chunks().dictionary_encode()
                last = np.flatnonzero(np.diff(row.indices.to_numpy())) + 1  # where rows begin
                if row.dictionary[0].as_py() == cutting:
                    end, whole = min(size, int(last[0]) if len(last) else n), False
                else:
                    ends = last if batch is not None else np.append(last, n)
                    ends = ends[ends <= size]
                    end, whole = (int(ends[-1]), True) if len(ends) else (size, False)
                    cutting = None if whole else row.dictionary[0].as_py()
                yield block(some.slice(0, end), whole)
                held, n = some.slice(end).to_batches(), n - end

    return cut_lineage(entries.repartition("row").sortWithinPartitions("row", "col").mapInArrow(
        cut, f"blk long, whole boolean, rows array<{types['row']}>, cols array<{types['col']}>, r array<int>, c array<int>, v array<double>"))


def _routes(blocks: DataFrame, ids: str) -> DataFrame:
    """Which block (``of``) needs which id's vector, and where."""
    return blocks.select(F.col("blk").alias("of"), F.posexplode(ids).alias("pos", "id"))


def _entries(block: pa.Table) -> tuple:
    """Rows, columns (positions) and values of a block's entries."""
    return tuple(block[n].combine_chunks().flatten().to_numpy(zero_copy_only=False) for n in ("r", "c", "v"))


def _placed(vectors: pa.Table, n: int, width: int) -> np.ndarray:
    """The vectors of a block's ids in their places; 0 where there is none."""
    x = np.zeros((n, width))
    if vectors.num_rows:
        x[vectors["pos"].to_numpy()] = vectors["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x


def _added(to: np.ndarray, of: np.ndarray, v: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Sums of v * x[of] by ``to``, some entries at a time."""
    if len(to) and (to[1:] < to[:-1]).any():
        order = np.argsort(to, kind="stable")
        to, of, v = to[order], of[order], v[order]
    y = np.zeros((n, x.shape[1]))
    for a in range(0, len(v), CHUNK):
        t = to[a:a + CHUNK]
        starts = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1])
        y[t[starts]] += np.add.reduceat(v[a:a + CHUNK, None] * x[of[a:a + CHUNK]], starts, axis=0)
    return y


def _tall_batch(ids: pa.Array, y: np.ndarray) -> pa.Table:
    offsets = pa.array(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32))
    return pa.table({"id": ids, "vec": pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))})


def _sums(partial: DataFrame, width: int, plus=()) -> DataFrame:
    """Vectors of one id added up, plus tall tables (of no other ids) times their factors, which stay where they are
    if they were made by this."""
    sums = partial.groupBy("id").agg(*[F.sum(F.col("vec")[j]).alias(f"s{j}") for j in range(width)])
    out = sums.select("id", F.array(*[f"s{j}" for j in range(width)]).alias("vec"))
    for more, factor in plus:
        out = out.join(more.select("id", F.col("vec").alias("_more")), "id", "left").select(
            "id", F.when(F.col("_more").isNull(), F.col("vec")).otherwise(F.array(
                *[F.col("vec")[j] + factor * F.col("_more")[j] for j in range(width)])).alias("vec"))
    return out


def _parts(blocks: DataFrame, tall: DataFrame, width: int, transposed: bool = False, scale: float = 1.0, routes=None) -> DataFrame:
    """What each block adds to the product of the matrix (or its transpose) and the tall table."""
    ids, others = ("rows", "cols") if transposed else ("cols", "rows")
    id_type = blocks.schema[others].dataType.elementType.simpleString()
    got = (routes or _routes(blocks, ids)).join(tall, "id").select("of", "pos", "vec")

    def multiply(block: pa.Table, vectors: pa.Table) -> pa.Table:
        r, c, v = _entries(block)
        mine, other = (r, c) if transposed else (c, r)
        out_ids = block[others].combine_chunks().flatten()
        return _tall_batch(out_ids, scale * _added(other, mine, v, _placed(vectors, int(mine.max()) + 1, width), len(out_ids)))

    return blocks.groupBy("blk").cogroup(got.groupBy("of")).applyInArrow(multiply, f"id {id_type}, vec array<double>")


def _product(blocks: DataFrame, tall: DataFrame, width: int, transposed: bool = False, routes=None) -> DataFrame:
    """Matrix (or its transpose) times the tall table (id, vec); again a tall table."""
    return _sums(_parts(blocks, tall, width, transposed, routes=routes), width)


def _there_and_back(blocks: DataFrame, routes: DataFrame, pieces: bool, tall: DataFrame, width: int, scale: float = 1.0, plus=()) -> DataFrame:
    """Transpose times matrix times the tall table, times ``scale``, plus tall tables times their factors. A whole
    block goes both ways at once, as its rows need nothing of other blocks; ``pieces`` says whether there are others."""
    id_type = blocks.schema["cols"].dataType.elementType.simpleString()
    got = routes.join(tall, "id").select("of", "pos", "vec")

    def both(block: pa.Table, vectors: pa.Table) -> pa.Table:
        r, c, v = _entries(block)
        ids = block["cols"].combine_chunks().flatten()
        y = _added(r, c, v, _placed(vectors, len(ids), width), int(r.max()) + 1)
        return _tall_batch(ids, scale * _added(c, r, v, y, len(ids)))

    if not pieces:
        partial = blocks.groupBy("blk").cogroup(got.groupBy("of")).applyInArrow(both, f"id {id_type}, vec array<double>")
    else:
        whole, cut = blocks.where("whole"), blocks.where("NOT whole")
        got = got.join(whole.select(F.col("blk").alias("of")), "of", "left_semi")
        partial = whole.groupBy("blk").cogroup(got.groupBy("of")).applyInArrow(both, f"id {id_type}, vec array<double>")
        left = cut_lineage(_product(cut, tall, width))
        partial = partial.unionByName(_parts(cut, left, width, True, scale))
    return _sums(partial, width, plus)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def tall_r(tall: DataFrame, width: int) -> np.ndarray:
    """R (width x width) of the QR factorisation of a tall table's ``vec``: a factor per partition, merged in a tree."""
    schema = "part long, r array<double>"

    def factor(batches):
        r = np.zeros((0, width))
        for batch in batches:
            r = np.linalg.qr(np.vstack([r, _matrix(batch, width)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              pa.array([r.ravel()], pa.list_(pa.float64()))], names=["part", "r"])

    def merge(group: pa.Table) -> pa.Table:
        stack = group["r"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return pa.table({"part": pa.array([group["part"][0].as_py() // FAN_IN], pa.int64()),
                         "r": pa.array([np.linalg.qr(stack, mode="r").ravel()], pa.list_(pa.float64()))})

    parts = tall.rdd.getNumPartitions()
    factors = tall.select("vec").mapInArrow(factor, schema)
    while parts > FAN_IN:
        factors = factors.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(merge, schema)
        parts = -(-parts // FAN_IN)
    rows = [np.array(f.r).reshape(-1, width) for f in factors.collect()]  # at most sixteen
    return np.linalg.qr(np.vstack(rows), mode="r") if rows else np.zeros((0, width))


def _times_small(tall: DataFrame, small: np.ndarray) -> DataFrame:
    """Every vector of the tall table times a small matrix."""
    width, out = small.shape
    id_type = tall.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            y = _matrix(batch, width) @ small
            offsets = pa.array(np.arange(0, y.size + 1, out, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(y.ravel()))],
                                             names=["id", "vec"])

    return tall.select("id", "vec").mapInArrow(run, f"id {id_type}, vec array<double>")


def _turned(tall: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the tall table and the rotation that sorts its directions by them; lost ones left out."""
    _, s, turn = np.linalg.svd(tall_r(tall, width), full_matrices=False)
    keep = s > LOST * s[0] if len(s) else s > 0
    return s[keep], turn[keep].T


def _orthonormal(tall: DataFrame, width: int) -> tuple[DataFrame, int]:
    """An orthonormal basis of the table's columns; a second time where the first was ill-conditioned."""
    while True:
        s, turn = _turned(tall, width)
        if not len(s):
            return tall, 0
        tall, width = _times_small(tall, turn / s), len(s)
        if s[-1] > ILL * s[0]:
            return tall, width


def _degree(s: np.ndarray) -> int:
    return min(DEGREE, int(np.arccosh(SPREAD) / max(np.arccosh(max(2 * (s[0] / s[-1]) ** 2 - 1, 1.0)), 1e-6)))


def _filtered(step, right: DataFrame, s: np.ndarray, degree: int, bound: float) -> tuple[DataFrame, DataFrame]:
    """The Chebyshev polynomial of (transpose times matrix) that is at most 1 up to ``bound``, applied to
    ``right``, whose directions belong to ``s``; each direction scaled back. ``step(tall, width, scale, plus)`` is
    ``_there_and_back`` of the matrix. Also the written table that the result is made of; ``right`` and the others
    are deleted."""
    width = len(s)
    before, now = right, cut_lineage(step(right, width, 2.0 / bound, [(right, -1.0)]))
    for _ in range(degree - 1):
        after = cut_lineage(step(now, width, 4.0 / bound, [(now, -2.0), (before, -1.0)]))
        forget(before)
        before, now = now, after
    forget(before)
    grown = np.cosh(degree * np.arccosh(2 * s ** 2 / bound - 1))
    return _times_small(now, np.diag(1 / grown)), now


def _dealt(table: DataFrame, key: str, tasks: int) -> DataFrame:
    """A written table dealt by a key into tasks that a later step knows of: it meets others without moving again.
    Only without adaptive execution, which forgets where rows are."""
    out = cut_lineage(table.repartition(tasks, key).sortWithinPartitions(key))
    forget(table)
    return out


def truncated_svd(long: DataFrame, row_key: str, col_idx: str, value: str, k: int, prefix: str = "svd_", spent=()) -> DataFrame:
    """Rank-k projection U * S of a sparse matrix given in long form (row, column, value).

    Rows are keyed (no positional alignment); components fall by singular value and are defined up to sign.
    Entries of the same place add up; a null or non-finite value counts as 0; entries with a null row or column
    take no part; every other row comes back, once. Always ``k`` components: those beyond the rank are 0.
    ``spent``: written tables of an open ``scratch`` that only ``long`` reads, deleted once the matrix is written.
    """
    spark = long.sparkSession
    with scratch(spark):
        blocks = _blocks(long, row_key, col_idx, value, max(1, BLOCK_CELLS // (k + EXTRA)))
        forget(*spent)
        sizes = blocks.select(F.size("cols").alias("n"), "whole").groupBy().agg(
            F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("cols"), F.min("whole").alias("whole")).first()
        tasks = max(spark.sparkContext.defaultParallelism, -(-(sizes.cols or 0) // COLUMNS_A_TASK))
        with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=tasks):
            # the matrix stays where it is from here on, three tasks a block, so that few get two
            blocks = _dealt(blocks, "blk", max(tasks, 3 * sizes.blocks))
            left, small = _projection(blocks, tasks, sizes.whole is False, (sizes.cols or 0) * (k + EXTRA) * 8 > HALVED, k)
            if left is None:  # no entries
                outlive(blocks, every=True)
            else:
                outlive(left, every=True)
    if left is None:
        return blocks.select(F.explode("rows").alias(row_key)).distinct().select(
            row_key, *[F.lit(0.0).alias(f"{prefix}{j}") for j in range(k)])
    return _times_small(left, small).select(F.col("id").alias(row_key), *[F.col("vec")[j].alias(f"{prefix}{j}") for j in range(k)])


def _projection(blocks: DataFrame, tasks: int, pieces: bool, halved: bool, k: int) -> tuple[DataFrame | None, np.ndarray | None]:
    """Matrix times an orthonormal range, and the small matrix that turns it into U * S; None without a range."""
    width = k + EXTRA
    unit = lambda j: F.pmod(F.xxhash64(F.lit("range"), "id", j), F.lit(1 << 52)) / float(1 << 51) - 1.0
    routes = cut_lineage(_routes(blocks, "cols").repartition(tasks, "id").sortWithinPartitions("id"))
    right = routes.select("id").distinct().withColumn(
        "vec", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), unit))
    under = cut_lineage(right)  # the written table that ``right`` is made of
    right, whole = under, under.count() <= width  # the range is the whole space: one product is exact
    if whole:
        right, width = _orthonormal(right, width)
    before = left = None
    for done in range(MAX_PASSES if width else 0):
        left = cut_lineage(_product(blocks, right, width, routes=routes))
        s, turn = _turned(left, width)
        if whole or not len(s) or done + 1 == MAX_PASSES:
            break
        if before is not None and len(before) == len(s[:k]) and (np.abs(s[:k] ** 2 - before ** 2) <= SETTLED * s[:k] ** 2).all():
            break
        degree = _degree(s) if before is not None and len(s) == width else 0
        before = s[:k]
        if degree > 1:
            forget(left)
            step = functools.partial(_there_and_back, blocks, routes, pieces)
            tables = []
            for own in np.array_split(np.arange(len(s)), 1 + halved):  # every direction goes through it on its own
                tables.append(_filtered(step, cut_lineage(_times_small(right, turn[:, own])), s[own], degree, s[-1] ** 2))
            forget(under)
            right, under = tables[0]
            if halved:
                both = right.join(tables[1][0].select("id", F.col("vec").alias("_more")), "id")
                under = cut_lineage(both.select("id", F.concat("vec", "_more").alias("vec")))
                forget(*[now for _, now in tables])
                right = under
            right, width = _orthonormal(right, width)
        else:
            basis, rank = _orthonormal(left, width)
            forget(under)
            under = cut_lineage(_product(blocks, basis, rank, transposed=True))
            forget(left)
            right, width = _orthonormal(under, rank)
    if not width:
        return None, None
    small = np.zeros((width, k))
    small[:, :len(s[:k])] = turn[:, :k]
    return left, small
