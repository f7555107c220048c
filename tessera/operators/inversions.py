"""Weighted inversions of two orders, counted digit by digit (used by A33).

Rows get their place in the order (a, b) and a code, their place in the order
(b, a). Both are permutations of 0..n-1, and two rows are discordant (a rises, b
falls) exactly when the later place has the smaller code: rows equal in a or in b
keep their order in both. The highest digit in which two codes differ tells them
apart, so the count is the sum over the nodes of a tree on the codes' digits:

* a node's rows, in order of place, are cut into blocks of ``leaf`` rows;
* the digit counts of the blocks before a block (``2 ** digit_bits`` numbers, a
  window over blocks) give the pairs with an earlier block, a small numpy merge
  the pairs inside the block;
* the number of earlier rows of the same digit is a row's place in the child.

A node of at most ``leaf`` codes is finished in one group. Places and codes are
dense, so no group ever holds more than ``leaf`` rows, whatever the values are: a
value that a third of all rows share is as many codes as it has distinct pairs.
A level shuffles every row once; a billion pairs take two levels and the leaves.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranks import row_number_global
from tessera.session import cut_lineage

__all__ = ["weighted_inversions", "discordant_weight", "LEAF", "DIGIT_BITS"]

LEAF = 1 << 17
DIGIT_BITS = 8
_COUNT = "decimal(38,0)"


def _exact(w: np.ndarray) -> np.ndarray:
    """Weights whose products can leave 64 bits become Python integers."""
    w = np.asarray(w, dtype=np.int64)
    return w.astype(object) if float(w.sum(dtype=np.float64)) ** 2 >= 2.0**62 else w


def weighted_inversions(b: np.ndarray, w: np.ndarray) -> int:
    """sum of w_i * w_j over i < j with b_i > b_j, for a sequence already in order.

    Bottom-up merge: at block size s, every element of a right block looks up, by
    binary search, the weight of larger values in its left neighbour block. All
    block pairs of a level are searched in one vectorised call (keys are offset by
    the pair index). O(m log^2 m), numpy only."""
    n = len(b)
    if n < 2:
        return 0
    _, vals = np.unique(b, return_inverse=True)
    vals = vals.astype(np.int64)
    ws = _exact(w)
    m = int(vals.max()) + 1
    idx = np.arange(n, dtype=np.int64)
    total = 0
    s = 1
    while s < n:
        blk = idx // s
        pair = blk // 2
        right = (blk % 2) == 1
        if right.any():
            kl = pair[~right] * m + vals[~right]
            cw = np.concatenate([[0], np.cumsum(ws[~right])])
            kr = pair[right] * m + vals[right]
            upto = np.searchsorted(kl, kr, side="right")
            end = np.searchsorted(kl, pair[right] * m + (m - 1), side="right")
            above = cw[end] - cw[upto]
            total += int(np.dot(above, ws[right]))
        perm = np.lexsort((vals, pair))
        vals, ws = vals[perm], ws[perm]
        s *= 2
    return total


def _bounded(rows: pd.DataFrame, leaf: int) -> pd.DataFrame:
    if len(rows) > leaf:
        raise RuntimeError(f"{len(rows)} rows in a group of at most {leaf}")
    return rows.sort_values("at")


def _descend(t: DataFrame, shift: int, step: int, leaf: int) -> DataFrame:
    """One level: count the pairs told apart by ``step`` bits from ``shift`` on, move rows to the children."""
    fan = 1 << step
    t = t.withColumn("block", F.expr(f"at div {leaf}"))
    digit = F.shiftright("code", shift).bitwiseAND(fan - 1)
    held = t.groupBy("node", "block", digit.alias("digit")).agg(F.count(F.lit(1)).alias("rows"), F.sum("w").alias("weight"))
    blocks = held.select("node", "block").distinct().select(
        "node", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(fan - 1).cast("long"))).alias("digit"),
        F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("weight"))
    grid = held.unionByName(blocks).groupBy("node", "block", "digit").agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weight"))
    earlier = Window.partitionBy("node", "digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = grid.select("node", "block", F.struct(
        "digit", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("weight").over(earlier), F.lit(0)).alias("weight")).alias("s"))
    before = before.groupBy("node", "block").agg(F.sort_array(F.collect_list("s")).alias("s")).select(
        "node", "block", F.col("s.rows").alias("rows"), F.col("s.weight").alias("weight"))

    def count(rows: pd.DataFrame, offsets: pd.DataFrame) -> pd.DataFrame:
        rows = _bounded(rows, leaf)
        code = rows["code"].to_numpy()
        digits = (code >> shift) & (fan - 1)
        weight = rows["w"].to_numpy()
        passed = np.array([int(x) for x in offsets["weight"].iloc[0]], dtype=object)
        higher = np.append(np.cumsum(passed[::-1])[::-1][1:], 0)
        own = np.zeros(fan, dtype=object)
        np.add.at(own, digits, weight.astype(object))
        found = sum(rows["d"], Decimal(0)) + int(np.dot(own, higher)) + weighted_inversions(digits, weight)
        order = np.argsort(digits, kind="stable")
        start = np.searchsorted(digits[order], np.arange(fan))
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows)) - start[digits[order]]
        d = [Decimal(0)] * len(rows)
        d[0] = found
        return pd.DataFrame({"node": code >> shift, "at": place + np.asarray(offsets["rows"].iloc[0], np.int64)[digits],
                             "code": code, "w": weight, "d": d})

    return t.groupBy("node", "block").cogroup(before.groupBy("node", "block")).applyInPandas(
        count, f"node long, at long, code long, w long, d {_COUNT}")


def discordant_weight(pairs: DataFrame, a: str, b: str, weight: str, leaf: int = LEAF, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """One row ``d`` (decimal): sum of w_i * w_j over rows with a_i < a_j and b_i > b_j.

    ``pairs`` holds every (a, b) once, without nulls. ``leaf`` (a power of two) is the
    most rows a group holds. An empty table gives null."""
    if leaf < 1 or leaf & (leaf - 1):
        raise ValueError("leaf must be a power of two")
    t = row_number_global(row_number_global(pairs.select(a, b, weight), [a, b], "at"), [b, a], "code")
    t = cut_lineage(t.select(F.lit(0).cast("long").alias("node"), "at", "code", F.col(weight).cast("long").alias("w"),
                             F.lit(0).cast(_COUNT).alias("d")))
    bits, least = max(0, t.count() - 1).bit_length(), leaf.bit_length() - 1
    while bits > least:
        step = min(digit_bits, bits - least)
        bits -= step
        t = cut_lineage(_descend(t, bits, step, leaf))

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        rows = _bounded(rows, leaf)
        inside = weighted_inversions(rows["code"].to_numpy(), rows["w"].to_numpy())
        return pd.DataFrame({"d": [sum(rows["d"], Decimal(0)) + inside]})

    return t.groupBy("node").applyInPandas(finish, f"d {_COUNT}").agg(F.sum("d").alias("d"))
