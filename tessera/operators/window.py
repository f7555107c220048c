"""Window-style operators, sorts and limits.

Row numbers inside a key come from ``ranks.row_number_by_key``: rows are cut into
ranges of the order, so a hot key is numbered by many tasks, never one. Operators
that build one value out of a whole group (W1, W13) emit it in pieces of at most
``piece_rows`` rows, so no single aggregate buffer grows with the hottest key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["ordered_concat", "first_per_key", "argmax_of_columns", "row_index", "rows_by_key",
           "sort_by", "top_k", "top_k_per_group", "cap_per_group", "pad_or_truncate", "sample_rows",
           "hash_order", "hash_int"]


def _cols(x):
    return [x] if isinstance(x, (str, Column)) else list(x)


def hash_order(seed: int, *cols) -> Column:
    """Repeatable pseudo-random order key (replaces np.random shuffles): the md5 of the seed and
    the columns, which any SQL engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]))


def hash_int(seed: int, *cols) -> Column:
    """28 bits of the order key as a number."""
    return F.conv(F.substring(hash_order(seed, *cols), 1, 7), 16, 10).cast("long")


def ordered_concat(df: DataFrame, key, order, text: str, sep: str = " ", row_id: str | None = None,
                   piece_rows: int = 100000, out: str = "text") -> DataFrame:
    """A key's texts joined in ascending order (W1). Output (key..., piece, text): piece 0, 1, ...
    each hold up to ``piece_rows`` consecutive rows; most keys have one piece."""
    from tessera.operators.ranks import row_number_by_key
    keys = _cols(key)
    ords = _cols(order) + ([row_id] if row_id else [])
    numbered = row_number_by_key(df.select(*keys, *ords, text), keys, ords, "_rn")
    piece = (F.col("_rn") / F.lit(piece_rows)).cast("long")
    grouped = numbered.groupBy(*keys, piece.alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col(text).alias("_t")))).alias("_xs"))
    return grouped.select(*keys, "piece", F.array_join(F.transform("_xs", lambda x: x["_t"]), sep).alias(out))


def first_per_key(df: DataFrame, key, order) -> DataFrame:
    """First row of each key in an explicit total order, ascending.

    ``min_by`` over the order columns instead of a window: the aggregate combines map-side,
    so a hot key never sends all its rows to one task."""
    keys = _cols(key)
    ords = _cols(order)
    if not all(isinstance(c, str) for c in ords):  # ordering expressions (desc, nulls last): window
        w = Window.partitionBy(*keys).orderBy(*ords)
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in ords])).alias("_b")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col("_b")[c].alias(c) for c in df.columns])


def argmax_of_columns(cols) -> Column:
    """0-based index of the largest column; first wins on ties."""
    arr = F.array(*[F.col(c) for c in cols])
    return (F.array_position(arr, F.greatest(*[F.col(c) for c in cols])) - 1).cast("int")


def row_index(df: DataFrame, order, partition=None, out: str = "row_idx") -> DataFrame:
    """Running row number (0-based) over an explicit order, per partition key if given."""
    from tessera.operators.ranks import row_number_by_key
    return row_number_by_key(df, _cols(partition) if partition else [], _cols(order), out)


def rows_by_key(df: DataFrame, key, order, piece_rows: int = 100000) -> DataFrame:
    """Row numbers of each key as arrays, in pieces of at most ``piece_rows``."""
    from tessera.operators.ranks import row_number_by_key
    keys = _cols(key)
    ords = _cols(order)
    n = row_number_by_key(df.select(*keys, *ords), keys, ords, "_rn").select(*keys, "_rn")
    return n.groupBy(*keys, (F.col("_rn") / piece_rows).cast("long").alias("piece")) \
            .agg(F.array_sort(F.collect_list("_rn")).alias("rows"))


def sort_by(df: DataFrame, cols, tie_break=None) -> DataFrame:
    """Total order: the given columns, then a key to make ties repeatable."""
    return df.orderBy(*_cols(cols), *(_cols(tie_break) if tie_break else []))


def top_k(df: DataFrame, col: str, k: int, tie_break=None, ascending: bool = False) -> DataFrame:
    """k rows with the largest value (T2): TakeOrderedAndProject, per-partition top-k then merge."""
    o = F.asc(col) if ascending else F.desc(col)
    return df.orderBy(o, *(_cols(tie_break) if tie_break else [])).limit(k)


def top_k_per_group(df: DataFrame, group, score: str, k: int, tie_break=None) -> DataFrame:
    """k best rows per group (T3); Spark applies its window group-limit before the shuffle."""
    w = Window.partitionBy(*_cols(group)).orderBy(F.desc(score), *(_cols(tie_break) if tie_break else []))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def cap_per_group(df: DataFrame, group, n, seed: int, id_cols, max_n: int | None = None) -> DataFrame:
    """Repeatable random cap of ``n`` rows per group (T4): the draw hashes the group and the ids,
    so equal ids of two groups are drawn independently. ``n`` may be a column, then
    ``max_n`` (a literal bound of it) lets Spark cut each group to ``max_n`` rows on the map
    side before the shuffle (window group limit), as it does for a literal ``n``."""
    w = Window.partitionBy(*_cols(group)).orderBy(hash_order(seed, *_cols(group), *_cols(id_cols)), *_cols(id_cols))
    numbered = df.withColumn("_rn", F.row_number().over(w))
    if isinstance(n, Column):
        if max_n is not None:
            numbered = numbered.filter(F.col("_rn") <= F.lit(int(max_n)))
        return numbered.filter(F.col("_rn") <= n).drop("_rn")
    return numbered.filter(F.col("_rn") <= F.lit(n)).drop("_rn")


def pad_or_truncate(arr, n: int, pad=0) -> Column:
    """Array cut or right-padded to length n (T5)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.slice(F.concat(a, F.array_repeat(F.lit(pad), n)), 1, n)


def sample_rows(df: DataFrame, n: int, seed: int, id_cols) -> DataFrame:
    """Repeatable sample of n rows (T6): hash-ordered limit."""
    return df.orderBy(hash_order(seed, *_cols(id_cols)), *_cols(id_cols)).limit(n)
