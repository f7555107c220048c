"""Distributed ordered prefix sums and global ranks.

A global rank needs "how many rows sort before me". A window without
``partitionBy`` would move every row into one task, so instead:

1. collapse the input to distinct order values with weights (hot values become one row);
2. cut the distinct values into ``n_buckets`` contiguous ranges at approximate
   quantiles (only ``n_buckets`` split points reach the driver);
3. per-bucket totals (n_buckets rows) give each bucket's offset; a window
   partitioned by bucket gives the exact running sum inside it.

Result is exact; only the balance of the buckets depends on the sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["bucket_splits", "add_bucket", "range_buckets", "prefix_sums", "average_rank", "dense_rank_global",
           "row_number_global", "row_number_by_key", "suffix_max"]


def _default_buckets(df: DataFrame) -> int:
    return max(8, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bucket_splits(df: DataFrame, col: str, n_buckets: int, rel_err: float = 1e-3) -> list[float]:
    """Sorted distinct split points at approximate quantiles of ``col`` (bounded list)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.approxQuantile(col, probs, rel_err) if n_buckets > 1 else []
    return sorted(set(q for q in qs if q is not None))


def add_bucket(df: DataFrame, col: str, splits: list[float], out: str = "_bucket"):
    """Bucket id such that bucket order = value order (binary search via Bucketizer, JVM side)."""
    from pyspark.ml.feature import Bucketizer
    edges = [float("-inf")] + [float(s) for s in splits] + [float("inf")]
    tmp = f"{out}_src"
    b = Bucketizer(splits=edges, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return b.transform(df.withColumn(tmp, F.col(col).cast("double"))).drop(tmp) \
            .withColumn(out, F.col(out).cast("int"))


def range_buckets(t: DataFrame, order_col: str, n_buckets: int | None = None) -> DataFrame:
    """Bucket id for any orderable type: range partitioning, ids fixed by a reliable checkpoint."""
    from tessera.session import cut_lineage
    return cut_lineage(t.repartitionByRange(n_buckets or _default_buckets(t), order_col)
                       .withColumn("_bucket", F.spark_partition_id()))


def prefix_sums(t: DataFrame, order_col: str, weight_cols, n_buckets: int | None = None,
                suffix: str = "_before", partition_cols=()) -> DataFrame:
    """For a table with UNIQUE ``(partition_cols, order_col)`` values, add ``w_before`` = sum
    of ``w`` over the rows of the same partition with a smaller order value. Exact, distributed."""
    from pyspark.sql import types as T
    weight_cols = [weight_cols] if isinstance(weight_cols, str) else list(weight_cols)
    parts = list(partition_cols)
    n_buckets = n_buckets or _default_buckets(t)
    if "_bucket" in t.columns:  # cut into ranges before (``range_buckets``)
        tb = t
    elif isinstance(t.schema[order_col].dataType, T.NumericType):
        tb = add_bucket(t, order_col, bucket_splits(t, order_col, n_buckets))
    else:
        tb = range_buckets(t, order_col, n_buckets)
    totals = tb.groupBy(*parts, "_bucket").agg(*[F.sum(w).alias(f"_tot_{w}") for w in weight_cols])
    # (partitions x n_buckets) rows: bounded by construction
    wb = (Window.partitionBy(*parts) if parts else Window).orderBy("_bucket") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, "_bucket",
                            *[F.coalesce(F.sum(f"_tot_{w}").over(wb), F.lit(0)).alias(f"_off_{w}")
                              for w in weight_cols])
    wi = Window.partitionBy(*parts, "_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    inner = tb.select("*", *[F.coalesce(F.sum(w).over(wi), F.lit(0)).alias(f"_in_{w}") for w in weight_cols])
    out = inner.join(offsets, [*parts, "_bucket"], "left")
    return out.select(*t.columns, *[(F.col(f"_off_{w}") + F.col(f"_in_{w}")).alias(f"{w}{suffix}")
                                    for w in weight_cols])


def suffix_max(t: DataFrame, order_col: str, values: dict[str, str], partition_cols=(),
               n_buckets: int | None = None) -> DataFrame:
    """For a table with UNIQUE ``(partition_cols, order_col)`` values, add for every
    ``value -> out`` of ``values`` the max of ``value`` over the rows of the same partition at
    or after this row. Exact, distributed like ``prefix_sums``: range maxima per bucket, a
    bounded suffix max over buckets, and a window inside each bucket."""
    parts = list(partition_cols)
    tb = t if "_bucket" in t.columns else range_buckets(t, order_col, n_buckets or _default_buckets(t))
    bmax = tb.groupBy(*parts, "_bucket").agg(*[F.max(v).alias(f"_max_{v}") for v in values])
    wb = (Window.partitionBy(*parts) if parts else Window).orderBy("_bucket") \
        .rowsBetween(1, Window.unboundedFollowing)
    later = bmax.select(*parts, "_bucket", *[F.max(f"_max_{v}").over(wb).alias(f"_later_{v}") for v in values])
    wi = Window.partitionBy(*parts, "_bucket").orderBy(order_col).rowsBetween(0, Window.unboundedFollowing)
    inner = tb.select("*", *[F.max(v).over(wi).alias(f"_in_{v}") for v in values]).join(later, [*parts, "_bucket"], "left")
    return inner.select(*t.columns, *[F.greatest(F.col(f"_in_{v}"), F.col(f"_later_{v}")).alias(o) for v, o in values.items()])


def average_rank(df: DataFrame, col: str, out: str, n_buckets: int | None = None) -> DataFrame:
    """1-based rank of ``col`` over the whole table, ties get the mean rank (pandas 'average').
    Null values get a null rank."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = prefix_sums(counts, col, "_cnt", n_buckets)
    ranks = ranked.select(col, (F.col("_cnt_before") + (F.col("_cnt") + 1) / 2.0).alias(out))
    return df.join(ranks, col, "left")


def dense_rank_global(df: DataFrame, col: str, out: str, n_buckets: int | None = None) -> DataFrame:
    """1-based dense rank of ``col`` over the whole table."""
    distinct = df.filter(F.col(col).isNotNull()).select(col).distinct().withColumn("_one", F.lit(1))
    ranked = prefix_sums(distinct, col, "_one", n_buckets)
    return df.join(ranked.select(col, (F.col("_one_before") + 1).alias(out)), col, "left")


def row_number_by_key(df: DataFrame, keys, order_cols, out: str = "row_idx", n_buckets: int | None = None) -> DataFrame:
    """0-based position of each row inside its key (the whole table when ``keys`` is empty)
    in a total order of ``order_cols`` (include a unique column). Exact, all on the JVM.

    No key is gathered into one task: rows are cut into contiguous ranges of the order
    (a hot key spans many ranges), each range is numbered by a window, and each
    (key, range) gets its offset from the (key x range) totals (``prefix_sums``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    t = df.withColumns({"_ord": F.struct(*[F.col(c) for c in order_cols]), "_one": F.lit(1)})
    r = prefix_sums(t, "_ord", "_one", n_buckets, partition_cols=keys)
    return r.select(*df.columns, F.col("_one_before").cast("long").alias(out))


def row_number_global(df: DataFrame, order_cols, out: str = "row_idx") -> DataFrame:
    """0-based position in a total order over the whole table (``row_number_by_key`` without keys)."""
    return row_number_by_key(df, [], order_cols, out)
