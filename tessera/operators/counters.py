"""Counter-map statistics (A13-A23, F11) on JSON counter columns.

Sparse user x key matrices of the reference become a LONG table
``(uid, src, key, value)``; its width (millions of keys) never becomes columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.maps import map_size, map_sum, parse_counter_map

__all__ = ["with_maps", "explode_counters", "distinct_map_keys", "map_value_sum", "pivot_with_total",
           "merge_maps_sum", "merge_maps_last", "binarise", "max_merged_value", "support_filter",
           "global_key_totals", "top_keys_by_test_mass", "distinct_flags_count", "key_tokens"]

#: Longest list of keys that is broadcast; some 100 bytes a key.
BROADCAST_KEYS = 100_000


def with_maps(df: DataFrame, srcs) -> DataFrame:
    """Parse each JSON counter column in place (text -> map<string,bigint>)."""
    return df.withColumns({s: parse_counter_map(s) for s in srcs})


def explode_counters(df: DataFrame, keys, srcs, extra=()) -> DataFrame:
    """(keys..., extra..., src, key, value): one row per map entry, all sources stacked."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = [df.select(*keys, *extra, F.lit(s).alias("src"), F.explode(F.col(s)).alias("key", "value"))
             for s in srcs]
    return reduce(lambda a, b: a.unionByName(b), parts)


def distinct_map_keys(df: DataFrame, keys, srcs) -> DataFrame:
    """Distinct counter keys per (keys..., src) (A13): explode, de-duplicate, count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    long = explode_counters(df, keys, srcs).select(*keys, "src", "key").distinct()
    return long.groupBy(*keys, "src").agg(F.count(F.lit(1)).alias("nuniq_keys"))


def map_value_sum(df: DataFrame, keys, srcs) -> DataFrame:
    """Sum of all counter values per (keys...) for each source."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[F.sum(map_sum(s)).alias(f"sumval_{s}") for s in srcs])


def pivot_with_total(df: DataFrame, key: str, cat: str, cat_values, value_cols, names) -> DataFrame:
    """Spread per-(key, cat) values over the category list (0 if absent) plus one total per
    value column (A15). ``names[v]`` is the output stem of value column ``v``; every total
    gets its own name (``<stem>_total``)."""
    aggs = []
    for v in value_cols:
        stem = names[v]
        aggs += [F.coalesce(F.sum(F.when(F.col(cat) == F.lit(c), F.col(v))), F.lit(0)).alias(f"{stem}_cat{i}")
                 for i, c in enumerate(cat_values)]
        aggs.append(F.coalesce(F.sum(v), F.lit(0)).alias(f"{stem}_total"))
    return df.groupBy(key).agg(*aggs)


def merge_maps_sum(df: DataFrame, key, srcs) -> DataFrame:
    """Per-user counter vectors, values of one key added (A16). Long form (key, src, key, value);
    partial aggregation runs map-side, so a hot user is pre-summed before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    long = explode_counters(df, keys, srcs)
    return long.groupBy(*keys, "src", "key").agg(F.sum("value").alias("value"))


def merge_maps_last(df: DataFrame, key, srcs, order=("days", "row_id")) -> DataFrame:
    """Per-user map where, on a key clash, the row latest in ``order`` wins."""
    keys = [key] if isinstance(key, str) else list(key)
    long = explode_counters(df, keys, srcs, extra=list(order))
    return long.groupBy(*keys, "src", "key").agg(
        F.max_by("value", F.struct(*[F.col(o) for o in order])).alias("value"))


def binarise(long: DataFrame, value: str = "value") -> DataFrame:
    """0/1 presence of each key (A18): rows with value 0 are dropped, the rest become 1."""
    return long.filter(F.col(value) != 0).withColumn(value, F.lit(1).cast("tinyint"))


def max_merged_value(long: DataFrame, users: DataFrame, key: str, name: str = "max_value") -> DataFrame:
    """Largest merged counter per user, 0 for users without any."""
    m = long.groupBy(key).agg(F.max("value").alias(name))
    return users.select(key).distinct().join(m, key, "left").fillna(0, subset=[name])


def support_filter(long: DataFrame, labels: DataFrame, key: str, n_train: int, n_test: int,
                   label: str = "target") -> DataFrame:
    """Keep keys present in more than ``n_train`` train users AND more than ``n_test`` test
    users (A20). Users are counted once per key (row presence)."""
    lab = labels.select(key, label)
    pres = long.select(key, "src", "key").distinct().join(lab, key, "left")
    support = pres.groupBy("src", "key").agg(
        F.count_if(F.col(label).isNotNull()).alias("n_train"),
        F.count_if(F.col(label).isNull()).alias("n_test"))
    keep = support.filter((F.col("n_train") > n_train) & (F.col("n_test") > n_test)).select("src", "key")
    return long.join(keep, ["src", "key"], "left_semi")


def global_key_totals(df: DataFrame, srcs) -> DataFrame:
    """Total of every key over all rows."""
    long = explode_counters(df, [], srcs)
    return long.groupBy("src", "key").agg(F.sum("value").alias("total"))


def top_keys_by_test_mass(long: DataFrame, labels: DataFrame, key: str, n: int,
                          label: str = "target") -> DataFrame:
    """The n keys with the largest value sum over test users (A22), then the long table
    restricted to them. Ties broken by key; a list of up to BROADCAST_KEYS keys is broadcast."""
    test_users = labels.filter(F.col(label).isNull()).select(key)
    mass = long.join(test_users, key, "left_semi").groupBy("src", "key").agg(F.sum("value").alias("mass"))
    top = mass.orderBy(F.desc("mass"), "src", "key").limit(n).select("src", "key")
    return long.join(F.broadcast(top) if n <= BROADCAST_KEYS else top, ["src", "key"], "left_semi")


def distinct_flags_count(cols) -> Column:
    """Number of non-zero counters among the columns."""
    return reduce(lambda a, b: a + b, [(F.coalesce(F.col(c), F.lit(0)) > 0).cast("int") for c in cols])


def key_tokens(long: DataFrame, key: str, offset: int = 1, piece_keys: int = 100000) -> DataFrame:
    """Non-zero key ids (+offset) of each user as space-joined text (F11), ascending by id.
    Output (key, piece, tokens): at most ``piece_keys`` ids per piece."""
    nz = long.filter(F.col("value") != 0).select(key, (F.col("key").cast("long") + offset).alias("_id")).distinct()
    from tessera.operators.ranks import row_number_by_key
    numbered = row_number_by_key(nz, [key], ["_id"], "_rn") \
        .withColumn("_piece", (F.col("_rn") / piece_keys).cast("long"))
    return numbered.groupBy(key, F.col("_piece").alias("piece")).agg(
        F.array_join(F.array_sort(F.collect_list("_id")), " ").alias("tokens"))
