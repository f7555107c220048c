"""Repeatable splits (E1-E3): folds from hashes of the key, never from row order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.window import hash_int

__all__ = ["train_test_split", "kfold", "stratified_kfold", "hash_fraction"]


def hash_fraction(seed: int, key) -> F.Column:
    """Uniform [0, 1) value from the md5 of (seed, key), which any SQL engine can repeat."""
    return hash_int(seed, key).cast("double") / float(1 << 28)


def train_test_split(df: DataFrame, key: str, test_frac: float, seed: int = 0, name: str = "is_test") -> DataFrame:
    """Hold-out flag: 1 for about ``test_frac`` of the keys."""
    return df.withColumn(name, (hash_fraction(seed, key) < F.lit(test_frac)).cast("int"))


def kfold(df: DataFrame, key: str, n: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """Shuffled k folds: fold = 28 bits of the md5 of (seed, key), modulo n."""
    return df.withColumn(name, F.pmod(hash_int(seed, key), F.lit(n)).cast("int"))


def stratified_kfold(df: DataFrame, key: str, label: str, n: int, seed: int = 0, name: str = "fold") -> DataFrame:
    """Folds with equal class shares (E3): rows of each class in hash order dealt round-robin.

    The position inside a class is a distributed prefix sum over hash buckets, not a
    window over the whole class (a class can hold half of all rows)."""
    from tessera.operators.ranks import prefix_sums
    h = F.xxhash64(F.lit(seed), F.col(key))
    hashed = df.withColumn("_h", h)
    counts = hashed.groupBy(label, "_h").agg(F.count(F.lit(1)).alias("_c"))
    pos = prefix_sums(counts, "_h", "_c", partition_cols=[label]).select(label, "_h", "_c_before")
    w = Window.partitionBy(label, "_h").orderBy(key)
    out = hashed.join(pos, [label, "_h"], "left").withColumn(
        "_p", F.col("_c_before") + F.row_number().over(w) - 1)
    return out.withColumn(name, F.pmod(F.col("_p"), F.lit(n)).cast("int")).drop("_h", "_c_before", "_p")
