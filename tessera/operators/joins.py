"""Equi joins (J1-J8, J17). Catalyst / AQE choose the physical join.

No side is force-broadcast unless the caller states it is a bounded dimension
(``bounded=True``): AQE turns a shuffle join into a broadcast join at run time
when the measured side is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["inner_join_labels", "left_join_features", "lookup", "assemble_outer", "assemble_inner",
           "align_to_ids", "semi_by_keys", "anti_by_keys", "class_map_join"]


def _side(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def inner_join_labels(df: DataFrame, labels: DataFrame, key) -> DataFrame:
    return df.join(labels, key, "inner")


def left_join_features(df: DataFrame, features, key) -> DataFrame:
    """Left join one or many feature tables on one key."""
    features = [features] if isinstance(features, DataFrame) else list(features)
    return reduce(lambda acc, f: acc.join(f, key, "left"), features, df)


def lookup(df: DataFrame, dim: DataFrame, key, bounded: bool = False) -> DataFrame:
    """Dictionary lookup; a missing code gives null."""
    return df.join(_side(dim, bounded), key, "left")


def assemble_outer(tables, key) -> DataFrame:
    """Column-wise concat aligned on the key, outer."""
    return reduce(lambda a, b: a.join(b, key, "full"), tables)


def assemble_inner(tables, key) -> DataFrame:
    """Feature blocks joined on the key, keys present in every block only."""
    return reduce(lambda a, b: a.join(b, key, "inner"), tables)


def align_to_ids(ids: DataFrame, scores: DataFrame, key) -> DataFrame:
    """Scores left-joined to the official id list, with an 'any null' flag column."""
    out = ids.join(scores, key, "left")
    score_cols = [c for c in scores.columns if c not in ([key] if isinstance(key, str) else key)]
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in score_cols]) if len(score_cols) > 1 \
        else F.col(score_cols[0]).isNull().cast("int")
    return out.withColumn("has_null", any_null)


def semi_by_keys(df: DataFrame, keys: DataFrame, key) -> DataFrame:
    """Rows whose key is in the id list, by key rather than position."""
    return df.join(keys, key, "left_semi")


def anti_by_keys(df: DataFrame, keys: DataFrame, key) -> DataFrame:
    return df.join(keys, key, "left_anti")


def class_map_join(df: DataFrame, registry: DataFrame, direction: str = "to_internal") -> DataFrame:
    """(source, source_class_id) <-> internal class_id (J17). Adaptive execution broadcasts the registry by its size."""
    reg = registry
    if direction == "to_internal":
        return df.join(reg.select("source", "source_class_id", "class_id"),
                       ["source", "source_class_id"], "left")
    return df.join(reg.select("class_id", "source", "source_class_id", "name"), "class_id", "left")
