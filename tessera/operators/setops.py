"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

__all__ = ["union_all", "union_distinct_ids", "except_ids", "intersect_ids"]


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct_ids(frames, id_col: str) -> DataFrame:
    """Ids of many frames, duplicates removed."""
    return reduce(lambda a, b: a.union(b), [f.select(id_col) for f in frames]).distinct()


def except_ids(a: DataFrame, b: DataFrame, id_col: str) -> DataFrame:
    """Ids of a not in b (U3); anti join keeps duplicates semantics explicit."""
    return a.select(id_col).distinct().join(b.select(id_col), id_col, "left_anti")


def intersect_ids(*frames: DataFrame, id_cols) -> DataFrame:
    """Ids present in every frame (U4)."""
    cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return reduce(lambda a, b: a.intersect(b), [f.select(*cols) for f in frames])
