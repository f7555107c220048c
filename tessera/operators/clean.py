"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["rename", "prefix_rename", "drop_columns", "fill_missing", "split_by_label", "isin_filter",
           "map_values", "flag", "to_numeric", "normalise_category", "drop_invalid", "mask_amount",
           "tag_filter", "confidence_filter", "degenerate_box_filter", "trim_zero_rows",
           "keep_nonempty_instances"]


def rename(df: DataFrame, names) -> DataFrame:
    """Positional rename (list) or mapping rename (dict)."""
    if isinstance(names, dict):
        return df.withColumnsRenamed(names)
    return df.toDF(*names)


def prefix_rename(df: DataFrame, prefix: str, cols=None, keep=()) -> DataFrame:
    cols = [c for c in (cols or df.columns) if c not in keep]
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """Remove columns."""
    return df.drop(*cols)


def fill_missing(df: DataFrame, numeric=0, string=None) -> DataFrame:
    """Constant fill by column type (P3): a text fill never touches numbers."""
    num_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    str_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.fillna(numeric, subset=num_cols) if numeric is not None and num_cols else df
    if string is not None and str_cols:
        out = out.fillna(string, subset=str_cols)
    return out


def split_by_label(df: DataFrame, label: str = "target") -> tuple[DataFrame, DataFrame]:
    """train = label present, test = label null."""
    return df.filter(F.col(label).isNotNull()), df.filter(F.col(label).isNull())


def isin_filter(df: DataFrame, col: str, values) -> DataFrame:
    """Keep listed values (P5). A DataFrame of values becomes a left-semi join."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(col)).distinct()
        return df.join(v, col, "left_semi")
    return df.filter(F.col(col).isin(list(values)))


def map_values(col, mapping: dict) -> Column:
    """Dictionary lookup as an expression; unmapped -> null."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return m[F.col(col) if isinstance(col, str) else col]


def flag(predicate: Column) -> Column:
    """1/0 column from a predicate."""
    return F.coalesce(predicate.cast("int"), F.lit(0))


def to_numeric(df: DataFrame, cols=None, to: str = "double") -> DataFrame:
    """Convert every string column that can be a number (P8); bad values -> null."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def normalise_category(col, needle: str, value: str) -> Column:
    """Every value containing ``needle`` becomes ``value``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.contains(needle), F.lit(value)).otherwise(c)


def drop_invalid(df: DataFrame, cols, marker=-1) -> DataFrame:
    """Remove rows where any of the columns holds the invalid marker (P10)."""
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & (F.col(c) != F.lit(marker))
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def mask_amount(col, sign: str) -> Column:
    """Keep the value where its sign matches, else 0."""
    c = F.col(col) if isinstance(col, str) else col
    if sign == "pos":
        return F.when(c > 0, c).otherwise(F.lit(0.0))
    if sign == "neg":
        return F.when(c < 0, c).otherwise(F.lit(0.0))
    return c


def tag_filter(tags, spec: dict) -> Column:
    """Point classes by tag map (P13). spec keys:
    any_tag=True | has_key='k' | equals=('k','v') | value_in=('k',[...]) | value_not_in=('k',[...]).
    ``value_not_in`` means the key is present AND its value is not excluded."""
    t = F.col(tags) if isinstance(tags, str) else tags
    conds = []
    if spec.get("any_tag"):
        conds.append(F.size(t) > 0)
    if "has_key" in spec:
        conds.append(F.map_contains_key(t, spec["has_key"]))
    if "equals" in spec:
        k, v = spec["equals"]
        conds.append(F.coalesce(t[k] == F.lit(v), F.lit(False)))
    if "value_in" in spec:
        k, vs = spec["value_in"]
        conds.append(F.coalesce(t[k].isin(list(vs)), F.lit(False)))
    if "value_not_in" in spec:
        k, vs = spec["value_not_in"]
        conds.append(F.map_contains_key(t, k) & ~F.coalesce(t[k].isin(list(vs)), F.lit(False)))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def confidence_filter(df: DataFrame, min_conf: float, cls: str = "class_id", score: str = "score") -> DataFrame:
    """Drop background class 0 and low scores."""
    return df.filter((F.col(cls) > 0) & (F.col(score) >= F.lit(min_conf)))


def degenerate_box_filter(df: DataFrame, prefix: str = "") -> DataFrame:
    """Drop boxes of area <= 0."""
    y1, x1, y2, x2 = (F.col(f"{prefix}{n}") for n in ("y1", "x1", "y2", "x2"))
    return df.filter((y2 - y1) * (x2 - x1) > 0)


def trim_zero_rows(df: DataFrame, cols) -> DataFrame:
    """Remove all-zero padding rows."""
    return df.filter(F.greatest(*[F.abs(F.col(c)) for c in cols]) > 0)


def keep_nonempty_instances(instances: DataFrame, runs: DataFrame, keys=("image_id", "instance_id"),
                            length: str = "length") -> DataFrame:
    """Instances whose mask still has pixels, with their class."""
    nonempty = runs.groupBy(*keys).agg(F.sum(length).alias("_px")).filter(F.col("_px") > 0)
    return instances.join(nonempty.select(*keys), list(keys), "left_semi")
