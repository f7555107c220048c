"""Counter-map functions (F4-F11, F22): JSON text -> map<string,bigint> and its summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["COUNTER_MAP_TYPE", "parse_counter_map", "map_is_not_empty", "map_size", "map_sum",
           "map_max", "map_get", "extract_keys", "strip_braces", "strip_trailing_comma",
           "counter_tokens", "array_length", "array_max_or_zero"]

COUNTER_MAP_TYPE = "map<string,bigint>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_counter_map(c) -> Column:
    """'{"12": 3, "7": 1}' -> map. Empty or null text -> empty map. Never evaluates code."""
    parsed = F.from_json(_c(c), COUNTER_MAP_TYPE)
    return F.coalesce(parsed, F.create_map().cast(COUNTER_MAP_TYPE))


def map_is_not_empty(m) -> Column:
    """1 when the map holds a key, else 0."""
    return (F.size(_c(m)) > 0).cast("int")


def map_size(m) -> Column:
    """Number of keys; 0 for an empty or null map."""
    return F.greatest(F.size(_c(m)), F.lit(0)).cast("long")


def map_sum(m) -> Column:
    """Sum of the values; 0 for an empty map."""
    return F.aggregate(F.map_values(_c(m)), F.lit(0).cast("long"), lambda acc, x: acc + x)


def map_max(m) -> Column:
    """Largest value; 0 for an empty map."""
    return F.coalesce(F.array_max(F.map_values(_c(m))), F.lit(0).cast("long"))


def map_get(m, key: str, default: int = 0) -> Column:
    """One key as a column, ``default`` when absent."""
    return F.coalesce(F.try_element_at(_c(m), F.lit(str(key))), F.lit(default).cast("long"))


def extract_keys(json_col) -> Column:
    """All quoted integer keys of a JSON text, space-joined ('"12": 3, "7": 1' -> '12 7') (F8)."""
    return F.array_join(F.regexp_extract_all(_c(json_col), F.lit(r'"(\d+)"'), 1), " ")


def strip_braces(c) -> Column:
    """'{...}' -> '...' (outer braces only)."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^\s*\{", ""), r"\}\s*$", "")


def strip_trailing_comma(c) -> Column:
    """Drop one trailing comma."""
    return F.regexp_replace(_c(c), r",\s*$", "")


def counter_tokens(m) -> Column:
    """map -> array of 'key:value' tokens (key order)."""
    return F.transform(F.array_sort(F.map_entries(_c(m))),
                       lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))


def array_length(a) -> Column:
    return F.coalesce(F.size(_c(a)), F.lit(0))


def array_max_or_zero(a) -> Column:
    return F.coalesce(F.array_max(_c(a)), F.lit(0))
