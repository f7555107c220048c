"""Named queries: a Spark builder and, where SQL can say it, the DuckDB oracle text.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or data Spark derives from them). Double columns are rounded to
``DIGITS`` decimals at the end so that summation order does not change the
value hash; the oracle text rounds the same columns the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
HEADLINE: list[str] = []


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column (presentation only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def load_all():
    """Import every query module so that it registers itself."""
    from tessera.plans import (q_transactions, q_counters, q_geo, q_text, q_metrics,  # noqa: F401
                               q_detection, q_models, q_tables)
    return QUERIES, ORACLES
