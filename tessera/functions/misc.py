"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["log_root", "log_root_inverse", "blend", "clean_name", "sign_flag", "safe_ratio"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_root(y) -> Column:
    """sqrt(log1p(y)), the target transform of the zone model."""
    return F.sqrt(F.log1p(_c(y)))


def log_root_inverse(p) -> Column:
    return F.expm1(F.pow(_c(p), 2))


def blend(weights: dict) -> Column:
    """Weighted sum of score columns: {'a': 0.85, 'b': 0.15}."""
    out = None
    for c, w in weights.items():
        term = _c(c) * F.lit(float(w))
        out = term if out is None else out + term
    return out


def clean_name(c) -> Column:
    """Text before the first comma."""
    return F.split(_c(c), ",", 2).getItem(0)


def sign_flag(c) -> Column:
    """1 when the value is positive, else 0."""
    return (_c(c) > 0).cast("int")


def safe_ratio(num, den) -> Column:
    """num / den, null when den is 0 or null (the reference gives NaN / inf)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
