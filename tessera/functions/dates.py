"""Date parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["parse_period", "parse_trdatetime", "date_parts", "is_weekend",
           "whole_days_between", "day_offset"]

# The two date formats of the transaction log.
PERIOD_FORMAT = "dd/MM/yyyy"
TRDATETIME_FORMAT = "ddMMMyy:HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_period(c) -> Column:
    """'31/10/2017' -> date."""
    return F.to_date(_c(c), PERIOD_FORMAT)


def parse_trdatetime(c) -> Column:
    """'21OCT17:00:00:00' -> timestamp. Month names are matched case-insensitively; two-digit
    years 69-99 are of the 20th century."""
    s = _c(c)
    # upper-case month names ('OCT') are normalised to 'Oct' before parsing
    fixed = F.concat(F.substring(s, 1, 2), F.initcap(F.substring(s, 3, 3)), F.substring(s, 6, 64))
    t = F.to_timestamp(fixed, TRDATETIME_FORMAT)
    return F.when(F.year(t) >= 2069, t - F.expr("INTERVAL 100 YEARS")).otherwise(t)


def date_parts(ts, prefix: str = "") -> list[Column]:
    """year, month, day, weekday (Monday = 0), hour of a timestamp (F2)."""
    t = _c(ts)
    return [F.year(t).alias(f"{prefix}year"), F.month(t).alias(f"{prefix}month"),
            F.dayofmonth(t).alias(f"{prefix}day"), F.weekday(t).alias(f"{prefix}weekday"),
            F.hour(t).alias(f"{prefix}hour")]


def is_weekend(ts) -> Column:
    """1 when the day is Saturday or Sunday."""
    return (F.weekday(_c(ts)) >= 5).cast("int")


def whole_days_between(first, last) -> Column:
    """Whole days between two instants (floor of seconds / 86400, not midnights crossed)."""
    secs = F.unix_timestamp(_c(last).cast("timestamp")) - F.unix_timestamp(_c(first).cast("timestamp"))
    return F.floor(secs / F.lit(86400)).cast("long")


def day_offset(ts, origin) -> Column:
    """Integer day number of ``ts`` counted from ``origin`` (calendar days)."""
    return F.datediff(F.to_date(_c(ts)), F.to_date(_c(origin)))
