"""Data quality metrics as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.expressions import _c, at

RATE = "decimal(5,4)"


def _rate(hits: Column, on_empty: float) -> Column:
    n = F.count(F.lit(1))
    return F.when(n == 0, F.lit(on_empty)).otherwise(hits.cast("double") / n.cast("double")).cast(RATE)


def null_rate(c) -> Column:
    return _rate(F.count_if(_c(c).isNull()), 0.0)


def duplicate_rate(c) -> Column:
    """One minus distinct over rows; NULLs lower the distinct count and so count as duplicates."""
    n = F.count(F.lit(1))
    share = F.count_distinct(_c(c)).cast("double") / n.cast("double")
    return F.when(n == 0, F.lit(0.0)).otherwise(F.lit(1.0) - share).cast(RATE)


def freshness_hours(c, as_of: str) -> Column:
    minutes = F.timestamp_diff("MINUTE", F.max(_c(c)), at(as_of))
    return F.coalesce(minutes.cast("double") / F.lit(60.0), F.lit(-1.0)).cast("decimal(10,2)")


def positive_rate(c) -> Column:
    """Share of values at or above zero; NULL counts as a miss, an empty table scores 1."""
    return _rate(F.count_if(_c(c) >= 0), 1.0)


def row_count() -> Column:
    return F.count(F.lit(1))
