"""Column builders: predicates, labels, ratios and small text helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_RISK = 0.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(as_of: str) -> Column:
    """Timestamp literal without time zone, e.g. ``at("2024-01-31 00:00:00")``."""
    return F.expr(f"TIMESTAMP_NTZ '{as_of}'")


def ago(as_of: str, n: int, unit: str = "day") -> Column:
    """The instant ``n`` units before ``as_of``; folds to a literal, so it reaches the scan as a pushed filter."""
    return F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL '{n}' {unit.upper()}")


def day_of(as_of: str) -> Column:
    return F.expr(f"DATE '{as_of[:10]}'")


# --- predicates ---------------------------------------------------------------------------------

def required(*cols) -> Column:
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in cols])


def since(ts, as_of: str, n: int, unit: str = "day") -> Column:
    return _c(ts) >= ago(as_of, n, unit)


def days_since(d, as_of: str, n: int) -> Column:
    return _c(d) >= F.date_sub(day_of(as_of), n)


def one_of(c, values) -> Column:
    return _c(c).isin(list(values))


def prefix(c, p: str) -> Column:
    return _c(c).startswith(p)


def icontains(c, s: str) -> Column:
    return _c(c).ilike(f"%{s}%")


def moved_more_than(a, b, limit) -> Column:
    return F.abs(_c(a) - _c(b)) > limit


# --- projections --------------------------------------------------------------------------------

def squash(c) -> Column:
    """Upper-case and trim, the key normalisation of the Silver zone."""
    return F.trim(F.upper(_c(c)))


def title(c) -> Column:
    return F.initcap(F.trim(_c(c)))


def digits(c) -> Column:
    return F.regexp_replace(_c(c), "[^0-9]", "")


def full_name(first, last) -> Column:
    return F.concat(_c(first), F.lit(" "), _c(last))


def label(key, text) -> Column:
    return F.concat(_c(key), F.lit(" "), _c(text))


def as_text(c) -> Column:
    return _c(c).cast("string")


def verdict(cond: Column, yes, no) -> Column:
    yes, no = (v if isinstance(v, Column) else F.lit(v) for v in (yes, no))
    return F.when(cond, yes).otherwise(no)


def risk_band(c, cuts=((0.9, "CRITICAL"), (0.75, "HIGH"), (0.5, "MEDIUM")), low: str = "LOW") -> Column:
    """First band whose cut the value exceeds; NULL stays NULL."""
    v = _c(c)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for cut, name in cuts:
        out = out.when(v > cut, name)
    return out.otherwise(low)


def safe_ratio(x, y, k: float = 1.0, nd: int | None = None) -> Column:
    """``x / y * k`` in double, NULL for a zero divisor."""
    r = _c(x).cast("double") / F.nullif(_c(y).cast("double"), F.lit(0.0)) * F.lit(float(k))
    return r if nd is None else F.round(r, nd)


def scaled(c, divisor: float) -> Column:
    return _c(c).cast("double") / F.lit(float(divisor))


def elapsed(unit: str, start, end) -> Column:
    """Whole elapsed units between two timestamps."""
    return F.timestamp_diff(unit.upper(), _c(start), _c(end))


def percent_text(c, nd: int = 0) -> Column:
    return F.format_string(f"%.{nd}f%%", _c(c).cast("double"))


# --- aggregates ---------------------------------------------------------------------------------

def total(c, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal sum with a fixed result type."""
    return F.sum(_c(c)).cast(f"decimal({precision},{scale})")


def mean(c) -> Column:
    """Average as exact sum over count, so the result does not depend on the order of addition."""
    return F.sum(_c(c)).cast("double") / F.nullif(F.count(_c(c)), F.lit(0)).cast("double")


def count_when(cond: Column) -> Column:
    return F.count_if(cond)


def sum_when(cond: Column, value, precision: int = 18, scale: int = 2) -> Column:
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(0))).cast(f"decimal({precision},{scale})")
