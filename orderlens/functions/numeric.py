from __future__ import annotations

from pyspark.sql import Column, functions as F

# Money is carried as fixed-point micro-units from the line level on: sums are
# exact, so results do not depend on partitioning or task order.
MONEY = "decimal(20,6)"
SUM_TYPE = "decimal(38,6)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: A decimal number with optional sign, fraction and exponent; no suffix, no NaN, no infinity.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _finite(text: Column) -> Column:
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER) & (F.abs(value) < F.lit(float("inf"))), value)


def try_num(c) -> Column:
    """Coerce to a finite double; unparsable, NaN and infinite -> NULL (never raises under ANSI).

    A cast alone accepts type suffixes (``12d``) and ``NaN``, which would pass ``> 0``.
    """
    return _finite(_c(c).cast("string"))


def money(c) -> Column:
    """Currency text such as ``$12.50`` -> finite double."""
    return _finite(F.regexp_replace(_c(c).cast("string"), r"\$", ""))


def safe_ratio(n, d, default=0.0) -> Column:
    """``n / d`` when ``d > 0`` else ``default`` (guarded division)."""
    n, d = _c(n), _c(d)
    out = F.when(d > 0, n.cast("double") / d.cast("double"))
    return out if default is None else out.otherwise(F.lit(default).cast("double"))


def dec(c, t: str = MONEY) -> Column:
    return _c(c).cast(t)


def money_sum(c) -> Column:
    """Exact (fixed-point) sum reported as double."""
    return F.sum(dec(c)).cast("double")


def exact_mean(c, scale: int = 6) -> Column:
    """Mean with an exact fixed-point numerator: identical on any partitioning."""
    c = _c(c)
    return F.sum(c.cast(f"decimal(30,{scale})")).cast("double") / F.count(c)


def rounded(c, digits: int = 8) -> Column:
    """Interpolated quantiles / std devs are reported to 1e-8 so that every
    engine and partitioning yields the same value."""
    return F.round(_c(c), digits)
