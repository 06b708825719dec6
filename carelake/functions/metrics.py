"""Aggregate helpers with the result types the marts publish.

Conventions: counts and flag sums are BIGINT, money sums DECIMAL(28,2),
rates and averages are rounded HALF_UP on decimals.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(predicate: Column) -> Column:
    """CASE WHEN predicate THEN 1 ELSE 0 (a NULL predicate counts as 0)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def count_rows() -> Column:
    return F.count(F.lit(1))


def sum_flag(c) -> Column:
    return F.sum(_col(c)).cast("bigint")


def sum_money(c) -> Column:
    return F.sum(_col(c)).cast("decimal(28,2)")


def avg_money(c, scale: int | None = 2) -> Column:
    """AVG of a decimal(12,2) column (decimal(16,6)), optionally rounded."""
    a = F.avg(_col(c))
    return a if scale is None else F.round(a, scale)


def rate_pct(numerator: Column, denominator: Column, scale: int) -> Column:
    """ROUND(num * 100.0 / NULLIF(den, 0), scale) -- NULL instead of a
    divide-by-zero error under ANSI mode."""
    return F.round(numerator.cast("decimal(20,0)") * F.lit(100) / F.nullif(denominator, F.lit(0)), scale)
