"""Parsing helpers for dirty strings.

ANSI mode is on in Spark 4, so every parse of untrusted text goes through a
``try_*`` form that yields NULL instead of failing the job.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.constants import DOB_FORMATS, ISO_DATE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_id(c) -> Column:
    """F1: number(38,0) semantics: '1001.6' -> 1002, '1,001' -> NULL, '1e3' -> 1000.

    Parsing through decimal(38,0) first rounds fractional input instead of
    rejecting it; the second ``try_cast`` turns an out-of-range value into NULL.
    """
    return _col(c).try_cast("decimal(38,0)").try_cast("bigint")


def try_money(c) -> Column:
    """number(12,2) with HALF_UP rounding; overflow or garbage -> NULL."""
    return _col(c).try_cast("decimal(12,2)")


def parse_date(c, fmt: str = ISO_DATE) -> Column:
    """strict date parse, NULL when the text does not match ``fmt``."""
    return F.try_to_date(_col(c), fmt)


def parse_dob(c) -> Column:
    """Date of birth accepts ISO first, then day-first."""
    return F.coalesce(*[parse_date(c, f) for f in DOB_FORMATS])


def date_key(c) -> Column:
    """yyyymmdd integer surrogate of a date."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def iso_date(c) -> Column:
    return F.date_format(_col(c), ISO_DATE)
