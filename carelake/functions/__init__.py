"""Scalar Column builders (all JVM-side built-ins, no Python UDFs)."""

from carelake.functions.parse import date_key, iso_date, parse_date, parse_dob, try_id, try_money
from carelake.functions.metrics import avg_money, count_rows, flag, rate_pct, sum_flag, sum_money
from carelake.functions.masking import mask_email, mask_name, mask_phone

__all__ = [
    "avg_money", "count_rows", "date_key", "flag", "iso_date", "mask_email", "mask_name",
    "mask_phone", "parse_date", "parse_dob", "rate_pct", "sum_flag", "sum_money",
    "try_id", "try_money",
]
