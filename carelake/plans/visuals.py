"""Refreshed aggregates behind the dashboard visuals."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.metrics import count_rows, sum_money


def dt_dept_appt(wh) -> DataFrame:
    return wh.table("fact_appointment").groupBy("department").agg(count_rows().alias("appointments"))


def dt_payment_revenue(wh) -> DataFrame:
    return wh.table("fact_billing").groupBy("payment_mode").agg(sum_money("net_amount").alias("revenue"))


def dt_monthly_revenue(wh) -> DataFrame:
    fb = wh.table("fact_billing")
    return fb.groupBy(F.trunc("bill_date", "MM").alias("month")).agg(sum_money("net_amount").alias("revenue"))


def dt_demographics(wh) -> DataFrame:
    p = wh.table("dim_patient").filter(F.col("gender").isNotNull())
    return p.groupBy("gender").agg(count_rows().alias("count"))


def dt_appt_status(wh) -> DataFrame:
    return wh.table("fact_appointment").groupBy("status").agg(count_rows().alias("count"))


def dt_top_doctors(wh) -> DataFrame:
    """Appointments per doctor name (no limit, despite the name)."""
    return wh.table("fact_appointment").groupBy("doctor_name").agg(count_rows().alias("appointments"))
