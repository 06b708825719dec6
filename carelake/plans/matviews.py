"""Pre-aggregated monthly snapshots (refreshed by the pipeline)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.metrics import avg_money, count_rows, sum_flag, sum_money


def mv_monthly_revenue(wh) -> DataFrame:
    fb = wh.table("fact_billing")
    return fb.groupBy(F.trunc("bill_date", "MM").alias("bill_month"), "department", "payment_mode").agg(
        count_rows().alias("bill_count"),
        sum_money("gross_amount").alias("total_gross"),
        sum_money("discount_amount").alias("total_discount"),
        sum_money("tax_amount").alias("total_tax"),
        sum_money("net_amount").alias("total_net"),
        avg_money("net_amount", None).alias("avg_net"),
    )


def mv_dept_appt_monthly(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    return fa.groupBy(F.trunc("appt_date", "MM").alias("appt_month"), "department").agg(
        count_rows().alias("total_appts"),
        sum_flag("is_completed").alias("completed"),
        sum_flag("is_no_show").alias("no_shows"),
        sum_flag("is_cancelled").alias("cancelled"),
    )
