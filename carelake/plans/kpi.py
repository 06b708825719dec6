"""Q1-Q4: executive aggregates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.constants import SELF_PAY_LABEL
from carelake.functions.metrics import avg_money, count_rows, rate_pct, sum_flag, sum_money
from carelake.operators.topk import ordered, top_k


def exec_kpi(wh) -> DataFrame:
    """Q1.  ``appt_id`` is the fact's key (one row per id after the MERGE), so
    COUNT(DISTINCT appt_id) is COUNT(appt_id); only the patient count needs a
    distinct aggregate (one Expand branch fewer)."""
    fa = wh.table("fact_appointment")
    return fa.agg(
        F.count("appt_id").alias("total_appointments"),
        sum_flag("is_completed").alias("completed_visits"),
        sum_flag("is_no_show").alias("total_no_shows"),
        rate_pct(F.sum("is_completed"), count_rows(), 1).alias("completion_rate_pct"),
        F.count_distinct("patient_key").alias("unique_patients"),
    )


def revenue_totals(wh) -> DataFrame:
    """Q2.  ``bill_id`` is the fact's key: COUNT(DISTINCT) is COUNT, no Expand."""
    fb = wh.table("fact_billing")
    return fb.agg(
        F.count("bill_id").alias("total_bills"),
        sum_money("gross_amount").alias("total_gross_revenue"),
        sum_money("net_amount").alias("total_net_revenue"),
        avg_money("net_amount", 2).alias("avg_bill_value"),
        sum_money("discount_amount").alias("total_discounts"),
    )


def payer_mix(wh) -> DataFrame:
    """Share of total revenue per (mode, insurer).

    The grand total is a scalar subquery over the aggregated groups, so they
    stay spread: a window without a partition would take them to one task.
    """
    fb = wh.table("fact_billing")
    g = fb.groupBy("payment_mode", F.coalesce("insurer_name", F.lit(SELF_PAY_LABEL)).alias("insurer")).agg(
        count_rows().alias("bill_count"),
        sum_money("net_amount").alias("total_revenue"),
    )
    total = g.agg(sum_money("total_revenue")).scalar()
    share = F.round(F.col("total_revenue") * F.lit(100) / F.nullif(total, F.lit(0)), 2)
    out = g.select("payment_mode", "insurer", "bill_count", "total_revenue", share.alias("revenue_share_pct"))
    return ordered(out, [F.col("total_revenue").desc()], ["payment_mode", "insurer"])


def top_services(wh) -> DataFrame:
    """Q4: facts aggregated per service key before the join to dim_service
    (one row per key), then folded per description."""
    per_key = wh.table("fact_billing").groupBy("service_key").agg(
        count_rows().alias("n"), sum_money("net_amount").alias("s")
    )
    svc = wh.table("dim_service").select("service_key", "service_desc")
    g = per_key.join(svc, "service_key", "inner").groupBy("service_desc").agg(
        F.sum("n").cast("bigint").alias("bill_count"),
        sum_money("s").alias("total_revenue"),
    )
    return top_k(g, 10, [F.col("total_revenue").desc()], ["service_desc"])
