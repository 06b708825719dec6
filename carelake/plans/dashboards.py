"""A1-A14 (tabbed dashboard) and B1-B13 (page dashboard) queries.

Each is the DataFrame form of one dashboard SQL string, over the stored
aggregates where the warehouse holds them.  Top-k queries add a
key tie-break so equal metrics always select the same rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.metrics import avg_money, count_rows, rate_pct, sum_flag, sum_money
from carelake.operators.topk import ordered, top_k


# ------------------------------------------------------------ tabbed app
def appt_totals(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    return fa.agg(
        count_rows().alias("total"),
        sum_flag("is_completed").alias("comp"),
        sum_flag("is_cancelled").alias("canc"),
    )


def appt_daily_volume(wh) -> DataFrame:
    g = wh.table("fact_appointment").groupBy("appt_date").agg(count_rows().alias("volume"))
    return ordered(g, [F.col("appt_date").asc()])


def dept_workload(wh) -> DataFrame:
    return wh.table("dt_dept_appt")


def revenue_avg(wh) -> DataFrame:
    fb = wh.table("fact_billing")
    return fb.agg(sum_money("net_amount").alias("total"), avg_money("net_amount", None).alias("avg_bill"))


def monthly_revenue(wh) -> DataFrame:
    """A5: month rendered as yyyy-MM text, as the dashboard displays it."""
    g = wh.table("dt_monthly_revenue")
    return ordered(g.select(F.date_format("month", "yyyy-MM").alias("month"), "revenue"), [F.col("month").asc()])


def payment_revenue(wh) -> DataFrame:
    return wh.table("dt_payment_revenue")


def patient_city_counts(wh) -> DataFrame:
    p = wh.table("dim_patient")
    return p.agg(count_rows().alias("total"), F.count_distinct("city").alias("cities"))


def gender_counts(wh) -> DataFrame:
    return wh.table("dt_demographics")


def top_cities(wh) -> DataFrame:
    p = wh.table("dim_patient").filter(F.col("city").isNotNull())
    g = p.groupBy("city").agg(count_rows().alias("patients"))
    return top_k(g, 10, [F.col("patients").desc()], ["city"])


def no_show_rate(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    return fa.agg(
        sum_flag("is_no_show").alias("noshows"),
        rate_pct(F.sum("is_no_show"), count_rows(), 2).alias("rate"),
    )


def no_show_rate_by_dept(wh) -> DataFrame:
    """HAVING on the rounded rate alias."""
    fa = wh.table("fact_appointment")
    g = fa.groupBy("department").agg(rate_pct(F.sum("is_no_show"), count_rows(), 1).alias("rate"))
    return ordered(g.filter(F.col("rate") > 0), [F.col("rate").desc()], ["department"])


def worst_no_show_doctors(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    g = fa.groupBy("doctor_name").agg(sum_flag("is_no_show").alias("no_shows")).filter(F.col("no_shows") > 0)
    return top_k(g, 7, [F.col("no_shows").desc()], ["doctor_name"])


def top_insurers(wh) -> DataFrame:
    fb = wh.table("fact_billing").filter((F.col("is_insurance") == 1) & F.col("insurer_name").isNotNull())
    g = fb.groupBy("insurer_name").agg(sum_money("net_amount").alias("total_billed"))
    return top_k(g, 8, [F.col("total_billed").desc()], ["insurer_name"])


def vip_patients(wh) -> DataFrame:
    """Grouped by name only, so namesakes merge (and a masked role sees
    a single '****' row).  Bills are pre-aggregated per patient key first."""
    per_key = wh.table("fact_billing").groupBy("patient_key").agg(
        F.count("bill_id").alias("visits"), sum_money("net_amount").alias("spend")
    )
    p = wh.table("dim_patient").select("patient_key", "full_name")
    g = per_key.join(p, "patient_key", "inner").groupBy("full_name").agg(
        F.sum("visits").cast("bigint").alias("visits"),
        sum_money("spend").alias("lifetime_spend"),
    )
    return top_k(g, 10, [F.col("lifetime_spend").desc()], ["full_name"])


# -------------------------------------------------------------- page app
def page_appt_kpi(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    return fa.agg(
        F.count("appt_id").alias("total_appointments"),  # appt_id is the fact's unique key
        sum_flag("is_completed").alias("completed_visits"),
        rate_pct(F.sum("is_completed"), count_rows(), 1).alias("completion_rate_pct"),
        F.count_distinct("patient_key").alias("unique_patients"),
    )


def page_revenue_kpi(wh) -> DataFrame:
    fb = wh.table("fact_billing")
    return fb.agg(
        sum_money("gross_amount").alias("total_gross_revenue"),
        sum_money("net_amount").alias("total_net_revenue"),
        avg_money("net_amount", 2).alias("avg_bill_value"),
    )


def page_dept_volume(wh) -> DataFrame:
    return ordered(wh.table("dt_dept_appt"), [F.col("appointments").desc()], ["department"])


def page_payment_revenue(wh) -> DataFrame:
    return wh.table("dt_payment_revenue")


def page_daily_trend(wh) -> DataFrame:
    return ordered(wh.table("vw_daily_opd_trend"), [F.col("appt_date").asc()])


def page_no_show_dept(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    g = fa.groupBy("department").agg(rate_pct(F.sum("is_no_show"), count_rows(), 1).alias("no_show_rate"))
    return ordered(g, [F.col("no_show_rate").desc()], ["department"])


def page_busiest_doctors(wh) -> DataFrame:
    v = wh.table("vw_doctor_performance").select("doctor_name", "primary_department", "total_appointments")
    return top_k(v, 10, [F.col("total_appointments").desc()], ["doctor_name", "primary_department"])


def page_revenue_dept(wh) -> DataFrame:
    g = wh.table("fact_billing").groupBy("department").agg(sum_money("net_amount").alias("total_revenue"))
    return ordered(g, [F.col("total_revenue").desc()], ["department"])


def page_insurance_mix(wh) -> DataFrame:
    return wh.table("vw_insurance_mix")


def page_top_services(wh) -> DataFrame:
    per_key = wh.table("fact_billing").groupBy("service_key", "department").agg(
        sum_money("net_amount").alias("s")
    )
    svc = wh.table("dim_service").select("service_key", "service_desc")
    g = per_key.join(svc, "service_key", "inner").groupBy("service_desc", "department").agg(
        sum_money("s").alias("revenue")
    )
    return top_k(g, 10, [F.col("revenue").desc()], ["service_desc", "department"])


def page_age_groups(wh) -> DataFrame:
    return wh.table("dim_patient").groupBy("age_group").agg(count_rows().alias("patient_count"))


def page_high_value(wh) -> DataFrame:
    v = wh.table("vw_patient_utilization")
    top = top_k(v, 10, [F.col("lifetime_net_revenue").desc_nulls_last()], ["patient_key"])
    return top.select("full_name", "lifetime_net_revenue", "total_appointments", "age_group")


def page_geo(wh) -> DataFrame:
    g = wh.table("dim_patient").groupBy("state", "city").agg(count_rows().alias("patient_count"))
    return top_k(g, 15, [F.col("patient_count").desc()], ["state", "city"])
