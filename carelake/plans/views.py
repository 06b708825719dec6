"""Analytical views (lazy DataFrames, sorted by consumers)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.metrics import avg_money, count_rows, rate_pct, sum_flag, sum_money


def vw_patient_utilization(wh) -> DataFrame:
    """Patients with both facts pre-aggregated before the joins (no fan-out)."""
    p = wh.table("dim_patient").select("patient_key", "patient_id", "full_name", "age_group")
    if wh.holds("agg_patient_day"):
        appt = wh.table("agg_patient_day").groupBy("patient_key").agg(
            F.sum("appointments").cast("bigint").alias("total_appointments"),
            F.sum("completed").cast("bigint").alias("completed_visits"),
            F.max("appt_date").alias("last_visit_date"),
        )
    else:
        appt = wh.table("fact_appointment").groupBy("patient_key").agg(
            count_rows().alias("total_appointments"),
            sum_flag("is_completed").alias("completed_visits"),
            F.max("appt_date").alias("last_visit_date"),
        )
    if wh.holds("agg_patient_billing"):
        bill = wh.table("agg_patient_billing").select(
            "patient_key", F.col("bills").alias("total_bills"), F.col("net").alias("lifetime_net_revenue"))
    else:
        bill = wh.table("fact_billing").groupBy("patient_key").agg(
            count_rows().alias("total_bills"),
            sum_money("net_amount").alias("lifetime_net_revenue"),
        )
    j = p.join(appt, "patient_key", "left").join(bill, "patient_key", "left")
    return j.select(
        "patient_key", "patient_id", "full_name", "age_group",
        F.coalesce("total_appointments", F.lit(0).cast("bigint")).alias("total_appointments"),
        F.coalesce("completed_visits", F.lit(0).cast("bigint")).alias("completed_visits"),
        F.coalesce("total_bills", F.lit(0).cast("bigint")).alias("total_bills"),
        F.coalesce("lifetime_net_revenue", F.lit(0).cast("decimal(18,2)")).alias("lifetime_net_revenue"),
        "last_visit_date",
    )


def vw_daily_opd_trend(wh) -> DataFrame:
    """Per day with calendar attributes from dim_date.

    The facts are aggregated per day first and only then joined to the
    calendar: dim_date has one row per date_key and the calendar attributes
    are functions of the date, so this equals join-then-group while the join
    sees one row per day instead of every appointment.
    """
    if wh.holds("agg_day_doctor"):
        per_day = wh.table("agg_day_doctor").groupBy("date_key", "appt_date").agg(
            F.sum("appointments").cast("bigint").alias("total_appointments"),
            F.sum("completed").cast("bigint").alias("completed_visits"),
            F.sum("no_shows").cast("bigint").alias("no_shows"),
            F.count("doctor_key").alias("unique_doctors"),
        )
    else:
        per_day = wh.table("fact_appointment").groupBy("date_key", "appt_date").agg(
            count_rows().alias("total_appointments"),
            sum_flag("is_completed").alias("completed_visits"),
            sum_flag("is_no_show").alias("no_shows"),
            F.count_distinct("doctor_key").alias("unique_doctors"),
        )
    dd = wh.table("dim_date").select("date_key", "day_name", "is_weekend", "year_month")
    j = per_day.join(dd, "date_key", "inner")
    return j.select(
        "appt_date", "day_name", "is_weekend", "year_month", "total_appointments", "completed_visits",
        "no_shows", "unique_doctors",
        F.round(
            F.col("total_appointments").cast("decimal(20,0)") / F.nullif(F.col("unique_doctors"), F.lit(0)), 2
        ).alias("avg_appt_per_doctor"),
    )


def vw_doctor_performance(wh) -> DataFrame:
    """Per doctor name and primary department.

    There are few doctors, so every doctor key is hot.  The facts are first
    reduced to distinct (doctor, patient) pairs -- a well-spread key, combined
    map-side -- and only those pairs meet the doctor dimension; the distinct
    patient count per (name, department) is taken over the pairs.
    """
    if wh.holds("agg_doctor_patient"):
        pairs = wh.table("agg_doctor_patient").select(
            "doctor_key", "patient_key", F.col("appointments").alias("n"), F.col("completed").alias("c"),
            F.col("no_shows").alias("ns"))
    else:
        pairs = wh.table("fact_appointment").groupBy("doctor_key", "patient_key").agg(
            count_rows().alias("n"),
            sum_flag("is_completed").alias("c"),
            sum_flag("is_no_show").alias("ns"),
        )
    d = wh.table("dim_doctor").select("doctor_key", "doctor_name", "primary_department")
    j = pairs.join(d, "doctor_key", "inner")
    return j.groupBy("doctor_name", "primary_department").agg(
        F.sum("n").cast("bigint").alias("total_appointments"),
        F.sum("c").cast("bigint").alias("completed"),
        F.sum("ns").cast("bigint").alias("no_shows"),
        F.count_distinct("patient_key").alias("unique_patients"),
    )


def vw_revenue_by_department(wh) -> DataFrame:
    fb = wh.table("fact_billing")
    return fb.groupBy("department").agg(
        F.count("bill_id").alias("total_bills"),
        sum_money("net_amount").alias("total_revenue"),
        avg_money("net_amount", 2).alias("avg_bill_amount"),
    )


def vw_no_show_analysis(wh) -> DataFrame:
    fa = wh.table("fact_appointment")
    return fa.groupBy("doctor_name", "department").agg(
        F.count("appt_id").alias("total_appointments"),
        sum_flag("is_no_show").alias("no_show_count"),
        rate_pct(F.sum("is_no_show"), F.count("appt_id"), 2).alias("no_show_percentage"),
    )


def vw_patient_demographics(wh) -> DataFrame:
    p = wh.table("dim_patient")
    return p.groupBy("gender", "city", "state").agg(F.count("patient_id").alias("total_patients"))


def vw_top_insurers(wh) -> DataFrame:
    fb = wh.table("fact_billing").filter((F.col("is_insurance") == 1) & F.col("insurer_name").isNotNull())
    return fb.groupBy("insurer_name").agg(
        F.count("bill_id").alias("bill_count"),
        sum_money("net_amount").alias("total_insurance_billed"),
    )


def vw_daily_clinic_roster(wh) -> DataFrame:
    """Scheduled or completed appointments with the patient's name."""
    a = wh.table("fact_appointment").filter((F.col("is_scheduled") == 1) | (F.col("is_completed") == 1))
    p = wh.table("dim_patient").select("patient_key", F.col("full_name").alias("patient_name"))
    return a.join(p, "patient_key", "inner").select(
        "appt_date", "slot", "patient_name", "doctor_name", "department", "status"
    )


def vw_high_value_patients(wh) -> DataFrame:
    """Lifetime value per patient with contact data.

    Bills are aggregated per patient key before the join: the dimension key is
    unique (checked by ``dim_duplicate_keys``), so this equals join-then-group
    but shuffles one row per patient instead of every bill.
    """
    if wh.holds("agg_patient_billing"):
        per_key = wh.table("agg_patient_billing").select(
            "patient_key", F.col("bills").alias("total_visits"), F.col("net").alias("lifetime_value"))
    else:
        per_key = wh.table("fact_billing").groupBy("patient_key").agg(
            F.count("bill_id").alias("total_visits"),
            sum_money("net_amount").alias("lifetime_value"),
        )
    p = wh.table("dim_patient").select("patient_key", "patient_id", "full_name", "phone", "email")
    return per_key.join(p, "patient_key", "inner").select(
        "patient_id", "full_name", "phone", "email", "total_visits", "lifetime_value"
    )


def vw_insurance_mix(wh) -> DataFrame:
    """P5: revenue by department and payment mode."""
    fb = wh.table("fact_billing")
    return fb.groupBy("department", "payment_mode").agg(
        count_rows().alias("bill_count"),
        sum_money("net_amount").alias("total_net"),
    )

