"""Star schema (D1-D4) and the dimensions the queries need."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.constants import AGE_BANDS, INSURANCE_MODE
from carelake.functions.metrics import flag
from carelake.functions.parse import date_key
from carelake.operators.dedup import asc, desc, first_per_key


def age_years(dob, as_of) -> F.Column:
    """Whole years between dob and as_of, from yyyymmdd integers (29 Feb safe)."""
    today = int(as_of.strftime("%Y%m%d"))
    return F.floor((F.lit(today) - F.date_format(dob, "yyyyMMdd").cast("int")) / F.lit(10000)).cast("int")


def age_group(dob, as_of) -> F.Column:
    age = age_years(dob, as_of)
    out = None
    for label, low in reversed(AGE_BANDS):
        cond = age >= low
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(F.col("dob").isNull(), F.lit(None).cast("string")).otherwise(out)


def dim_patient(wh) -> DataFrame:
    p = wh.resolve("core_patients")
    return p.select(
        F.col("patient_id").alias("patient_key"),
        "patient_id", "full_name", "dob", "gender", "phone", "email", "city", "state",
        "registration_date",
        date_key("registration_date").alias("registration_date_key"),
        age_group(F.col("dob"), wh.as_of).alias("age_group"),
    )


def dim_doctor(wh) -> DataFrame:
    """Latest name and department per doctor (tie-break appt_id desc)."""
    if wh.holds("latest_doctor"):
        latest = wh.resolve("latest_doctor")
    else:
        a = wh.resolve("core_appointments").filter(
            F.col("doctor_id").isNotNull() & F.col("doctor_name").isNotNull()
        ).select("doctor_id", "appt_date", "appt_id", "doctor_name", "department")
        latest = first_per_key(a, "doctor_id", [desc("appt_date"), desc("appt_id")])
    return latest.select(
        F.col("doctor_id").alias("doctor_key"),
        "doctor_id",
        "doctor_name",
        F.col("department").alias("primary_department"),
    )


def fact_appointment(wh) -> DataFrame:
    a = wh.resolve("core_appointments")
    st = F.upper(F.col("status"))
    return a.select(
        "appt_id",
        date_key("appt_date").alias("date_key"),
        F.col("patient_id").alias("patient_key"),
        F.col("doctor_id").alias("doctor_key"),
        "appt_date", "slot", "status", "department", "doctor_name",
        flag(st == "COMPLETED").alias("is_completed"),
        flag(st == "NO-SHOW").alias("is_no_show"),
        flag(st == "CANCELLED").alias("is_cancelled"),
        flag(st == "SCHEDULED").alias("is_scheduled"),
    )


def fact_billing(wh) -> DataFrame:
    b = wh.resolve("core_billing")
    mode = F.upper(F.col("payment_mode"))
    return b.select(
        "bill_id",
        date_key("bill_date").alias("date_key"),
        F.col("patient_id").alias("patient_key"),
        "bill_date", "service_code", "service_desc", "department",
        "gross_amount", "discount_amount", "tax_amount", "net_amount",
        "payment_mode", "insurer_name",
        flag(mode == INSURANCE_MODE).alias("is_insurance"),
        flag(mode != INSURANCE_MODE).alias("is_self_pay"),
        F.col("service_code").alias("service_key"),
    )


def dim_date(wh) -> DataFrame:
    """One row per day between the first and last fact date.

    The span comes from a global min/max (a one-row aggregate) and the days
    are generated with ``sequence`` + ``explode``: size grows with the number
    of calendar days, not with the facts.
    """
    a = wh.resolve("agg_day_doctor" if wh.holds("agg_day_doctor") else "fact_appointment").select(F.col("appt_date").alias("d"))
    b = wh.resolve("agg_service_day" if wh.holds("agg_service_day") else "fact_billing").select(F.col("bill_date").alias("d"))
    span = a.unionByName(b).agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date")
    )
    dow = F.dayofweek("full_date")  # 1 = Sunday ... 7 = Saturday
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day_of_month"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        dow.isin(1, 7).alias("is_weekend"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
    )


def dim_service(wh) -> DataFrame:
    """Latest description per service code (X2: service_key = service_code)."""
    b = wh.resolve("agg_service_day" if wh.holds("agg_service_day") else "fact_billing").select(
        "service_code", "bill_date", "service_desc")
    latest = first_per_key(b, "service_code", [desc("bill_date"), asc("service_desc")])
    return latest.select(F.col("service_code").alias("service_key"), "service_code", "service_desc")


def dim_department(wh) -> DataFrame:
    """Every department named by either fact."""
    a = wh.resolve("dt_dept_appt" if wh.holds("dt_dept_appt") else "fact_appointment").select("department")
    b = wh.resolve("mv_monthly_revenue" if wh.holds("mv_monthly_revenue") else "fact_billing").select("department")
    d = a.unionByName(b).filter(F.col("department").isNotNull()).distinct()
    return d.select(F.col("department").alias("department_key"), "department")
