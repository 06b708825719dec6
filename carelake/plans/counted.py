"""Counted groups behind the results that are no sums (T6): kept current by load, or derived from the facts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.metrics import count_rows, sum_flag, sum_money


def agg_patient_day(wh) -> DataFrame:
    """Visits by patient and day: a patient's last visit is the last day that holds one."""
    return wh.table("fact_appointment").groupBy("patient_key", "appt_date").agg(
        count_rows().alias("appointments"), sum_flag("is_completed").alias("completed"))


def agg_day_doctor(wh) -> DataFrame:
    """Appointments by day and doctor: a day's doctors are its groups."""
    return wh.table("fact_appointment").groupBy("date_key", "appt_date", "doctor_key").agg(
        count_rows().alias("appointments"), sum_flag("is_completed").alias("completed"),
        sum_flag("is_no_show").alias("no_shows"), F.count("doctor_name").alias("named"))


def agg_doctor_patient(wh) -> DataFrame:
    """Appointments by doctor and patient: a doctor's patients are its groups."""
    return wh.table("fact_appointment").groupBy("doctor_key", "patient_key").agg(
        count_rows().alias("appointments"), sum_flag("is_completed").alias("completed"),
        sum_flag("is_no_show").alias("no_shows"))


def agg_patient_billing(wh) -> DataFrame:
    return wh.table("fact_billing").groupBy("patient_key").agg(
        count_rows().alias("bills"), sum_money("net_amount").alias("net"))


def agg_service_day(wh) -> DataFrame:
    """Bills by service, day and description: the latest description is that of the last day."""
    return wh.table("fact_billing").groupBy("service_code", "bill_date", "service_desc").agg(count_rows().alias("bills"))
