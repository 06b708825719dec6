"""Declared schemas: RAW is all strings, CORE is typed (never inferred)."""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
)

MONEY = DecimalType(12, 2)

RAW_COLUMNS = {
    "patients": [
        "patient_id", "full_name", "dob", "gender", "phone", "email",
        "city", "state", "registration_date",
    ],
    "appointments": [
        "appt_id", "appt_date", "patient_id", "doctor_id", "doctor_name",
        "department", "slot", "status",
    ],
    "billing": [
        "bill_id", "bill_date", "patient_id", "service_code", "service_desc",
        "department", "gross_amount", "discount_amount", "tax_amount",
        "net_amount", "payment_mode", "insurer_name",
    ],
}

KEYS = {"patients": "patient_id", "appointments": "appt_id", "billing": "bill_id"}

def raw_schema(domain: str) -> StructType:
    """CSV read schema: business columns only, every field a string."""
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[domain]])


CORE_SCHEMAS = {
    "patients": StructType([
        StructField("patient_id", LongType(), False),
        StructField("full_name", StringType(), False),
        StructField("dob", DateType(), True),
        StructField("gender", StringType(), True),
        StructField("phone", StringType(), True),
        StructField("email", StringType(), True),
        StructField("city", StringType(), True),
        StructField("state", StringType(), True),
        StructField("registration_date", DateType(), True),
    ]),
    "appointments": StructType([
        StructField("appt_id", LongType(), False),
        StructField("appt_date", DateType(), False),
        StructField("patient_id", LongType(), False),
        StructField("doctor_id", LongType(), False),
        StructField("doctor_name", StringType(), True),
        StructField("department", StringType(), True),
        StructField("slot", StringType(), True),
        StructField("status", StringType(), False),
    ]),
    "billing": StructType([
        StructField("bill_id", LongType(), False),
        StructField("bill_date", DateType(), False),
        StructField("patient_id", LongType(), False),
        StructField("service_code", StringType(), False),
        StructField("service_desc", StringType(), True),
        StructField("department", StringType(), True),
        StructField("gross_amount", MONEY, False),
        StructField("discount_amount", MONEY, True),
        StructField("tax_amount", MONEY, True),
        StructField("net_amount", MONEY, False),
        StructField("payment_mode", StringType(), False),
        StructField("insurer_name", StringType(), True),
    ]),
}
