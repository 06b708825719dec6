"""Parse RAW strings once, evaluate named rules, split pass / reject.

Every rule is a named predicate over the parsed columns.  A row passes when
all predicates are TRUE (a NULL predicate rejects, as a SQL WHERE does).  The
pass set is deduplicated per id (WHERE runs before QUALIFY, so a valid
duplicate always beats an invalid one); the reject set keeps one exception
row per (record, failed rule).
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.constants import (
    APPOINTMENT_STATUSES,
    INSURANCE_MODE,
    MIN_PHONE_LENGTH,
    PAYMENT_MODES,
    SOURCE_TABLE,
)
from carelake.functions.parse import parse_date, parse_dob, try_id, try_money
from carelake.operators.dedup import Order, asc, desc, first_per_key
from carelake.schemas import CORE_SCHEMAS, KEYS, RAW_COLUMNS


@dataclass(frozen=True)
class Rule:
    reason: str
    passes: Column


def _t(c: str) -> Column:
    return F.trim(F.col(c))


# ---------------------------------------------------------------- parsing
def _parsed_patients() -> list[Column]:
    return [
        try_id("patient_id").alias("patient_id"),
        _t("full_name").alias("full_name"),
        parse_dob("dob").alias("dob"),
        _t("gender").alias("gender"),
        _t("phone").alias("phone"),
        _t("email").alias("email"),
        _t("city").alias("city"),
        _t("state").alias("state"),
        parse_date("registration_date").alias("registration_date"),
    ]


def _parsed_appointments() -> list[Column]:
    return [
        try_id("appt_id").alias("appt_id"),
        parse_date("appt_date").alias("appt_date"),
        try_id("patient_id").alias("patient_id"),
        try_id("doctor_id").alias("doctor_id"),
        _t("doctor_name").alias("doctor_name"),
        _t("department").alias("department"),
        _t("slot").alias("slot"),
        F.upper(_t("status")).alias("status"),
    ]


def _parsed_billing() -> list[Column]:
    gross = try_money("gross_amount")
    discount = F.coalesce(try_money("discount_amount"), F.lit(0).cast("decimal(12,2)"))
    tax = F.coalesce(try_money("tax_amount"), F.lit(0).cast("decimal(12,2)"))
    return [
        try_id("bill_id").alias("bill_id"),
        parse_date("bill_date").alias("bill_date"),
        try_id("patient_id").alias("patient_id"),
        _t("service_code").alias("service_code"),
        _t("service_desc").alias("service_desc"),
        _t("department").alias("department"),
        gross.alias("gross_amount"),
        discount.alias("discount_amount"),
        tax.alias("tax_amount"),
        # The source NET is ignored: it is recomputed from its parts.
        F.round(gross - discount + tax, 2).try_cast("decimal(12,2)").alias("net_amount"),
        F.upper(_t("payment_mode")).alias("payment_mode"),
        _t("insurer_name").alias("insurer_name"),
    ]


PARSERS = {
    "patients": _parsed_patients,
    "appointments": _parsed_appointments,
    "billing": _parsed_billing,
}


# ------------------------------------------------------------------ rules
def _rules_patients() -> list[Rule]:
    c = F.col
    return [
        Rule("INVALID_PATIENT_ID", c("patient_id").isNotNull()),
        Rule("MISSING_FULL_NAME", c("full_name").isNotNull()),
        Rule("INVALID_DOB", c("dob").isNotNull()),
        # Email test runs on the landed value, phone test on its trimmed length.
        Rule("INVALID_EMAIL", c("_raw_email").isNull() | c("_raw_email").contains("@")),
        Rule("INVALID_PHONE", c("_raw_phone").isNull() | (F.length(F.trim(c("_raw_phone"))) >= MIN_PHONE_LENGTH)),
    ]


def _rules_appointments() -> list[Rule]:
    c = F.col
    return [
        Rule("INVALID_APPT_ID", c("appt_id").isNotNull()),
        Rule("INVALID_APPT_DATE", c("appt_date").isNotNull()),
        Rule("INVALID_PATIENT_ID", c("patient_id").isNotNull()),
        Rule("INVALID_DOCTOR_ID", c("doctor_id").isNotNull()),
        Rule("INVALID_STATUS", c("status").isin(*APPOINTMENT_STATUSES)),
    ]


def _rules_billing() -> list[Rule]:
    c = F.col
    return [
        Rule("INVALID_BILL_ID", c("bill_id").isNotNull()),
        Rule("INVALID_BILL_DATE", c("bill_date").isNotNull()),
        Rule("INVALID_PATIENT_ID", c("patient_id").isNotNull()),
        Rule("MISSING_SERVICE_CODE", c("service_code").isNotNull()),
        Rule("INVALID_GROSS_AMOUNT", c("gross_amount").isNotNull()),
        Rule("NEGATIVE_GROSS_AMOUNT", c("gross_amount").isNull() | (c("gross_amount") >= 0)),
        # A net that the declared type cannot hold; without a gross amount there is none to judge.
        Rule("INVALID_NET_AMOUNT", c("gross_amount").isNull() | c("net_amount").isNotNull()),
        Rule("NEGATIVE_NET_AMOUNT", c("net_amount").isNull() | (c("net_amount") >= 0)),
        Rule("INVALID_PAYMENT_MODE", c("payment_mode").isin(*PAYMENT_MODES)),
        Rule(
            "MISSING_INSURER",
            (F.coalesce(c("payment_mode"), F.lit("")) != INSURANCE_MODE) | c("insurer_name").isNotNull(),
        ),
    ]


RULES = {
    "patients": _rules_patients,
    "appointments": _rules_appointments,
    "billing": _rules_billing,
}

# ----------------------------------------------------------- dedup orders
_AUDIT_ORDER = [desc("_loaded_at", nulls_first=False), asc("_source_file", nulls_first=False)]

DEDUP_ORDER: dict[str, list[Order]] = {
    "patients": _AUDIT_ORDER + [
        asc("full_name"), desc("dob"), asc("gender"), asc("phone"), asc("email"),
        asc("city"), asc("state"), desc("registration_date"),
    ],
    "appointments": _AUDIT_ORDER + [
        desc("appt_date"), asc("patient_id"), asc("doctor_id"), asc("doctor_name"),
        asc("department"), asc("slot"), asc("status"),
    ],
    "billing": _AUDIT_ORDER + [
        desc("bill_date"), desc("gross_amount"), desc("discount_amount"), desc("tax_amount"),
        asc("service_code"), asc("payment_mode"), asc("insurer_name"), asc("department"),
        asc("patient_id"), asc("service_desc"),
    ],
}


# ------------------------------------------------------------- operators
def prepare(domain: str, raw: DataFrame) -> DataFrame:
    """Parse every RAW column once and attach ``_reasons`` (failed rule names).

    Output: typed CORE columns + audit columns + the raw record (for the
    exceptions sink) + ``_reasons: array<string>`` (empty when valid).
    """
    raw_cols = RAW_COLUMNS[domain]
    audit = [c for c in ("_loaded_at", "_source_file") if c in raw.columns]
    parsed = raw.select(
        *PARSERS[domain](),
        *[F.col(c) for c in audit],
        F.struct(*[F.col(c) for c in raw_cols]).alias("_raw"),
        F.col(raw_cols[0]).alias("_raw_id"),
        *([F.col("email").alias("_raw_email"), F.col("phone").alias("_raw_phone")] if domain == "patients" else []),
    )
    for c in ("_loaded_at", "_source_file"):
        if c not in parsed.columns:
            parsed = parsed.withColumn(c, F.lit(None).cast("timestamp_ntz" if c == "_loaded_at" else "string"))
    # Lists put together by flatten() are compiled with the rules; a filter() with a lambda has them interpreted.
    none = F.array().cast("array<string>")
    reasons = F.flatten(
        F.array(*[F.when(F.coalesce(r.passes, F.lit(False)), none).otherwise(F.array(F.lit(r.reason))) for r in RULES[domain]()])
    )
    # The list comes out of a generator (one row each), so that a filter on it is not pushed below the parsed columns, where
    # Catalyst writes every rule out over the RAW expressions and runs it a second time, in the condition of a join below.
    return parsed.select("*", F.explode_outer(F.array(reasons)).alias("_reasons"))


def core_columns(domain: str) -> list[str]:
    return [f.name for f in CORE_SCHEMAS[domain].fields]


def valid_rows(domain: str, prepared: DataFrame) -> DataFrame:
    """Rows passing every rule: CORE columns + audit columns, not deduplicated."""
    return prepared.filter(F.size("_reasons") == 0).select(*core_columns(domain), "_loaded_at", "_source_file")


def clean(domain: str, prepared: DataFrame) -> DataFrame:
    """Valid rows, one per id under DEDUP_ORDER.

    WHERE runs before QUALIFY: a valid duplicate beats an invalid one.  This
    is evaluated as one aggregate whose first order term is "invalid", with
    the validity filter applied to the winners: the same result as
    filter-then-dedup, but the rules are evaluated once per row instead of
    again inside a filter pushed below the projection.
    """
    cols = core_columns(domain) + ["_loaded_at", "_source_file"]
    flagged = prepared.select(*cols, (F.size("_reasons") > 0).alias("_invalid"))
    best = first_per_key(flagged, KEYS[domain], [asc("_invalid")] + DEDUP_ORDER[domain])
    return best.filter(~F.col("_invalid")).select(*cols)


def rejects(domain: str, prepared: DataFrame) -> DataFrame:
    """C4: rejected records with the list of rules they broke."""
    return prepared.filter(F.size("_reasons") > 0).select("_raw_id", "_raw", "_reasons", "_source_file")


def exceptions(domain: str, prepared: DataFrame, batch_id: int | None = None) -> DataFrame:
    """One exception row per (record, failed rule).

    ``exception_id`` is a surrogate hash, not a counter, so it can be computed
    on every executor without coordination and is stable under replay.
    """
    bid = F.lit(batch_id).cast("bigint")
    # The outer form keeps a valid row once, with a null reason that is dropped afterwards: from a plain explode()
    # Catalyst infers a filter on the reason list, pushes it below the projection and so runs every rule twice.
    r = prepared.select(
        F.lit(SOURCE_TABLE[domain]).alias("source_table"),
        F.col("_raw_id").alias("record_id"),
        F.explode_outer("_reasons").alias("rejection_reason"),
        "_raw",
        "_source_file",
    ).filter(F.col("rejection_reason").isNotNull())
    return r.select(
        F.xxhash64("source_table", "record_id", "rejection_reason", "_source_file", "_raw").alias("exception_id"),
        "source_table",
        "record_id",
        "rejection_reason",
        F.to_variant_object(F.col("_raw")).alias("record_data"),
        F.localtimestamp().alias("rejected_at"),
        F.lit(False).alias("reviewed"),
        bid.alias("batch_id"),
    )
