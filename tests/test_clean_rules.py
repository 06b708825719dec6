"""One test per documented failure case of the cleaning rules."""

import datetime

import pytest
from pyspark.sql import functions as F

from carelake.operators import clean as C
from carelake.schemas import RAW_COLUMNS


def raw(spark, domain, rows, loaded=None, source="f.csv"):
    cols = RAW_COLUMNS[domain]
    data = [tuple(r) + (loaded, source) for r in rows]
    schema = ", ".join(f"{c} string" for c in cols) + ", _loaded_at timestamp_ntz, _source_file string"
    return spark.createDataFrame(data, schema)


P = ["1001", "Ann", "1990-01-01", "Female", "9876543210", "a@x.com", "Pune", "MH", "2024-01-01"]
A = ["1", "2025-01-01", "1001", "7", "Dr X", "Cardio", "Morning", "Completed"]
B = ["10", "2026-01-01", "1001", "XR201", "X-Ray", "Ortho", "100.00", "10.00", "5.00", "999", "Cash", None]


def _reasons(spark, domain, row):
    prepared = C.prepare(domain, raw(spark, domain, [row]))
    got = prepared.select("_reasons").collect()[0][0]
    return got


@pytest.mark.parametrize("i,value,reason", [
    (0, None, "INVALID_PATIENT_ID"),
    (0, "abc", "INVALID_PATIENT_ID"),
    (1, None, "MISSING_FULL_NAME"),
    (2, "31/02/1995", "INVALID_DOB"),
    (2, None, "INVALID_DOB"),
    (5, "a[at]x.com", "INVALID_EMAIL"),
    (4, "12345", "INVALID_PHONE"),
])
def test_patient_rules(spark, i, value, reason):
    row = list(P)
    row[i] = value
    assert _reasons(spark, "patients", row) == [reason]


def test_patient_valid_variants(spark):
    row = list(P)
    row[2] = "05/03/1995"        # day-first date is valid
    row[4] = None                # missing phone is allowed
    row[5] = None                # missing email is allowed
    row[8] = "not a date"        # registration date may be null
    assert _reasons(spark, "patients", row) == []
    out = C.clean("patients", C.prepare("patients", raw(spark, "patients", [row]))).collect()[0]
    assert out.dob == datetime.date(1995, 3, 5) and out.registration_date is None


@pytest.mark.parametrize("i,value,reason", [
    (0, "x", "INVALID_APPT_ID"),
    (1, "01/01/2025", "INVALID_APPT_DATE"),
    (2, None, "INVALID_PATIENT_ID"),
    (3, "", "INVALID_DOCTOR_ID"),
    (7, "Unknown", "INVALID_STATUS"),
    (7, None, "INVALID_STATUS"),
])
def test_appointment_rules(spark, i, value, reason):
    row = list(A)
    row[i] = value
    assert _reasons(spark, "appointments", row) == [reason]


def test_status_is_trimmed_and_upper_cased(spark):
    row = list(A)
    row[7] = " no-show "
    out = C.clean("appointments", C.prepare("appointments", raw(spark, "appointments", [row]))).collect()[0]
    assert out.status == "NO-SHOW"


@pytest.mark.parametrize("i,value,reasons", [
    (0, None, ["INVALID_BILL_ID"]),
    (1, "2026/01/01", ["INVALID_BILL_DATE"]),
    (3, None, ["MISSING_SERVICE_CODE"]),
    (6, "abc", ["INVALID_GROSS_AMOUNT"]),
    (6, "-1.00", ["NEGATIVE_GROSS_AMOUNT", "NEGATIVE_NET_AMOUNT"]),
    (7, "200.00", ["NEGATIVE_NET_AMOUNT"]),
    (10, "Cheque", ["INVALID_PAYMENT_MODE"]),
    (10, None, ["INVALID_PAYMENT_MODE"]),
    (10, "insurance", ["MISSING_INSURER"]),
])
def test_billing_rules(spark, i, value, reasons):
    row = list(B)
    row[i] = value
    assert _reasons(spark, "billing", row) == reasons


def test_billing_net_recomputed_and_defaults(spark):
    row = list(B)
    row[7] = None   # discount defaults to 0
    row[8] = "1.005"  # rounds half up to 1.01
    out = C.clean("billing", C.prepare("billing", raw(spark, "billing", [row]))).collect()[0]
    assert str(out.discount_amount) == "0.00" and str(out.tax_amount) == "1.01"
    assert str(out.net_amount) == "101.01"


def test_valid_duplicate_beats_invalid_and_latest_load_wins(spark):
    old = list(P)
    new = list(P)
    new[1] = "Ann Updated"
    bad = list(P)
    bad[2] = "31/02/1995"
    t0, t1 = datetime.datetime(2025, 1, 1), datetime.datetime(2025, 1, 2)
    df = raw(spark, "patients", [old], loaded=t0).unionByName(raw(spark, "patients", [new], loaded=t1))
    df = df.unionByName(raw(spark, "patients", [bad], loaded=datetime.datetime(2025, 1, 3)))
    out = C.clean("patients", C.prepare("patients", df)).collect()
    assert len(out) == 1 and out[0].full_name == "Ann Updated"


def test_rejects_and_passes_partition_the_input(wh_small):
    for d in ("patients", "appointments", "billing"):
        prepared = wh_small.resolve(f"prepared_{d}")
        n_raw = wh_small.resolve(f"raw_{d}").count()
        assert C.valid_rows(d, prepared).count() + C.rejects(d, prepared).count() == n_raw


def test_expected_counts_sf0001(wh_small):
    """FIXTURES.md section 4, sf0.001 column."""
    got = {d: wh_small.table(f"core_{d}").count() for d in ("patients", "appointments", "billing")}
    assert got == {"patients": 112, "appointments": 790, "billing": 3485}
    ex = {(r.source_table, r.rejection_reason): r["count"]
          for r in wh_small.table("exceptions").groupBy("source_table", "rejection_reason").count().collect()}
    assert ex[("RAW_PATIENTS", "INVALID_DOB")] == 8
    assert ex[("RAW_PATIENTS", "INVALID_EMAIL")] == 15
    assert ex[("RAW_PATIENTS", "INVALID_PHONE")] == 15
    assert ex[("RAW_BILLING", "NEGATIVE_GROSS_AMOUNT")] == 317
    assert ex[("RAW_BILLING", "NEGATIVE_NET_AMOUNT")] == 317
    assert ex[("RAW_BILLING", "INVALID_PAYMENT_MODE")] == 1001
    assert ex[("RAW_BILLING", "MISSING_INSURER")] == 509


@pytest.mark.parametrize("domain", ["patients", "appointments", "billing"])
def test_rules_run_once_and_compiled(wh_small, domain):
    """A filter on the reasons stays above them: the rules are written out once, over the parsed columns, without a lambda."""
    prepared = wh_small.resolve(f"prepared_{domain}")
    for df in (C.rejects(domain, prepared), C.valid_rows(domain, prepared), prepared.filter(F.size("_reasons") > 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for rule in C.RULES[domain]():
            assert plan.count(f"[{rule.reason}]") + plan.count(f"THEN {rule.reason} ") == 1, rule.reason
        assert "lambda" not in plan


def test_reasons_of_duplicate_and_null_rows(spark):
    """One row comes out for each that goes in, reasons in the order of the rules, an empty list where none is broken."""
    bad = [None] * len(B)
    rows = [tuple(B), tuple(B), tuple(bad), tuple(bad)]
    got = sorted(r[0] for r in C.prepare("billing", raw(spark, "billing", rows)).select("_reasons").collect())
    broken = ["INVALID_BILL_ID", "INVALID_BILL_DATE", "INVALID_PATIENT_ID", "MISSING_SERVICE_CODE", "INVALID_GROSS_AMOUNT",
              "INVALID_PAYMENT_MODE"]
    assert got == [[], [], broken, broken]
