"""V3-V5 and K4 on tables that break the rules, which the fixture never does."""

from pyspark.sql import functions as F

from carelake import Warehouse
from carelake.constants import ENGINEER_ROLE
from carelake.functions.masking import mask_name
from carelake.plans import masking, quality


def broken(wh_small, **tables):
    return Warehouse(wh_small.spark, tables, role=ENGINEER_ROLE)


def test_duplicate_dimension_keys_are_found(wh_small):
    p, d = wh_small.resolve("dim_patient"), wh_small.resolve("dim_doctor")
    twice = p.unionByName(p.filter("patient_key in (3, 5)")).unionByName(p.filter("patient_key = 5"))
    got = quality.dim_duplicate_keys(broken(wh_small, dim_patient=twice, dim_doctor=d.unionByName(d.limit(1)))).collect()
    known = {r[0] for r in p.filter("patient_key in (3, 5)").select("patient_key").collect()}
    assert {(r.tbl, r.dim_key): r.cnt for r in got if r.tbl == "DIM_PATIENT"} == {
        ("DIM_PATIENT", k): {3: 2, 5: 3}[k] for k in known}
    assert known and [r.cnt for r in got if r.tbl == "DIM_DOCTOR"] == [2]


def test_null_patient_keys_are_counted(wh_small):
    a, b = wh_small.resolve("fact_appointment"), wh_small.resolve("fact_billing")
    lost = a.withColumn("patient_key", F.when(F.col("appt_id") % 2 == 0, F.col("patient_key")))
    got = {r.fact_table: r.cnt for r in quality.null_fk_check(broken(wh_small, fact_appointment=lost, fact_billing=b)).collect()}
    assert got == {"FACT_APPOINTMENT": a.filter("appt_id % 2 <> 0").count(), "FACT_BILLING": 0} and got["FACT_APPOINTMENT"] > 0


def test_ids_of_core_are_unique_and_repeats_are_found(wh_small):
    assert quality.core_duplicate_keys(wh_small).count() == 0
    b = wh_small.resolve("core_billing")
    twice = b.unionByName(b.filter("bill_id % 10 = 1").limit(2))
    core = {t: wh_small.resolve(t) for t in ("core_patients", "core_appointments")}
    got = quality.core_duplicate_keys(broken(wh_small, core_billing=twice, **core)).collect()
    assert [(r.tbl, r.cnt) for r in got] == [("CORE_BILLING", 2)] * 2


def test_negative_amounts_are_counted(wh_small):
    b = wh_small.resolve("core_billing")
    wrong = b.withColumn("gross_amount", F.when(F.col("bill_id") % 10 == 1, -F.col("gross_amount") - 1).otherwise(F.col("gross_amount")))
    got = quality.negative_amounts(broken(wh_small, core_billing=wrong)).first()[0]
    assert got == b.filter("bill_id % 10 = 1").count() > 0


def test_policy_sets_are_bound_to_their_warehouse(wh_small):
    """Two callers in one process under different sets; a set changes nothing for plans made before."""
    strict = masking.default_policies().with_policy("dim_doctor", "doctor_name", mask_name)
    names = lambda wh: {r.doctor_name for r in wh.table("dim_doctor").collect()}
    plain = wh_small.with_role("PUBLIC")
    guarded = plain.with_policies(strict)
    assert names(guarded) == {"****"} != names(plain)
    before = guarded.table("vw_doctor_performance")
    masking.attach("dim_doctor", "doctor_name", mask_name)
    try:
        assert names(plain) != {"****"}  # made under the earlier default
        assert names(wh_small.with_role("PUBLIC")) == {"****"}
    finally:
        masking.detach("dim_doctor", "doctor_name")
    open_again = guarded.with_policies(strict.without_policy("dim_doctor", "doctor_name"))
    assert names(open_again) == names(plain)
    assert {r.doctor_name for r in before.collect()} == {"****"}
    assert names(guarded.with_role("PUBLIC")) == {"****"}  # another role keeps the set
