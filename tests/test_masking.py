"""K1-K4: masking at table resolution; grouping sees masked values."""

from carelake.constants import EXEMPT_ROLES_STRICT
from carelake.plans.dashboards import vip_patients


def test_exempt_role_sees_clear_text(wh_small):
    p = wh_small.with_role("HOSPITAL_VIEWER_ROLE").table("dim_patient")
    assert p.filter("full_name = '****'").count() == 0


def test_public_role_masks_core_and_dim(wh_small):
    for t in ("core_patients", "dim_patient"):
        rows = wh_small.with_role("PUBLIC").table(t).select("full_name", "phone", "email").collect()
        assert {r.full_name for r in rows} == {"****"}
        assert all(r.phone is None or r.phone.startswith("******") for r in rows)
        assert all(r.email is None or r.email.startswith("****") for r in rows)


def test_caller_without_role_sees_masked_values(wh_small):
    for t in ("core_patients", "dim_patient"):
        assert {r.full_name for r in wh_small.with_role(None).table(t).select("full_name").collect()} == {"****"}
    assert vip_patients(wh_small.with_role(None)).first().full_name == "****"


def test_masked_viewer_collapses_vip_groups(wh_small):
    clear = vip_patients(wh_small).collect()
    masked = vip_patients(wh_small.with_role("HOSPITAL_VIEWER_ROLE", EXEMPT_ROLES_STRICT)).collect()
    assert len(clear) == 10
    assert [r.full_name for r in masked] == ["****"]
    assert masked[0].visits == wh_small.table("fact_billing").join(
        wh_small.table("dim_patient"), "patient_key").count()


def test_attach_and_detach_policy(wh_small):
    from pyspark.sql import functions as F

    from carelake.functions.masking import mask_name
    from carelake.plans import masking

    masking.attach("dim_doctor", "doctor_name", mask_name)
    try:
        names = {r.doctor_name for r in wh_small.with_role("PUBLIC").table("dim_doctor").collect()}
        assert names == {"****"}
    finally:
        masking.detach("dim_doctor", "doctor_name")
    clear = wh_small.with_role("PUBLIC").table("dim_doctor").filter(F.col("doctor_name") == "****").count()
    assert clear == 0
