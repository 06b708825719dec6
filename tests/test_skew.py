"""A third of all rows on one key: results stay exact, plans combine map-side."""

from pyspark.sql import functions as F

from carelake import Warehouse
from carelake.constants import ENGINEER_ROLE
from carelake.plans import dashboards, views


def _skewed(wh_small):
    raw = wh_small.resolve("raw_billing")
    hot = F.abs(F.xxhash64("bill_id", "bill_date", "gross_amount")) % 3 == 0
    raw = raw.withColumn("patient_id", F.when(hot, F.lit("7")).otherwise(F.col("patient_id")))
    raw = raw.withColumn("bill_id", F.when(hot, F.lit("424242")).otherwise(F.col("bill_id")))
    return Warehouse(wh_small.spark, {
        "raw_billing": raw,
        "raw_patients": wh_small.resolve("raw_patients"),
        "raw_appointments": wh_small.resolve("raw_appointments"),
    }, role=ENGINEER_ROLE)


def test_hot_bill_id_dedup_is_exact(wh_small):
    wh = _skewed(wh_small)
    prepared = wh.resolve("prepared_billing").filter(F.size("_reasons") == 0).filter("bill_id = 424242")
    pdf = prepared.select("bill_date", "gross_amount", "discount_amount", "tax_amount", "service_code",
                          "payment_mode", "insurer_name", "department", "patient_id", "service_desc").toPandas()
    pdf = pdf.sort_values(
        ["bill_date", "gross_amount", "discount_amount", "tax_amount", "service_code", "payment_mode",
         "insurer_name", "department", "patient_id", "service_desc"],
        ascending=[False, False, False, False, True, True, True, True, True, True], na_position="first")
    want = pdf.iloc[0]
    got = wh.table("core_billing").filter("bill_id = 424242").collect()
    assert len(got) == 1
    assert got[0].bill_date == want.bill_date and got[0].gross_amount == want.gross_amount


def test_hot_patient_aggregates_are_exact(wh_small):
    wh = _skewed(wh_small)
    fb = wh.table("fact_billing").toPandas()
    want = fb.groupby("patient_key")["net_amount"].sum()
    got = {r.patient_key: r.lifetime_net_revenue for r in views.vw_patient_utilization(wh).collect()}
    for k, v in want.items():
        if k in got:
            assert got[k] == v
    vip = dashboards.vip_patients(wh).collect()
    assert len(vip) == 10


def test_hot_key_plans_combine_before_exchange(wh_small):
    wh = _skewed(wh_small)
    plan = views.vw_patient_utilization(wh)._jdf.queryExecution().executedPlan().toString()
    # every aggregate of the facts is split into a partial (map-side) and final phase
    assert plan.count("partial_") >= 3
    assert "Window" not in plan
