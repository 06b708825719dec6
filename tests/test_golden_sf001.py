"""Golden figures at sf0.01 (FIXTURES.md section 4, computed by two engines)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake import Warehouse
from carelake.constants import ENGINEER_ROLE
from carelake.plans import dashboards, quality, visuals

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_testdata(spark, SF, role=ENGINEER_ROLE)


def test_counts(wh):
    got = {d: (wh.table(f"raw_{d}").count(), wh.table(f"core_{d}").count())
           for d in ("patients", "appointments", "billing")}
    assert got == {"patients": (1500, 1125), "appointments": (10000, 7994), "billing": (60000, 35075)}


def test_billing_totals_and_modes(wh):
    t = wh.table("fact_billing").agg(*[F.sum(c).alias(c) for c in
                                      ("gross_amount", "discount_amount", "tax_amount", "net_amount")]).collect()[0]
    assert (t.gross_amount, t.discount_amount, t.tax_amount, t.net_amount) == (
        Decimal("1860169203.79"), Decimal("92887515.15"), Decimal("74120799.07"), Decimal("1841402487.71"))
    modes = {r.payment_mode: r.revenue for r in visuals.dt_payment_revenue(wh).collect()}
    assert modes == {"CARD": Decimal("411267408.86"), "CASH": Decimal("406093417.07"),
                     "INSURANCE": Decimal("621798303.25"), "UPI": Decimal("402243358.53")}


def test_no_show_rates_months_and_orphans(wh):
    rates = sorted(float(r.no_show_rate) for r in dashboards.page_no_show_dept(wh).collect())
    assert rates == sorted([24.4, 26.2, 25.1, 26.1, 24.2])
    assert visuals.dt_monthly_revenue(wh).count() == 83
    orphans = quality.fk_orphans(wh).filter(F.col("fact_table") == "FACT_APPOINTMENT").count()
    assert orphans == 1983
