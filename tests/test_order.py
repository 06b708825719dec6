"""Row order, which hashes of row sets cannot see: Spark's rows against the oracle's, in sequence."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

#: Ordering columns of every query that promises an order; rows that tie on them may come in any order.
ORDERED = {
    "appt_daily_volume": ["appt_date"],
    "monthly_revenue": ["month"],
    "no_show_rate_by_dept": ["rate"],
    "page_daily_trend": ["appt_date"],
    "page_no_show_dept": ["no_show_rate"],
    "page_dept_volume": ["appointments"],
    "page_revenue_dept": ["total_revenue"],
    "payer_mix": ["total_revenue"],
    "rejection_summary": ["rejected_count"],
    "top_services": ["total_revenue", "service_desc"],
    "top_cities": ["patients", "city"],
    "worst_no_show_doctors": ["no_shows", "doctor_name"],
    "top_insurers": ["total_billed", "insurer_name"],
    "vip_patients": ["full_name"],
    "page_busiest_doctors": ["total_appointments", "doctor_name", "primary_department"],
    "page_top_services": ["revenue", "service_desc", "department"],
    "page_high_value": ["lifetime_net_revenue", "full_name"],
    "page_geo": ["patient_count", "state", "city"],
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, con, name):
    got = [tuple(r[c] for c in ORDERED[name]) for r in E.queries()[name](spark, SF).collect()]
    rel = con.sql(E.oracle_sql()[name])
    at = [rel.columns.index(c) for c in ORDERED[name]]
    assert got == [tuple(r[i] for i in at) for r in rel.fetchall()]
    assert len(set(got)) < 2 or got != got[::-1]


def test_every_ordered_query_is_listed():
    sql = E.oracle_sql()
    ordered = {n for n, s in sql.items() if "ORDER BY" in s.rsplit("FROM", 1)[-1] and not n.startswith("op")}
    assert ordered - {"vip_patients_masked", "dim_doctor", "dim_service"} <= set(ORDERED)


def test_null_totals_come_last(wh_small):
    """O2: patients without a bill stand behind all others."""
    from pyspark.sql import functions as F

    from carelake.plans import dashboards

    fees = wh_small.resolve("fact_billing").filter(F.col("patient_key") % 2 == 0)
    wh = wh_small.with_role(wh_small.role)
    wh._given = wh._given | {"fact_billing": fees.limit(3)}
    got = [r.lifetime_net_revenue for r in dashboards.page_high_value(wh).collect()]
    assert got == sorted(got, key=lambda x: (x is None, -(x or 0)))
