"""The dashboards' SQL strings run unchanged over registered views."""


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dashboard_sql_strings(spark, wh_small):
    from carelake.plans import dashboards, visuals

    got = wh_small.sql(
        "SELECT DEPARTMENT, ROUND(SUM(IS_NO_SHOW)*100.0/NULLIF(COUNT(*),0), 1) AS RATE "
        "FROM FACT_APPOINTMENT GROUP BY DEPARTMENT HAVING RATE > 0 ORDER BY RATE DESC")
    want = dashboards.no_show_rate_by_dept(wh_small)
    assert [(r[0], float(r[1])) for r in _rows(got)] == [(r[0], float(r[1])) for r in _rows(want)]
    got = wh_small.sql("SELECT PAYMENT_MODE, SUM(NET_AMOUNT) AS REVENUE FROM FACT_BILLING GROUP BY PAYMENT_MODE")
    assert _rows(got) == _rows(visuals.dt_payment_revenue(wh_small))


def test_validation_sql_with_ordinals(spark, wh_small):
    df = wh_small.sql(
        "SELECT 'DIM_PATIENT' AS TBL, PATIENT_KEY, COUNT(*) AS CNT FROM DIM_PATIENT GROUP BY 1,2 HAVING CNT > 1 "
        "UNION ALL SELECT 'DIM_DOCTOR', DOCTOR_KEY, COUNT(*) AS CNT FROM DIM_DOCTOR GROUP BY 1,2 HAVING CNT > 1")
    assert df.count() == 0
