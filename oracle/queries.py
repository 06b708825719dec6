"""Oracle SQL per registered query (DuckDB dialect)."""

from oracle.sql import (
    PREP,
    avg_money,
    core_sql,
    exceptions_sql,
    half_up_ratio,
    iso,
    money,
    rate,
    reasons_sql,
    all_pass,
    with_base,
)

RAW_COLS = {
    "patients": "patient_id, full_name, dob, gender, phone, email, city, state, registration_date",
    "appointments": "appt_id, appt_date, patient_id, doctor_id, doctor_name, department, slot, status",
    "billing": ("bill_id, bill_date, patient_id, service_code, service_desc, department, gross_amount, "
                "discount_amount, tax_amount, net_amount, payment_mode, insurer_name"),
}

CORE_PRESENT = {
    "patients": (f"patient_id, full_name, {iso('dob')} AS dob, gender, phone, email, city, state, "
                 f"{iso('registration_date')} AS registration_date"),
    "appointments": (f"appt_id, {iso('appt_date')} AS appt_date, patient_id, doctor_id, doctor_name, "
                     "department, slot, status"),
    "billing": (f"bill_id, {iso('bill_date')} AS bill_date, patient_id, service_code, service_desc, department, "
                f"{money('gross_amount')} AS gross_amount, {money('discount_amount')} AS discount_amount, "
                f"{money('tax_amount')} AS tax_amount, {money('net_amount')} AS net_amount, payment_mode, "
                "insurer_name"),
}

MERGE_SPLITS = {
    "patients": ("registration_date", "2020-01-01", "2018-01-01"),
    "appointments": ("appt_date", "2024-01-03", "2024-01-02"),
    "billing": ("bill_date", "1999-01-01", "1998-01-01"),
}
KEY = {"patients": "patient_id", "appointments": "appt_id", "billing": "bill_id"}

FACT_APPT_PRESENT = (
    f"appt_id, CAST(date_key AS BIGINT) AS date_key, patient_key, doctor_key, {iso('appt_date')} AS appt_date, "
    "slot, status, department, doctor_name, CAST(is_completed AS BIGINT) AS is_completed, "
    "CAST(is_no_show AS BIGINT) AS is_no_show, CAST(is_cancelled AS BIGINT) AS is_cancelled, "
    "CAST(is_scheduled AS BIGINT) AS is_scheduled"
)
FACT_BILL_PRESENT = (
    f"bill_id, CAST(date_key AS BIGINT) AS date_key, patient_key, {iso('bill_date')} AS bill_date, service_code, "
    f"service_desc, department, {money('gross_amount')} AS gross_amount, "
    f"{money('discount_amount')} AS discount_amount, {money('tax_amount')} AS tax_amount, "
    f"{money('net_amount')} AS net_amount, payment_mode, insurer_name, "
    "CAST(is_insurance AS BIGINT) AS is_insurance, CAST(is_self_pay AS BIGINT) AS is_self_pay, service_key"
)
DIM_PATIENT_PRESENT = (
    f"patient_key, patient_id, full_name, {iso('dob')} AS dob, gender, phone, email, city, state, "
    f"{iso('registration_date')} AS registration_date, CAST(registration_date_key AS BIGINT) AS "
    "registration_date_key, age_group"
)

# masking, exactly as the policies read (non-exempt role)
MASK_PHONE = "CASE WHEN phone IS NULL THEN NULL ELSE '******' || RIGHT(phone, 4) END"
MASK_EMAIL = ("CASE WHEN email IS NULL THEN NULL WHEN strpos(email, '@') > 0 "
              "THEN '****' || substr(email, strpos(email, '@')) ELSE '****' END")
MASK_NAME = "'****'"

DAILY_TREND = f"""
SELECT {iso('fa.appt_date')} AS appt_date, dd.day_name, dd.is_weekend, dd.year_month,
       COUNT(*) AS total_appointments, CAST(SUM(fa.is_completed) AS BIGINT) AS completed_visits,
       CAST(SUM(fa.is_no_show) AS BIGINT) AS no_shows, COUNT(DISTINCT fa.doctor_key) AS unique_doctors,
       {half_up_ratio('COUNT(*)', 'COUNT(DISTINCT fa.doctor_key)', 2)} AS avg_appt_per_doctor
FROM fact_appointment fa JOIN dim_date dd ON fa.date_key = dd.date_key
GROUP BY fa.appt_date, dd.day_name, dd.is_weekend, dd.year_month"""

DOCTOR_PERF = """
SELECT d.doctor_name, d.primary_department, COUNT(*) AS total_appointments,
       CAST(SUM(fa.is_completed) AS BIGINT) AS completed, CAST(SUM(fa.is_no_show) AS BIGINT) AS no_shows,
       COUNT(DISTINCT fa.patient_key) AS unique_patients
FROM fact_appointment fa JOIN dim_doctor d ON fa.doctor_key = d.doctor_key
GROUP BY d.doctor_name, d.primary_department"""

UTILIZATION = f"""
SELECT p.patient_key, p.patient_id, p.full_name, p.age_group,
       COALESCE(a.total_appointments, 0) AS total_appointments,
       COALESCE(a.completed_visits, 0) AS completed_visits,
       COALESCE(b.total_bills, 0) AS total_bills,
       {money('COALESCE(b.lifetime_net_revenue, 0)')} AS lifetime_net_revenue,
       {iso('a.last_visit_date')} AS last_visit_date
FROM dim_patient p
LEFT JOIN (SELECT patient_key, COUNT(*) AS total_appointments, CAST(SUM(is_completed) AS BIGINT) AS completed_visits,
                  MAX(appt_date) AS last_visit_date FROM fact_appointment GROUP BY patient_key) a
       ON p.patient_key = a.patient_key
LEFT JOIN (SELECT patient_key, COUNT(*) AS total_bills, SUM(net_amount) AS lifetime_net_revenue
           FROM fact_billing GROUP BY patient_key) b
       ON p.patient_key = b.patient_key"""

INSURANCE_MIX = f"""
SELECT department, payment_mode, COUNT(*) AS bill_count, {money('SUM(net_amount)')} AS total_net
FROM fact_billing GROUP BY department, payment_mode"""

VIP = """
SELECT p.full_name, COUNT(b.bill_id) AS visits, CAST(SUM(b.net_amount) AS DOUBLE) AS lifetime_spend
FROM fact_billing b JOIN {dim} p ON b.patient_key = p.patient_key
GROUP BY p.full_name
ORDER BY SUM(b.net_amount) DESC, p.full_name ASC NULLS FIRST
LIMIT 10"""


def _merge_sql(d: str) -> str:
    col, hi, lo = MERGE_SPLITS[d]
    extra = [
        ("m_raw1", f"SELECT * FROM raw_{d} WHERE COALESCE({col} < '{hi}', TRUE)"),
        ("m_raw2", f"SELECT * FROM raw_{d} WHERE {col} >= '{lo}'"),
        ("m_prep1", PREP[d]("m_raw1")),
        ("m_prep2", PREP[d]("m_raw2")),
        ("m_b1", core_sql(d, "m_prep1")),
        ("m_b2", core_sql(d, "m_prep2")),
        ("m_out", f"SELECT * FROM m_b1 WHERE {KEY[d]} NOT IN (SELECT {KEY[d]} FROM m_b2) "
                  "UNION ALL SELECT * FROM m_b2"),
    ]
    return with_base(f"SELECT {CORE_PRESENT[d]} FROM m_out", extra)


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    W = with_base
    for d in ("patients", "appointments", "billing"):
        q[f"raw_{d}"] = W(f"SELECT {RAW_COLS[d]} FROM raw_{d}")
        q[f"clean_{d}"] = W(f"SELECT {CORE_PRESENT[d]} FROM prep_{d} WHERE {all_pass(d)}")
        q[f"core_{d}"] = W(f"SELECT {CORE_PRESENT[d]} FROM core_{d}")
        q[f"rejects_{d}"] = W(
            f"SELECT raw_id AS record_id, {reasons_sql(d)} AS rejection_reasons FROM prep_{d} "
            f"WHERE NOT ({all_pass(d)})"
        )
        q[f"merge_{d}"] = _merge_sql(d)
    q["exceptions_log"] = W(" UNION ALL ".join(f"({exceptions_sql(d, f'prep_{d}')})"
                                                 for d in ("patients", "appointments", "billing")))

    # ---- star schema and derived dimensions
    q["dim_patient"] = W(f"SELECT {DIM_PATIENT_PRESENT} FROM dim_patient")
    q["dim_doctor"] = W("SELECT doctor_key, doctor_id, doctor_name, primary_department FROM dim_doctor")
    q["fact_appointment"] = W(f"SELECT {FACT_APPT_PRESENT} FROM fact_appointment")
    q["fact_billing"] = W(f"SELECT {FACT_BILL_PRESENT} FROM fact_billing")
    q["dim_date"] = W(
        f"SELECT CAST(date_key AS BIGINT) AS date_key, {iso('full_date')} AS full_date, CAST(year AS BIGINT) AS year, "
        "CAST(quarter AS BIGINT) AS quarter, CAST(month AS BIGINT) AS month, "
        "CAST(day_of_month AS BIGINT) AS day_of_month, day_name, is_weekend, year_month FROM dim_date"
    )
    q["dim_service"] = W("SELECT service_key, service_code, service_desc FROM dim_service")
    q["dim_department"] = W("SELECT department_key, department FROM dim_department")

    # ---- visuals
    q["dt_dept_appt"] = W("SELECT department, COUNT(*) AS appointments FROM fact_appointment GROUP BY department")
    q["dt_payment_revenue"] = W(
        f"SELECT payment_mode, {money('SUM(net_amount)')} AS revenue FROM fact_billing GROUP BY payment_mode")
    q["dt_monthly_revenue"] = W(
        f"SELECT {iso('CAST(date_trunc(' + chr(39) + 'month' + chr(39) + ', bill_date) AS DATE)')} AS month, "
        f"{money('SUM(net_amount)')} AS revenue FROM fact_billing GROUP BY date_trunc('month', bill_date)")
    q["dt_demographics"] = W(
        "SELECT gender, COUNT(*) AS count FROM dim_patient WHERE gender IS NOT NULL GROUP BY gender")
    q["dt_appt_status"] = W("SELECT status, COUNT(*) AS count FROM fact_appointment GROUP BY status")
    q["dt_top_doctors"] = W(
        "SELECT doctor_name, COUNT(*) AS appointments FROM fact_appointment GROUP BY doctor_name")

    # ---- counted groups
    q["agg_patient_day"] = W(f"""
SELECT patient_key, {iso('appt_date')} AS appt_date, COUNT(*) AS appointments,
       CAST(SUM(is_completed) AS BIGINT) AS completed
FROM fact_appointment GROUP BY patient_key, appt_date""")
    q["agg_day_doctor"] = W(f"""
SELECT CAST(date_key AS BIGINT) AS date_key, {iso('appt_date')} AS appt_date, doctor_key, COUNT(*) AS appointments,
       CAST(SUM(is_completed) AS BIGINT) AS completed, CAST(SUM(is_no_show) AS BIGINT) AS no_shows,
       COUNT(doctor_name) AS named
FROM fact_appointment GROUP BY date_key, appt_date, doctor_key""")
    q["agg_doctor_patient"] = W("""
SELECT doctor_key, patient_key, COUNT(*) AS appointments, CAST(SUM(is_completed) AS BIGINT) AS completed,
       CAST(SUM(is_no_show) AS BIGINT) AS no_shows
FROM fact_appointment GROUP BY doctor_key, patient_key""")
    q["agg_patient_billing"] = W(
        f"SELECT patient_key, COUNT(*) AS bills, {money('SUM(net_amount)')} AS net FROM fact_billing GROUP BY patient_key")
    q["agg_service_day"] = W(f"""
SELECT service_code, {iso('bill_date')} AS bill_date, service_desc, COUNT(*) AS bills
FROM fact_billing GROUP BY service_code, bill_date, service_desc""")

    # ---- materialised views
    q["mv_monthly_revenue"] = W(f"""
SELECT {iso("CAST(date_trunc('month', bill_date) AS DATE)")} AS bill_month, department, payment_mode,
       COUNT(*) AS bill_count, {money('SUM(gross_amount)')} AS total_gross,
       {money('SUM(discount_amount)')} AS total_discount, {money('SUM(tax_amount)')} AS total_tax,
       {money('SUM(net_amount)')} AS total_net, {avg_money('net_amount', None)} AS avg_net
FROM fact_billing GROUP BY date_trunc('month', bill_date), department, payment_mode""")
    q["mv_dept_appt_monthly"] = W(f"""
SELECT {iso("CAST(date_trunc('month', appt_date) AS DATE)")} AS appt_month, department,
       COUNT(*) AS total_appts, CAST(SUM(is_completed) AS BIGINT) AS completed,
       CAST(SUM(is_no_show) AS BIGINT) AS no_shows, CAST(SUM(is_cancelled) AS BIGINT) AS cancelled
FROM fact_appointment GROUP BY date_trunc('month', appt_date), department""")

    # ---- views
    q["vw_patient_utilization"] = W(UTILIZATION)
    q["vw_daily_opd_trend"] = W(DAILY_TREND)
    q["vw_doctor_performance"] = W(DOCTOR_PERF)
    q["vw_revenue_by_department"] = W(f"""
SELECT department, COUNT(bill_id) AS total_bills, {money('SUM(net_amount)')} AS total_revenue,
       {avg_money('net_amount', 2)} AS avg_bill_amount
FROM fact_billing GROUP BY department""")
    q["vw_no_show_analysis"] = W(f"""
SELECT doctor_name, department, COUNT(appt_id) AS total_appointments,
       CAST(SUM(is_no_show) AS BIGINT) AS no_show_count,
       {rate('SUM(is_no_show)', 'COUNT(appt_id)', 2)} AS no_show_percentage
FROM fact_appointment GROUP BY doctor_name, department""")
    q["vw_patient_demographics"] = W(
        "SELECT gender, city, state, COUNT(patient_id) AS total_patients FROM dim_patient GROUP BY gender, city, state")
    q["vw_top_insurers"] = W(f"""
SELECT insurer_name, COUNT(bill_id) AS bill_count, {money('SUM(net_amount)')} AS total_insurance_billed
FROM fact_billing WHERE is_insurance = 1 AND insurer_name IS NOT NULL GROUP BY insurer_name""")
    q["vw_daily_clinic_roster"] = W(f"""
SELECT {iso('a.appt_date')} AS appt_date, a.slot, p.full_name AS patient_name, a.doctor_name, a.department, a.status
FROM fact_appointment a JOIN dim_patient p ON a.patient_key = p.patient_key
WHERE a.is_scheduled = 1 OR a.is_completed = 1""")
    q["vw_high_value_patients"] = W(f"""
SELECT p.patient_id, p.full_name, p.phone, p.email, COUNT(b.bill_id) AS total_visits,
       {money('SUM(b.net_amount)')} AS lifetime_value
FROM fact_billing b JOIN dim_patient p ON b.patient_key = p.patient_key
GROUP BY p.patient_id, p.full_name, p.phone, p.email""")
    q["vw_insurance_mix"] = W(INSURANCE_MIX)

    # ---- landing format
    q["csv_scan_nulls"] = W("""
SELECT patient_id, full_name, gender, CASE WHEN CAST(patient_id AS BIGINT) % 7 <> 3 THEN city END AS city,
       CASE WHEN CAST(patient_id AS BIGINT) % 5 <> 0 THEN email END AS email
FROM raw_patients""")

    # ---- validation and integrity
    q["raw_row_counts"] = W("""
SELECT 'RAW_PATIENTS' AS tbl, COUNT(*) AS cnt FROM raw_patients
UNION ALL SELECT 'RAW_APPOINTMENTS', COUNT(*) FROM raw_appointments
UNION ALL SELECT 'RAW_BILLING', COUNT(*) FROM raw_billing""")
    q["layer_pass_rate"] = W(" UNION ALL ".join(
        f"SELECT '{d.upper()}' AS domain, (SELECT COUNT(*) FROM raw_{d}) AS raw_count, "
        f"(SELECT COUNT(*) FROM core_{d}) AS core_count, "
        f"{rate(f'(SELECT COUNT(*) FROM core_{d})', f'(SELECT COUNT(*) FROM raw_{d})', 1)} AS pass_rate_pct"
        for d in ("patients", "appointments", "billing")))
    q["rejection_summary"] = W(
        "SELECT source_table, rejection_reason, COUNT(*) AS rejected_count FROM ("
        + " UNION ALL ".join(f"({exceptions_sql(d, f'prep_{d}')})" for d in ("patients", "appointments", "billing"))
        + ") e GROUP BY source_table, rejection_reason ORDER BY rejected_count DESC")
    q["dim_duplicate_keys"] = W("""
SELECT 'DIM_PATIENT' AS tbl, patient_key AS dim_key, COUNT(*) AS cnt FROM dim_patient GROUP BY 1, 2 HAVING COUNT(*) > 1
UNION ALL
SELECT 'DIM_DOCTOR', doctor_key, COUNT(*) AS cnt FROM dim_doctor GROUP BY 1, 2 HAVING COUNT(*) > 1""")
    q["core_duplicate_keys"] = W(" UNION ALL ".join(
        f"SELECT 'CORE_{d.upper()}' AS tbl, {k} AS core_key, COUNT(*) AS cnt FROM core_{d} GROUP BY {k} HAVING COUNT(*) > 1"
        for d, k in (("patients", "patient_id"), ("appointments", "appt_id"), ("billing", "bill_id"))))
    q["null_fk_check"] = W("""
SELECT 'FACT_APPOINTMENT' AS fact_table, 'NULL_PATIENT_FK' AS issue, COUNT(*) AS cnt
FROM fact_appointment WHERE patient_key IS NULL
UNION ALL
SELECT 'FACT_BILLING', 'NULL_PATIENT_FK', COUNT(*) FROM fact_billing WHERE patient_key IS NULL""")
    q["negative_amounts"] = W(
        "SELECT COUNT(*) AS negative_amounts FROM core_billing WHERE gross_amount < 0 OR net_amount < 0")
    q["fk_valid_appointments"] = W(
        f"SELECT {FACT_APPT_PRESENT} FROM fact_appointment "
        "WHERE patient_key IN (SELECT patient_key FROM dim_patient)")
    q["fk_valid_billing"] = W(
        f"SELECT {FACT_BILL_PRESENT} FROM fact_billing WHERE patient_key IN (SELECT patient_key FROM dim_patient)")
    q["fk_orphans"] = W("""
SELECT 'FACT_APPOINTMENT' AS fact_table, appt_id AS record_id, patient_key FROM fact_appointment
WHERE patient_key NOT IN (SELECT patient_key FROM dim_patient)
UNION ALL
SELECT 'FACT_BILLING', bill_id, patient_key FROM fact_billing
WHERE patient_key NOT IN (SELECT patient_key FROM dim_patient)""")

    # ---- KPI
    q["exec_kpi"] = W(f"""
SELECT COUNT(DISTINCT appt_id) AS total_appointments, CAST(SUM(is_completed) AS BIGINT) AS completed_visits,
       CAST(SUM(is_no_show) AS BIGINT) AS total_no_shows,
       {rate('SUM(is_completed)', 'COUNT(*)', 1)} AS completion_rate_pct,
       COUNT(DISTINCT patient_key) AS unique_patients
FROM fact_appointment""")
    q["revenue_totals"] = W(f"""
SELECT COUNT(DISTINCT bill_id) AS total_bills, {money('SUM(gross_amount)')} AS total_gross_revenue,
       {money('SUM(net_amount)')} AS total_net_revenue, {avg_money('net_amount', 2)} AS avg_bill_value,
       {money('SUM(discount_amount)')} AS total_discounts
FROM fact_billing""")
    q["payer_mix"] = W(f"""
SELECT payment_mode, insurer, bill_count, {money('total_revenue')} AS total_revenue,
       {half_up_ratio('CAST(total_revenue * 100 AS HUGEINT)', 'CAST(SUM(total_revenue) OVER () * 100 AS HUGEINT)', 2, 100)}
         AS revenue_share_pct
FROM (SELECT payment_mode, COALESCE(insurer_name, 'Self-Pay') AS insurer, COUNT(*) AS bill_count,
             SUM(net_amount) AS total_revenue
      FROM fact_billing GROUP BY payment_mode, COALESCE(insurer_name, 'Self-Pay')) g
ORDER BY total_revenue DESC""")
    q["top_services"] = W(f"""
SELECT svc.service_desc, COUNT(*) AS bill_count, {money('SUM(fb.net_amount)')} AS total_revenue
FROM fact_billing fb JOIN dim_service svc ON fb.service_key = svc.service_key
GROUP BY svc.service_desc
ORDER BY SUM(fb.net_amount) DESC, svc.service_desc ASC NULLS FIRST LIMIT 10""")

    # ---- tabbed dashboard
    q["appt_totals"] = W("""
SELECT COUNT(*) AS total, CAST(SUM(is_completed) AS BIGINT) AS comp, CAST(SUM(is_cancelled) AS BIGINT) AS canc
FROM fact_appointment""")
    q["appt_daily_volume"] = W(
        f"SELECT {iso('appt_date')} AS appt_date, COUNT(*) AS volume FROM fact_appointment "
        "GROUP BY appt_date ORDER BY appt_date")
    q["dept_workload"] = q["dt_dept_appt"]
    q["revenue_avg"] = W(
        f"SELECT {money('SUM(net_amount)')} AS total, {avg_money('net_amount', None)} AS avg_bill FROM fact_billing")
    q["monthly_revenue"] = W(
        f"SELECT strftime(date_trunc('month', bill_date), '%Y-%m') AS month, {money('SUM(net_amount)')} AS revenue "
        "FROM fact_billing GROUP BY date_trunc('month', bill_date) ORDER BY month")
    q["payment_revenue"] = q["dt_payment_revenue"]
    q["patient_city_counts"] = W("SELECT COUNT(*) AS total, COUNT(DISTINCT city) AS cities FROM dim_patient")
    q["gender_counts"] = q["dt_demographics"]
    q["top_cities"] = W("""
SELECT city, COUNT(*) AS patients FROM dim_patient WHERE city IS NOT NULL GROUP BY city
ORDER BY patients DESC, city ASC NULLS FIRST LIMIT 10""")
    q["no_show_rate"] = W(
        f"SELECT CAST(SUM(is_no_show) AS BIGINT) AS noshows, {rate('SUM(is_no_show)', 'COUNT(*)', 2)} AS rate "
        "FROM fact_appointment")
    q["no_show_rate_by_dept"] = W(f"""
SELECT department, rate FROM (
  SELECT department, {rate('SUM(is_no_show)', 'COUNT(*)', 1)} AS rate FROM fact_appointment GROUP BY department) t
WHERE rate > 0 ORDER BY rate DESC""")
    q["worst_no_show_doctors"] = W("""
SELECT doctor_name, CAST(SUM(is_no_show) AS BIGINT) AS no_shows FROM fact_appointment GROUP BY doctor_name
HAVING SUM(is_no_show) > 0 ORDER BY no_shows DESC, doctor_name ASC NULLS FIRST LIMIT 7""")
    q["top_insurers"] = W(f"""
SELECT insurer_name, {money('SUM(net_amount)')} AS total_billed FROM fact_billing
WHERE is_insurance = 1 AND insurer_name IS NOT NULL GROUP BY insurer_name
ORDER BY SUM(net_amount) DESC, insurer_name ASC NULLS FIRST LIMIT 8""")
    q["vip_patients"] = W(VIP.format(dim="dim_patient"))

    # ---- page dashboard
    q["page_appt_kpi"] = W(f"""
SELECT COUNT(DISTINCT appt_id) AS total_appointments, CAST(SUM(is_completed) AS BIGINT) AS completed_visits,
       {rate('SUM(is_completed)', 'COUNT(*)', 1)} AS completion_rate_pct,
       COUNT(DISTINCT patient_key) AS unique_patients
FROM fact_appointment""")
    q["page_revenue_kpi"] = W(f"""
SELECT {money('SUM(gross_amount)')} AS total_gross_revenue, {money('SUM(net_amount)')} AS total_net_revenue,
       {avg_money('net_amount', 2)} AS avg_bill_value
FROM fact_billing""")
    q["page_dept_volume"] = W(
        "SELECT department, COUNT(*) AS appointments FROM fact_appointment GROUP BY department "
        "ORDER BY appointments DESC")
    q["page_payment_revenue"] = q["dt_payment_revenue"]
    q["page_daily_trend"] = W(DAILY_TREND + " ORDER BY appt_date")
    q["page_no_show_dept"] = W(f"""
SELECT department, {rate('SUM(is_no_show)', 'COUNT(*)', 1)} AS no_show_rate FROM fact_appointment
GROUP BY department ORDER BY no_show_rate DESC""")
    q["page_busiest_doctors"] = W(f"""
SELECT doctor_name, primary_department, total_appointments FROM ({DOCTOR_PERF}) v
ORDER BY total_appointments DESC, doctor_name ASC NULLS FIRST, primary_department ASC NULLS FIRST LIMIT 10""")
    q["page_revenue_dept"] = W(
        f"SELECT department, {money('SUM(net_amount)')} AS total_revenue FROM fact_billing GROUP BY department "
        "ORDER BY SUM(net_amount) DESC")
    q["page_insurance_mix"] = W(INSURANCE_MIX)
    q["page_top_services"] = W(f"""
SELECT svc.service_desc, fb.department, {money('SUM(fb.net_amount)')} AS revenue
FROM fact_billing fb JOIN dim_service svc ON fb.service_key = svc.service_key
GROUP BY svc.service_desc, fb.department
ORDER BY SUM(fb.net_amount) DESC, svc.service_desc ASC NULLS FIRST, fb.department ASC NULLS FIRST LIMIT 10""")
    q["page_age_groups"] = W("SELECT age_group, COUNT(*) AS patient_count FROM dim_patient GROUP BY age_group")
    q["page_high_value"] = W(f"""
SELECT full_name, lifetime_net_revenue, total_appointments, age_group FROM ({UTILIZATION}) v
ORDER BY lifetime_net_revenue DESC NULLS LAST, patient_key ASC NULLS FIRST LIMIT 10""")
    q["page_geo"] = W("""
SELECT state, city, COUNT(*) AS patient_count FROM dim_patient GROUP BY state, city
ORDER BY patient_count DESC, state ASC NULLS FIRST, city ASC NULLS FIRST LIMIT 15""")

    # ---- masking
    q["mask_phone"] = W(f"SELECT patient_id, {MASK_PHONE} AS phone FROM core_patients")
    q["mask_email"] = W(f"SELECT patient_id, {MASK_EMAIL} AS email FROM core_patients")
    q["mask_name"] = W(f"SELECT patient_id, {MASK_NAME} AS full_name FROM core_patients")
    q["core_patients_masked"] = W(
        f"SELECT patient_id, {MASK_NAME} AS full_name, {MASK_PHONE} AS phone, {MASK_EMAIL} AS email, city, state "
        "FROM core_patients")
    q["dim_patient_masked"] = W(
        f"SELECT patient_key, patient_id, {MASK_NAME} AS full_name, {MASK_PHONE} AS phone, {MASK_EMAIL} AS email, "
        "age_group FROM dim_patient")
    q["vip_patients_masked"] = W(VIP.format(dim=f"(SELECT patient_key, {MASK_NAME} AS full_name FROM dim_patient)"))
    return q

