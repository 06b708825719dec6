"""DuckDB SQL text for the oracle (see package docstring)."""

# ------------------------------------------------------------------ RAW
RAW_PATIENTS = """
SELECT CAST(c.c_custkey AS VARCHAR) AS patient_id,
       'Patient ' || CAST(c.c_custkey % 400 AS VARCHAR) AS full_name,
       CASE WHEN c.c_custkey % 20 = 0 THEN '31/02/1995'
            WHEN c.c_custkey % 20 = 1
                 THEN strftime(DATE '1950-01-01' + CAST((c.c_custkey * 37) % 20000 AS INTEGER), '%d/%m/%Y')
            ELSE strftime(DATE '1950-01-01' + CAST((c.c_custkey * 37) % 20000 AS INTEGER), '%Y-%m-%d') END AS dob,
       CASE c.c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' END AS gender,
       CASE WHEN c.c_custkey % 10 = 3 THEN '12345' ELSE CAST(9000000000 + c.c_custkey AS VARCHAR) END AS phone,
       CASE WHEN c.c_custkey % 10 = 7 THEN 'p' || CAST(c.c_custkey AS VARCHAR) || '[at]example.com'
            ELSE 'p' || CAST(c.c_custkey AS VARCHAR) || '@example.com' END AS email,
       n.n_name AS city,
       r.r_name AS state,
       strftime(DATE '2015-01-01' + CAST((c.c_custkey * 13) % 3000 AS INTEGER), '%Y-%m-%d') AS registration_date
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

RAW_APPOINTMENTS = """
SELECT CAST(e.event_id AS VARCHAR) AS appt_id,
       strftime(e.ts, '%Y-%m-%d') AS appt_date,
       CAST(e.user_id AS VARCHAR) AS patient_id,
       CAST(e.event_id % 10 AS VARCHAR) AS doctor_id,
       s.s_name AS doctor_name,
       'Dept ' || CAST(e.user_id % 5 AS VARCHAR) AS department,
       CASE e.event_id % 4 WHEN 0 THEN 'Morning' WHEN 1 THEN 'Afternoon' WHEN 2 THEN 'Evening' END AS slot,
       CASE e.event_type WHEN 'signup' THEN ' scheduled ' WHEN 'purchase' THEN 'Completed'
                         WHEN 'error' THEN 'No-Show' WHEN 'view' THEN 'CANCELLED'
                         WHEN 'click' THEN 'Unknown' END AS status
FROM events e
JOIN supplier s ON e.event_id % 10 = s.s_suppkey
"""

RAW_BILLING = """
SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) AS bill_id,
       strftime(l.l_shipdate, '%Y-%m-%d') AS bill_date,
       CAST(o.o_custkey AS VARCHAR) AS patient_id,
       p.p_type AS service_code,
       p.p_type || ' service' AS service_desc,
       'Dept ' || CAST(l.l_partkey % 5 AS VARCHAR) AS department,
       CAST(CASE WHEN l.l_partkey % 20 = 0 THEN -CAST(l.l_extendedprice AS DECIMAL(12,2))
                 ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END AS VARCHAR) AS gross_amount,
       CASE WHEN l.l_discount = 0 THEN NULL ELSE CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
            * CAST(l.l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS VARCHAR) END AS discount_amount,
       CASE WHEN l.l_tax = 0 THEN NULL ELSE CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
            * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS VARCHAR) END AS tax_amount,
       CAST(CASE WHEN l.l_partkey % 20 = 0 THEN -CAST(l.l_extendedprice AS DECIMAL(12,2))
                 ELSE CAST(l.l_extendedprice AS DECIMAL(12,2)) END AS VARCHAR) AS net_amount,
       CASE l.l_returnflag || l.l_linestatus WHEN 'AF' THEN 'Cash' WHEN 'AO' THEN 'Card' WHEN 'NF' THEN 'UPI'
            WHEN 'NO' THEN 'Insurance' WHEN 'RF' THEN 'Insurance' WHEN 'RO' THEN 'Cheque' END AS payment_mode,
       CASE WHEN l.l_returnflag || l.l_linestatus = 'NO' THEN 'Insurer ' || CAST(l.l_suppkey % 7 AS VARCHAR)
            WHEN l.l_returnflag || l.l_linestatus = 'RF' AND l.l_suppkey % 2 = 0
                 THEN 'Insurer ' || CAST(l.l_suppkey % 7 AS VARCHAR) END AS insurer_name
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

# --------------------------------------------------------------- parsing
ID = "TRY_CAST(TRY_CAST({c} AS DECIMAL(38,0)) AS BIGINT)"


def _id(c: str) -> str:
    return ID.format(c=c)


def _date(c: str, fmt: str = "%Y-%m-%d") -> str:
    return f"CAST(TRY_STRPTIME({c}, '{fmt}') AS DATE)"


def prep_patients(src: str) -> str:
    return f"""
SELECT {_id('patient_id')} AS patient_id, TRIM(full_name) AS full_name,
       COALESCE({_date('dob')}, {_date('dob', '%d/%m/%Y')}) AS dob,
       TRIM(gender) AS gender, TRIM(phone) AS phone, TRIM(email) AS email,
       TRIM(city) AS city, TRIM(state) AS state, {_date('registration_date')} AS registration_date,
       patient_id AS raw_id, email AS raw_email, phone AS raw_phone
FROM {src}"""


def prep_appointments(src: str) -> str:
    return f"""
SELECT {_id('appt_id')} AS appt_id, {_date('appt_date')} AS appt_date,
       {_id('patient_id')} AS patient_id, {_id('doctor_id')} AS doctor_id,
       TRIM(doctor_name) AS doctor_name, TRIM(department) AS department, TRIM(slot) AS slot,
       UPPER(TRIM(status)) AS status, appt_id AS raw_id
FROM {src}"""


def prep_billing(src: str) -> str:
    return f"""
SELECT bill_id, bill_date, patient_id, service_code, service_desc, department,
       gross_amount, discount_amount, tax_amount,
       CAST(ROUND(gross_amount - discount_amount + tax_amount, 2) AS DECIMAL(12,2)) AS net_amount,
       payment_mode, insurer_name, raw_id
FROM (
  SELECT {_id('bill_id')} AS bill_id, {_date('bill_date')} AS bill_date, {_id('patient_id')} AS patient_id,
         TRIM(service_code) AS service_code, TRIM(service_desc) AS service_desc, TRIM(department) AS department,
         TRY_CAST(gross_amount AS DECIMAL(12,2)) AS gross_amount,
         COALESCE(TRY_CAST(discount_amount AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2))) AS discount_amount,
         COALESCE(TRY_CAST(tax_amount AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2))) AS tax_amount,
         UPPER(TRIM(payment_mode)) AS payment_mode, TRIM(insurer_name) AS insurer_name, bill_id AS raw_id
  FROM {src}) t"""


# (reason, pass predicate) in rule order
RULES = {
    "patients": [
        ("INVALID_PATIENT_ID", "patient_id IS NOT NULL"),
        ("MISSING_FULL_NAME", "full_name IS NOT NULL"),
        ("INVALID_DOB", "dob IS NOT NULL"),
        ("INVALID_EMAIL", "raw_email IS NULL OR raw_email LIKE '%@%'"),
        ("INVALID_PHONE", "raw_phone IS NULL OR LENGTH(TRIM(raw_phone)) >= 10"),
    ],
    "appointments": [
        ("INVALID_APPT_ID", "appt_id IS NOT NULL"),
        ("INVALID_APPT_DATE", "appt_date IS NOT NULL"),
        ("INVALID_PATIENT_ID", "patient_id IS NOT NULL"),
        ("INVALID_DOCTOR_ID", "doctor_id IS NOT NULL"),
        ("INVALID_STATUS", "status IN ('SCHEDULED', 'COMPLETED', 'NO-SHOW', 'CANCELLED')"),
    ],
    "billing": [
        ("INVALID_BILL_ID", "bill_id IS NOT NULL"),
        ("INVALID_BILL_DATE", "bill_date IS NOT NULL"),
        ("INVALID_PATIENT_ID", "patient_id IS NOT NULL"),
        ("MISSING_SERVICE_CODE", "service_code IS NOT NULL"),
        ("INVALID_GROSS_AMOUNT", "gross_amount IS NOT NULL"),
        ("NEGATIVE_GROSS_AMOUNT", "gross_amount IS NULL OR gross_amount >= 0"),
        ("NEGATIVE_NET_AMOUNT", "net_amount IS NULL OR net_amount >= 0"),
        ("INVALID_PAYMENT_MODE", "payment_mode IN ('CASH', 'CARD', 'UPI', 'INSURANCE')"),
        ("MISSING_INSURER", "COALESCE(payment_mode, '') <> 'INSURANCE' OR insurer_name IS NOT NULL"),
    ],
}

KEY = {"patients": "patient_id", "appointments": "appt_id", "billing": "bill_id"}
SOURCE = {"patients": "RAW_PATIENTS", "appointments": "RAW_APPOINTMENTS", "billing": "RAW_BILLING"}
CORE_COLS = {
    "patients": "patient_id, full_name, dob, gender, phone, email, city, state, registration_date",
    "appointments": "appt_id, appt_date, patient_id, doctor_id, doctor_name, department, slot, status",
    "billing": ("bill_id, bill_date, patient_id, service_code, service_desc, department, gross_amount, "
                "discount_amount, tax_amount, net_amount, payment_mode, insurer_name"),
}
DEDUP = {
    "patients": ("full_name ASC NULLS FIRST, dob DESC NULLS LAST, gender ASC NULLS FIRST, phone ASC NULLS FIRST, "
                 "email ASC NULLS FIRST, city ASC NULLS FIRST, state ASC NULLS FIRST, "
                 "registration_date DESC NULLS LAST"),
    "appointments": ("appt_date DESC NULLS LAST, patient_id ASC NULLS FIRST, doctor_id ASC NULLS FIRST, "
                     "doctor_name ASC NULLS FIRST, department ASC NULLS FIRST, slot ASC NULLS FIRST, "
                     "status ASC NULLS FIRST"),
    "billing": ("bill_date DESC NULLS LAST, gross_amount DESC NULLS LAST, discount_amount DESC NULLS LAST, "
                "tax_amount DESC NULLS LAST, service_code ASC NULLS FIRST, payment_mode ASC NULLS FIRST, "
                "insurer_name ASC NULLS FIRST, department ASC NULLS FIRST, patient_id ASC NULLS FIRST, "
                "service_desc ASC NULLS FIRST"),
}
PREP = {"patients": prep_patients, "appointments": prep_appointments, "billing": prep_billing}
RAW = {"patients": RAW_PATIENTS, "appointments": RAW_APPOINTMENTS, "billing": RAW_BILLING}


def all_pass(domain: str) -> str:
    return " AND ".join(f"COALESCE(({p}), FALSE)" for _, p in RULES[domain])


def core_sql(domain: str, prep: str) -> str:
    return f"""
SELECT {CORE_COLS[domain]} FROM {prep}
WHERE {all_pass(domain)}
QUALIFY ROW_NUMBER() OVER (PARTITION BY {KEY[domain]} ORDER BY {DEDUP[domain]}) = 1"""


def reasons_sql(domain: str) -> str:
    parts = ", ".join(f"CASE WHEN NOT COALESCE(({p}), FALSE) THEN '{r}' END" for r, p in RULES[domain])
    return f"concat_ws(',', {parts})"


def exceptions_sql(domain: str, prep: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{SOURCE[domain]}' AS source_table, raw_id AS record_id, '{r}' AS rejection_reason, "
        f"FALSE AS reviewed FROM {prep} WHERE NOT COALESCE(({p}), FALSE)"
        for r, p in RULES[domain]
    )


# ------------------------------------------------------------------- MART
DIM_PATIENT = """
SELECT patient_id AS patient_key, patient_id, full_name, dob, gender, phone, email, city, state,
       registration_date, CAST(strftime(registration_date, '%Y%m%d') AS INTEGER) AS registration_date_key,
       CASE WHEN dob IS NULL THEN NULL
            WHEN (20260101 - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) // 10000 >= 66 THEN '66+'
            WHEN (20260101 - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) // 10000 >= 51 THEN '51-65'
            WHEN (20260101 - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) // 10000 >= 36 THEN '36-50'
            WHEN (20260101 - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) // 10000 >= 18 THEN '18-35'
            WHEN (20260101 - CAST(strftime(dob, '%Y%m%d') AS INTEGER)) // 10000 >= 0 THEN '0-17' END AS age_group
FROM core_patients"""

DIM_DOCTOR = """
SELECT doctor_id AS doctor_key, doctor_id, doctor_name, department AS primary_department
FROM core_appointments
WHERE doctor_id IS NOT NULL AND doctor_name IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY doctor_id ORDER BY appt_date DESC, appt_id DESC) = 1"""

FACT_APPOINTMENT = """
SELECT appt_id, CAST(strftime(appt_date, '%Y%m%d') AS INTEGER) AS date_key, patient_id AS patient_key,
       doctor_id AS doctor_key, appt_date, slot, status, department, doctor_name,
       CASE WHEN UPPER(status) = 'COMPLETED' THEN 1 ELSE 0 END AS is_completed,
       CASE WHEN UPPER(status) = 'NO-SHOW' THEN 1 ELSE 0 END AS is_no_show,
       CASE WHEN UPPER(status) = 'CANCELLED' THEN 1 ELSE 0 END AS is_cancelled,
       CASE WHEN UPPER(status) = 'SCHEDULED' THEN 1 ELSE 0 END AS is_scheduled
FROM core_appointments"""

FACT_BILLING = """
SELECT bill_id, CAST(strftime(bill_date, '%Y%m%d') AS INTEGER) AS date_key, patient_id AS patient_key,
       bill_date, service_code, service_desc, department, gross_amount, discount_amount, tax_amount,
       net_amount, payment_mode, insurer_name,
       CASE WHEN UPPER(payment_mode) = 'INSURANCE' THEN 1 ELSE 0 END AS is_insurance,
       CASE WHEN UPPER(payment_mode) <> 'INSURANCE' THEN 1 ELSE 0 END AS is_self_pay,
       service_code AS service_key
FROM core_billing"""

DIM_DATE = """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
       year(full_date) AS year, quarter(full_date) AS quarter, month(full_date) AS month,
       day(full_date) AS day_of_month, dayname(full_date) AS day_name,
       dayofweek(full_date) IN (0, 6) AS is_weekend, strftime(full_date, '%Y-%m') AS year_month
FROM (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
         AS full_date
  FROM (SELECT min(d) AS lo, max(d) AS hi
        FROM (SELECT appt_date AS d FROM fact_appointment UNION ALL SELECT bill_date FROM fact_billing) u) s
  WHERE lo IS NOT NULL) g"""

DIM_SERVICE = """
SELECT service_code AS service_key, service_code, service_desc FROM fact_billing
QUALIFY ROW_NUMBER() OVER (PARTITION BY service_code ORDER BY bill_date DESC NULLS LAST,
                                                             service_desc ASC NULLS FIRST) = 1"""

DIM_DEPARTMENT = """
SELECT DISTINCT department AS department_key, department
FROM (SELECT department FROM fact_appointment UNION ALL SELECT department FROM fact_billing) u
WHERE department IS NOT NULL"""


def base_ctes() -> list[tuple[str, str]]:
    ctes = []
    for d in ("patients", "appointments", "billing"):
        ctes.append((f"raw_{d}", RAW[d]))
        ctes.append((f"prep_{d}", PREP[d](f"raw_{d}")))
        ctes.append((f"core_{d}", core_sql(d, f"prep_{d}")))
    ctes += [
        ("dim_patient", DIM_PATIENT),
        ("dim_doctor", DIM_DOCTOR),
        ("fact_appointment", FACT_APPOINTMENT),
        ("fact_billing", FACT_BILLING),
        ("dim_date", DIM_DATE),
        ("dim_service", DIM_SERVICE),
        ("dim_department", DIM_DEPARTMENT),
    ]
    return ctes


def with_base(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = base_ctes() + (extra or [])
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body


# ------------------------------------------------------ exact presentation
def money(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def half_up_ratio(num: str, den: str, scale: int, mult: int = 1) -> str:
    """DOUBLE of HALF_UP(mult * num / den, scale) for num >= 0, den > 0; NULL when den = 0."""
    p = 10 ** scale
    return (f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST((2 * CAST({num} AS HUGEINT) * {mult * p} + ({den})) "
            f"// (2 * CAST({den} AS HUGEINT)) AS DOUBLE) / {p} END")


def rate(num: str, den: str, scale: int) -> str:
    return half_up_ratio(num, den, scale, 100)


def avg_money(col: str, scale: int | None) -> str:
    """Spark's AVG(decimal(12,2)) -> decimal(16,6) (HALF_UP), then optionally ROUND(scale)."""
    cents = f"CAST(SUM({col}) * 100 AS HUGEINT)"
    cnt = f"COUNT({col})"
    micros = f"((2 * {cents} * 10000 + {cnt}) // (2 * {cnt}))"
    if scale is None:
        return f"CASE WHEN {cnt} = 0 THEN NULL ELSE CAST({micros} AS DOUBLE) / 1000000 END"
    q = 10 ** (6 - scale)
    return (f"CASE WHEN {cnt} = 0 THEN NULL ELSE CAST((2 * {micros} + {q}) // (2 * {q}) AS DOUBLE) "
            f"/ {10 ** scale} END")
