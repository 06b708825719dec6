"""Every registered query: name -> function(Warehouse) -> DataFrame.

Tables are exposed with their business columns (audit timestamps are
process-dependent and left out).  The names follow the operator inventory.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.constants import EXEMPT_ROLES_STRICT
from carelake.operators import clean as C
from carelake.operators.merge import upsert
from carelake.plans.registry import BUILDERS, QUERIES
from carelake.schemas import KEYS, RAW_COLUMNS

PUBLIC_ROLE = "PUBLIC"
VIEWER_ROLE = "HOSPITAL_VIEWER_ROLE"

# Two loads per domain with an overlapping re-delivery window, split on the
# record's own ISO date text: (date column, batch-1 upper bound, batch-2 lower bound).
MERGE_SPLITS = {
    "patients": ("registration_date", "2020-01-01", "2018-01-01"),
    "appointments": ("appt_date", "2024-01-03", "2024-01-02"),
    "billing": ("bill_date", "1999-01-01", "1998-01-01"),
}


def _table(name: str, columns=None):
    def q(wh) -> DataFrame:
        df = wh.table(name)
        return df.select(*columns) if columns else df

    q.__name__ = name
    return q


def _business(domain: str):
    return C.core_columns(domain)


def _clean(domain: str):
    def q(wh) -> DataFrame:
        return C.valid_rows(domain, wh.resolve(f"prepared_{domain}")).select(*_business(domain))

    return q


def _rejects(domain: str):
    def q(wh) -> DataFrame:
        r = wh.resolve(f"rejects_{domain}")
        return r.select(F.col("_raw_id").alias("record_id"), F.array_join("_reasons", ",").alias("rejection_reasons"))

    return q


def _merge(domain: str):
    col, hi, lo = MERGE_SPLITS[domain]

    def q(wh) -> DataFrame:
        raw = wh.resolve(f"raw_{domain}")
        first = raw.filter(F.coalesce(F.col(col) < F.lit(hi), F.lit(True)))
        second = raw.filter(F.col(col) >= F.lit(lo))
        t1 = C.clean(domain, C.prepare(domain, first)).withColumn("_cleaned_at", F.lit(None).cast("timestamp_ntz"))
        b2 = C.clean(domain, C.prepare(domain, second))
        return upsert(t1, b2, KEYS[domain]).select(*_business(domain))

    return q


def _masked(name: str, columns, role: str, exempt=None):
    def q(wh) -> DataFrame:
        return wh.with_role(role, exempt).table(name).select(*columns)

    return q


def _vip_masked(wh) -> DataFrame:
    from carelake.plans.dashboards import vip_patients

    return vip_patients(wh.with_role(VIEWER_ROLE, EXEMPT_ROLES_STRICT))


def _exceptions_log(wh) -> DataFrame:
    return wh.table("exceptions").select("source_table", "record_id", "rejection_reason", "reviewed")


def catalog() -> dict:
    q = {}
    for d in ("patients", "appointments", "billing"):
        q[f"raw_{d}"] = _table(f"raw_{d}", RAW_COLUMNS[d])
        q[f"clean_{d}"] = _clean(d)
        q[f"core_{d}"] = _table(f"core_{d}", _business(d))
        q[f"rejects_{d}"] = _rejects(d)
        q[f"merge_{d}"] = _merge(d)
    q["exceptions_log"] = _exceptions_log
    for name in BUILDERS:
        if name.startswith(("prepared_", "core_", "rejects_")) or name == "exceptions":
            continue
        q[name] = _table(name)
    q.update(QUERIES)
    pii = ["patient_id", "full_name", "phone", "email"]
    q["mask_phone"] = _masked("core_patients", ["patient_id", "phone"], PUBLIC_ROLE)
    q["mask_email"] = _masked("core_patients", ["patient_id", "email"], PUBLIC_ROLE)
    q["mask_name"] = _masked("core_patients", ["patient_id", "full_name"], PUBLIC_ROLE)
    q["core_patients_masked"] = _masked("core_patients", pii + ["city", "state"], PUBLIC_ROLE)
    q["dim_patient_masked"] = _masked("dim_patient", ["patient_key"] + pii + ["age_group"], VIEWER_ROLE, EXEMPT_ROLES_STRICT)
    q["vip_patients_masked"] = _vip_masked
    return q
