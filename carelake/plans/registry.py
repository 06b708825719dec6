"""Table builders (what a Warehouse can derive) and query catalogue."""

from carelake.constants import DOMAINS
from carelake.plans import core, counted, dashboards, kpi, landing, mart, matviews, quality, views, visuals

BUILDERS = {}
for _d in DOMAINS:
    BUILDERS[f"prepared_{_d}"] = core.prepared(_d)
    BUILDERS[f"core_{_d}"] = core.core(_d)
    BUILDERS[f"rejects_{_d}"] = core.rejects(_d)
BUILDERS["exceptions"] = core.exceptions

# MART: dimensions and facts (first refresh level) ...
for _f in (mart.dim_patient, mart.dim_doctor, mart.fact_appointment, mart.fact_billing,
           mart.dim_date, mart.dim_service, mart.dim_department):
    BUILDERS[_f.__name__] = _f
# ... visuals and materialised aggregates (second level) ...
for _f in (visuals.dt_dept_appt, visuals.dt_payment_revenue, visuals.dt_monthly_revenue,
           visuals.dt_demographics, visuals.dt_appt_status, visuals.dt_top_doctors,
           matviews.mv_monthly_revenue, matviews.mv_dept_appt_monthly):
    BUILDERS[_f.__name__] = _f
# ... counted groups ...
for _f in (counted.agg_patient_day, counted.agg_day_doctor, counted.agg_doctor_patient, counted.agg_patient_billing,
           counted.agg_service_day):
    BUILDERS[_f.__name__] = _f
# ... and views (always lazy).
for _f in (views.vw_patient_utilization, views.vw_daily_opd_trend, views.vw_doctor_performance,
           views.vw_revenue_by_department, views.vw_no_show_analysis, views.vw_patient_demographics,
           views.vw_top_insurers, views.vw_daily_clinic_roster, views.vw_high_value_patients,
           views.vw_insurance_mix):
    BUILDERS[_f.__name__] = _f

# Materialisation (E2).  The facts and the patient dimension are row-for-row
# projections of CORE: they are always resolved over the stored CORE (a copy
# would double the storage and go stale between refreshes).  Everything that
# needs computation is written as a snapshot; all of it reads CORE only.
MART_PROJECTIONS = ["dim_patient", "fact_appointment", "fact_billing"]
MART_SNAPSHOTS = [
    "dim_doctor", "dim_date", "dim_service", "dim_department",
    "dt_dept_appt", "dt_payment_revenue", "dt_monthly_revenue", "dt_demographics",
    "dt_appt_status", "dt_top_doctors", "mv_monthly_revenue", "mv_dept_appt_monthly",
]

QUERIES = {}
for _f in (landing.csv_scan_nulls, quality.raw_row_counts, quality.layer_pass_rate, quality.rejection_summary,
           quality.dim_duplicate_keys, quality.core_duplicate_keys, quality.null_fk_check, quality.negative_amounts,
           quality.fk_valid_appointments, quality.fk_valid_billing, quality.fk_orphans,
           kpi.exec_kpi, kpi.revenue_totals, kpi.payer_mix, kpi.top_services):
    QUERIES[_f.__name__] = _f
for _n in dir(dashboards):
    _f = getattr(dashboards, _n)
    if callable(_f) and getattr(_f, "__module__", "") == dashboards.__name__:
        QUERIES[_n] = _f
