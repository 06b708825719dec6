"""Aggregates kept current per load from the change sets of CORE.

A full MART rebuild reads all of CORE; with a 5-minute refresh lag on a large
warehouse that is the bottleneck.  Every aggregate here is a sum by group, so
it follows CORE from one version to a later one:

    state' = state  (+)  agg(rows the commits wrote)  (-)  agg(rows they replaced)

A state is named after the CORE version it reflects, and the change sets come
from CORE's own log (:mod:`carelake.sources.versioned`), so it does not matter
which load is absorbed, replayed or finished when: a state that is behind takes
all commits since, one that is level does nothing, and one whose commits
retention has taken is built again.  Every state row carries ``_rows`` (how
many rows it sums): a group that holds none drops out, and a count below zero
is an error, not a result.

Results that are no sums are read off *counted* states with finer groups:
distinct doctors of a day from (day, doctor), distinct patients of a doctor
from (doctor, patient), the last visit from (patient, day), spans and latest
descriptions from their days.  Taking the last row of a group back drops it, so
maxima and distinct counts go back too.  The latest row per doctor needs the
row itself: ``latest_doctor`` finds, for the doctors that a load touched, their
last day in a counted state and looks that day up in CORE.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.dedup import desc, first_per_key
from carelake.sources import versioned
from carelake.sources.sinks import committed, delete, list_names
from carelake.sources.tables import core_table

_ORPHANS = threading.Lock()
#: States that are kept of each aggregate, for readers that opened an older one.
KEEP_STATES = 5


@dataclass(frozen=True)
class Additive:
    domain: str
    source: str                                   # fact / dimension the rows are projected to
    keys: list[tuple[str, Callable[[], Column]]]  # group keys (alias, expression)
    measures: list[tuple[str, Callable[[], Column], str]]  # (alias, per-row value, result type)
    where: Callable[[], Column] | None = None
    derived: list[tuple[str, Callable[[], Column]]] = field(default_factory=list)


def _c(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _month(col: str) -> Callable[[], Column]:
    return lambda: F.trunc(col, "MM")


SPECS: dict[str, Additive] = {
    "dt_dept_appt": Additive(
        "appointments", "fact_appointment", [("department", _c("department"))],
        [("appointments", _one, "bigint")]),
    "dt_appt_status": Additive(
        "appointments", "fact_appointment", [("status", _c("status"))], [("count", _one, "bigint")]),
    "dt_top_doctors": Additive(
        "appointments", "fact_appointment", [("doctor_name", _c("doctor_name"))],
        [("appointments", _one, "bigint")]),
    "mv_dept_appt_monthly": Additive(
        "appointments", "fact_appointment", [("appt_month", _month("appt_date")), ("department", _c("department"))],
        [("total_appts", _one, "bigint"), ("completed", _c("is_completed"), "bigint"),
         ("no_shows", _c("is_no_show"), "bigint"), ("cancelled", _c("is_cancelled"), "bigint")]),
    "dt_payment_revenue": Additive(
        "billing", "fact_billing", [("payment_mode", _c("payment_mode"))],
        [("revenue", _c("net_amount"), "decimal(28,2)")]),
    "dt_monthly_revenue": Additive(
        "billing", "fact_billing", [("month", _month("bill_date"))],
        [("revenue", _c("net_amount"), "decimal(28,2)")]),
    "mv_monthly_revenue": Additive(
        "billing", "fact_billing",
        [("bill_month", _month("bill_date")), ("department", _c("department")), ("payment_mode", _c("payment_mode"))],
        [("bill_count", _one, "bigint"), ("total_gross", _c("gross_amount"), "decimal(28,2)"),
         ("total_discount", _c("discount_amount"), "decimal(28,2)"),
         ("total_tax", _c("tax_amount"), "decimal(28,2)"), ("total_net", _c("net_amount"), "decimal(28,2)")],
        derived=[("avg_net", lambda: (F.col("total_net") / F.col("bill_count")).cast("decimal(16,6)"))]),
    "dt_demographics": Additive(
        "patients", "dim_patient", [("gender", _c("gender"))], [("count", _one, "bigint")],
        where=lambda: F.col("gender").isNotNull()),
    # Counted states: groups fine enough to read distinct counts, spans and latest values off.
    "agg_patient_day": Additive(
        "appointments", "fact_appointment", [("patient_key", _c("patient_key")), ("appt_date", _c("appt_date"))],
        [("appointments", _one, "bigint"), ("completed", _c("is_completed"), "bigint")]),
    "agg_day_doctor": Additive(
        "appointments", "fact_appointment",
        [("date_key", _c("date_key")), ("appt_date", _c("appt_date")), ("doctor_key", _c("doctor_key"))],
        [("appointments", _one, "bigint"), ("completed", _c("is_completed"), "bigint"),
         ("no_shows", _c("is_no_show"), "bigint"),
         ("named", lambda: F.col("doctor_name").isNotNull().cast("bigint"), "bigint")]),
    "agg_doctor_patient": Additive(
        "appointments", "fact_appointment", [("doctor_key", _c("doctor_key")), ("patient_key", _c("patient_key"))],
        [("appointments", _one, "bigint"), ("completed", _c("is_completed"), "bigint"),
         ("no_shows", _c("is_no_show"), "bigint")]),
    "agg_patient_billing": Additive(
        "billing", "fact_billing", [("patient_key", _c("patient_key"))],
        [("bills", _one, "bigint"), ("net", _c("net_amount"), "decimal(28,2)")]),
    "agg_service_day": Additive(
        "billing", "fact_billing",
        [("service_code", _c("service_code")), ("bill_date", _c("bill_date")), ("service_desc", _c("service_desc"))],
        [("bills", _one, "bigint")]),
}


def specs_for(domain: str) -> dict[str, Additive]:
    return {n: s for n, s in SPECS.items() if s.domain == domain}


def _project(spark: SparkSession, spec: Additive, core_rows: DataFrame) -> DataFrame:
    from carelake.warehouse import Warehouse

    return Warehouse(spark, {f"core_{spec.domain}": core_rows}, masked=False).resolve(spec.source)


def contributions(spark: SparkSession, spec: Additive, core_rows: DataFrame, sign: int) -> DataFrame:
    rows = _project(spark, spec, core_rows)
    if spec.where is not None:
        rows = rows.filter(spec.where())
    return rows.select(
        *[e().alias(a) for a, e in spec.keys],
        *[(e() * F.lit(sign)).cast(t).alias(a) for a, e, t in spec.measures],
        F.lit(sign).cast("bigint").alias("_rows"),
    )


def fold(spec: Additive, rows: DataFrame) -> DataFrame:
    """Sum contributions per group; drop groups that no longer hold a row."""
    g = rows.groupBy(*[a for a, _ in spec.keys]).agg(
        *[F.sum(a).cast(t).alias(a) for a, _, t in spec.measures], F.sum("_rows").cast("bigint").alias("_rows")
    )
    n = F.col("_rows")
    message = F.concat(F.lit("more rows taken from a group than it held: "), n.cast("string"))
    return g.withColumn("_rows", F.when(n < 0, F.raise_error(message).cast("bigint")).otherwise(n)).filter("_rows != 0")


def publish_view(spec: Additive, state: DataFrame) -> DataFrame:
    cols = [F.col(a) for a, _ in spec.keys] + [F.col(a) for a, _, _ in spec.measures]
    cols += [e().alias(a) for a, e in spec.derived]
    return state.select(*cols)


# ------------------------------------------------------------------ state
#: Tables kept by domain that are no sums: the latest named appointment of each doctor.
LATEST = {"latest_doctor": "appointments"}


def _state_root(root: str, name: str) -> str:
    return f"{root}/_state/{name}"


def states(spark: SparkSession, root: str, name: str) -> list[tuple[int, str]]:
    """Committed states as (CORE version, path), oldest first."""
    folder = _state_root(root, name)
    found = [(int(n[2:]), f"{folder}/{n}") for n in list_names(spark, folder) if n.startswith("v=")]
    return [x for x in sorted(found) if committed(spark, x[1])]


def latest_state(spark: SparkSession, root: str, name: str) -> tuple[int, str] | None:
    found = states(spark, root, name)
    return found[-1] if found else None


def stored_states(spark: SparkSession, root: str, at: dict[str, int]) -> dict[str, DataFrame]:
    """The kept aggregates that reflect the CORE versions ``at`` (by domain): all of a domain's, or none."""
    out: dict[str, DataFrame] = {}
    domains = {n: s.domain for n, s in SPECS.items()} | LATEST
    for domain, version in at.items():
        places = {n: f"{_state_root(root, n)}/v={version}" for n, d in domains.items() if d == domain}
        if all(committed(spark, place) for place in places.values()):
            for name, place in places.items():
                rows = spark.read.parquet(place)
                out[name] = publish_view(SPECS[name], rows) if name in SPECS else rows
    return out | stored_orphans(spark, root, at)


def advance(spark: SparkSession, root: str, domain: str) -> int | None:
    """Bring every kept aggregate of ``domain`` to CORE's newest version; returns that version.

    The aggregates are independent; their jobs are submitted side by side.  Work is by the commits since each state, not
    by CORE, except where there is no state yet or its commits are gone.
    """
    from carelake.jobs import run_concurrently

    table = core_table(root, domain)
    now = versioned.entry(spark, table.path)
    if now is None:
        return None
    target = now["version"]

    def absorb(name: str, spec: Additive) -> None:
        last = latest_state(spark, root, name)
        if last and last[0] >= target:
            return
        moved = versioned.changes(spark, table, last[0], target) if last else None
        if moved is None:
            rows = contributions(spark, spec, versioned.read(spark, table, target), 1)
        else:
            rows = spark.read.parquet(last[1]).unionByName(contributions(spark, spec, moved[0], 1))
            rows = rows.unionByName(contributions(spark, spec, moved[1], -1))
        _write_state(spark, root, name, target, fold(spec, rows))

    tasks = {n: (lambda n=n, s=s: absorb(n, s)) for n, s in specs_for(domain).items()}
    run_concurrently({"orphans": lambda: advance_orphans(spark, root)} | tasks, 4)
    if domain == LATEST["latest_doctor"]:
        _advance_doctors(spark, root, table, target)
    return target


def _write_state(spark: SparkSession, root: str, name: str, version: int, rows: DataFrame) -> None:
    rows.write.mode("overwrite").parquet(f"{_state_root(root, name)}/v={version}")
    for _, path in states(spark, root, name)[:-KEEP_STATES]:
        delete(spark, path)


# ---------------------------------------------------------------- orphans
#: Fact rows without a patient, by domain: (ledger, id column).
ORPHANS = {"appointments": ("orphans_appointments", "appt_id"), "billing": ("orphans_billing", "bill_id")}


def _orphan_states(spark: SparkSession, root: str, name: str) -> list[tuple[int, int, str]]:
    """Committed ledgers as (fact version, patients version, path); -1 stands for no patients yet."""
    folder = _state_root(root, name)
    found = [(*map(int, n[2:].split("_")), f"{folder}/{n}") for n in list_names(spark, folder) if n.startswith("v=")]
    return [x for x in sorted(found) if committed(spark, x[2])]


def advance_orphans(spark: SparkSession, root: str) -> None:
    """J6 kept current: rows that a load wrote leave the ledger, those without a patient enter it, and new patients drain
    it.  Patients are never deleted, so nothing else can become an orphan; work is by what the loads moved."""
    patients = core_table(root, "patients")
    with _ORPHANS:  # domains load side by side; a ledger has one writer at a time
        known = versioned.entry(spark, patients.path)
        p_now = known["version"] if known else -1
        for domain, (name, key) in ORPHANS.items():
            table = core_table(root, domain)
            now = versioned.entry(spark, table.path)
            found = _orphan_states(spark, root, name)
            if now is None or found and found[-1][0] >= now["version"] and found[-1][1] >= p_now:
                continue
            rows = _orphans_of(spark, table, key, now["version"], patients, p_now, found[-1] if found else None)
            rows.write.mode("overwrite").parquet(f"{_state_root(root, name)}/v={now['version']}_{p_now}")
            for _, _, path in _orphan_states(spark, root, name)[:-KEEP_STATES]:
                delete(spark, path)


def _orphans_of(spark: SparkSession, table: versioned.Table, key: str, f_now: int, patients: versioned.Table, p_now: int,
                last: tuple[int, int, str] | None) -> DataFrame:
    columns = [F.col(key).alias("record_id"), F.col("patient_id").alias("patient_key")]
    moved = versioned.changes(spark, table, last[0], f_now) if last else None
    if moved is None:
        rows = versioned.read(spark, table, f_now).select(*columns)
        if p_now < 0:
            return rows
        ids = versioned.read(spark, patients, p_now).select(F.col("patient_id").alias("patient_key"))
        return rows.join(ids, "patient_key", "left_anti").select("record_id", "patient_key")
    touched = moved[0].select(F.col(key).alias("record_id")).distinct()
    # of the rows that the commits wrote for a key, the one of the latest load is the current one
    current = moved[0].groupBy(F.col(key).alias("record_id")).agg(
        F.max_by("patient_id", versioned.SEQ).alias("patient_key"))
    before = spark.read.parquet(last[2]).join(touched, "record_id", "left_anti")
    if p_now >= 0:
        wanted = moved[0].select("patient_id").distinct()
        there = versioned.rows_of(spark, patients, p_now, wanted).select(F.col("patient_id").alias("patient_key"))
        current = current.join(there, "patient_key", "left_anti")
        if p_now > last[1]:
            new = versioned.changes(spark, patients, last[1], p_now)
            ids = new[0] if new else versioned.read(spark, patients, p_now)
            before = before.join(ids.select(F.col("patient_id").alias("patient_key")), "patient_key", "left_anti")
    return before.select("record_id", "patient_key").unionByName(current.select("record_id", "patient_key"))


def stored_orphans(spark: SparkSession, root: str, at: dict[str, int]) -> dict[str, DataFrame]:
    """The orphan ledgers that reflect the CORE versions ``at``."""
    out = {}
    for domain, (name, _) in ORPHANS.items():
        place = f"{_state_root(root, name)}/v={at.get(domain)}_{at.get('patients', -1)}"
        if domain in at and committed(spark, place):
            out[name] = spark.read.parquet(place)
    return out


DOCTOR_COLUMNS = ["doctor_id", "appt_date", "appt_id", "doctor_name", "department"]


def _named(core: DataFrame) -> DataFrame:
    return core.filter("doctor_id IS NOT NULL AND doctor_name IS NOT NULL").select(*DOCTOR_COLUMNS)


def latest_per_doctor(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, "doctor_id", [desc("appt_date"), desc("appt_id")])


def touched_doctor_rows(spark: SparkSession, root: str, table: versioned.Table, version: int, touched: DataFrame) -> DataFrame:
    """CORE's rows of the ``touched`` doctors on their last named day, from the files that hold such a day."""
    days = spark.read.parquet(f"{_state_root(root, 'agg_day_doctor')}/v={version}").filter("named > 0")
    last = (days.join(touched, days.doctor_key == touched.doctor_id, "left_semi")
            .groupBy(F.col("doctor_key").alias("_doctor")).agg(F.max("appt_date").alias("_day")))
    wanted = [r[0] for r in last.select("_day").distinct().collect()]  # calendar days: bounded by the calendar
    rows = _named(versioned.read(spark, table, version, days=wanted))
    return rows.join(last, (F.col("doctor_id") == F.col("_doctor")) & (F.col("appt_date") == F.col("_day")), "left_semi")


def _advance_doctors(spark: SparkSession, root: str, table: versioned.Table, target: int) -> None:
    last = latest_state(spark, root, "latest_doctor")
    if last and last[0] >= target:
        return
    moved = versioned.changes(spark, table, last[0], target) if last else None
    if moved is None:
        best = latest_per_doctor(_named(versioned.read(spark, table, target)))
    else:
        touched = moved[0].select("doctor_id").unionByName(moved[1].select("doctor_id")).distinct()
        again = latest_per_doctor(touched_doctor_rows(spark, root, table, target, touched))
        best = spark.read.parquet(last[1]).join(touched, "doctor_id", "left_anti").unionByName(again)
    _write_state(spark, root, "latest_doctor", target, best.select(*DOCTOR_COLUMNS))
