"""Benchmark: one JSON line with per-step seconds at $BENCH_SF_DIR.

Steps (each timed with a full execution into Spark's ``noop`` sink, best of
two runs for queries):
  load_full        RAW (from driver tables) -> rules -> dedup -> CORE MERGE ->
                   kept aggregates and MART refresh, into a fresh scratch dir
  merge_increment  a second billing load (overlapping window, most of the table)
                   committed to CORE as a delta, with the kept aggregates and the
                   orphan ledger advanced from its change set
  q:<name>         dashboard / KPI queries over the stored MART snapshots
  e2e:<name>       registered queries computed lazily from the driver tables
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from carelake import Warehouse  # noqa: E402
from carelake.constants import ENGINEER_ROLE  # noqa: E402
from carelake.pipeline import ingest, run_batch  # noqa: E402
from carelake.plans.catalog import MERGE_SPLITS, catalog  # noqa: E402
from carelake.session import checkpoint_dir, get_spark  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

STORED_QUERIES = [
    "exec_kpi", "revenue_totals", "payer_mix", "top_services", "vw_patient_utilization",
    "vw_daily_opd_trend", "vw_doctor_performance", "vw_revenue_by_department", "vw_no_show_analysis",
    "vw_high_value_patients", "vw_daily_clinic_roster", "vip_patients", "page_high_value", "page_top_services",
    "monthly_revenue", "no_show_rate_by_dept", "top_cities", "fk_orphans", "layer_pass_rate",
    "rejection_summary", "mv_monthly_revenue",
]
E2E_QUERIES = ["core_billing", "vw_patient_utilization", "mv_monthly_revenue", "rejection_summary"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat=1) -> float:
    best = None
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        dt = time.perf_counter() - t
        best = dt if best is None else min(best, dt)
    return round(best, 3)


def sf_of(path: str) -> str:
    base = os.path.basename(os.path.normpath(path))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    spark = get_spark(f"local[{CPUS}]", max(8, 2 * CPUS), app="carelake-bench",
                      **{"spark.driver.memory": "16g"})
    checkpoint_dir(spark)
    root = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    out: dict[str, float] = {}
    cat = catalog()

    lazy = Warehouse.from_testdata(spark, SF_DIR, role=ENGINEER_ROLE)
    raws = {d: lazy.resolve(f"raw_{d}") for d in ("patients", "appointments", "billing")}
    out["load_full"] = timed(lambda: run_batch(spark, root, raws, load_key=0, incremental=True))

    col, _, lo = MERGE_SPLITS["billing"]
    second = raws["billing"].filter(F.col(col) >= lo)
    out["merge_increment"] = timed(lambda: ingest(spark, root, "billing", second, load_key=1, incremental=True))

    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    for name in STORED_QUERIES:
        out[f"q:{name}"] = timed(lambda n=name: run(cat[n](stored)), repeat=2)
    for name in E2E_QUERIES:
        out[f"e2e:{name}"] = timed(lambda n=name: run(cat[n](Warehouse.from_testdata(spark, SF_DIR, role=ENGINEER_ROLE))), repeat=2)

    total = round(sum(out.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": out,
                      "sf": sf_of(SF_DIR), "cpus": CPUS, "scratch": root}))


if __name__ == "__main__":
    main()
