"""Stream result = batch result; replay and no-data runs are no-ops."""

import os

import pytest

from pyspark.sql import functions as F

from carelake.constants import ENGINEER_ROLE
from carelake.plans.catalog import MERGE_SPLITS, catalog
from carelake.schemas import RAW_COLUMNS
from carelake.streaming import run_available
from carelake.warehouse import Warehouse

DOMAINS = ("patients", "appointments", "billing")


def _land(wh, landing, domain, df, name):
    """Write one landing file (header + rows) the way an upstream system would."""
    pdf = df.select(*RAW_COLUMNS[domain]).toPandas()
    pdf.columns = [c.upper() for c in pdf.columns]
    pdf.to_csv(os.path.join(landing, f"{domain}_{name}.csv"), index=False)


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_two_loads_equals_batch_merge(spark, wh_small, tmp_path):
    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "wh"), str(tmp_path / "ckpt")
    os.makedirs(landing)
    for d in DOMAINS:
        col, hi, _ = MERGE_SPLITS[d]
        raw = wh_small.resolve(f"raw_{d}")
        _land(wh_small, landing, d, raw.filter(F.coalesce(F.col(col) < hi, F.lit(True))), "load1")
    first = run_available(spark, landing, root, checkpoint=ckpt)
    assert first["billing"] > 0
    for d in DOMAINS:
        col, _, lo = MERGE_SPLITS[d]
        _land(wh_small, landing, d, wh_small.resolve(f"raw_{d}").filter(F.col(col) >= lo), "load2")
    second = run_available(spark, landing, root, checkpoint=ckpt)
    assert all(v > 0 for v in second.values())

    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    q = catalog()
    for d in DOMAINS:
        want = q[f"merge_{d}"](wh_small)
        got = stored.table(f"core_{d}")
        assert _rows(got, want.columns) == _rows(want, want.columns), d
    # MART was refreshed from the merged CORE.
    assert stored.table("fact_billing").count() == stored.table("core_billing").count()
    assert stored.table("dt_payment_revenue").count() == 4

    # No new file: nothing consumed, nothing changes (has-data gate, load-once).
    again = run_available(spark, landing, root, checkpoint=ckpt)
    assert again == {d: 0 for d in DOMAINS}
    again_wh = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert again_wh.table("core_billing").count() == stored.table("core_billing").count()
    # Exceptions were recorded once per batch, one row per failed rule.
    ex = again_wh.table("exceptions")
    per_table = ex.groupBy("source_table").agg(F.count_distinct("batch_id").alias("n")).collect()
    assert per_table and all(r.n <= 2 for r in per_table) and max(r.n for r in per_table) == 2
    assert ex.filter(F.col("reviewed")).count() == 0

    # Feed reset (T5): a new checkpoint delivers every file again; each is
    # already landed, so RAW, exceptions and CORE are unchanged.
    landed, rejected = {d: stored.table(f"raw_{d}").count() for d in DOMAINS}, ex.count()
    replay = run_available(spark, landing, root, checkpoint=ckpt + "_reset", refresh=False)
    assert replay["billing"] == first["billing"] + second["billing"]
    after = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert after.table("exceptions").count() == rejected
    for d in DOMAINS:
        assert after.table(f"raw_{d}").count() == landed[d]
        want = q[f"merge_{d}"](wh_small)
        assert _rows(after.table(f"core_{d}"), want.columns) == _rows(want, want.columns), d


def test_rows_are_counted_without_another_scan(spark, wh_small, tmp_path, monkeypatch):
    """The landing files are gone once the load has ended: the count must come from the load's own scan."""
    from carelake.streaming import ingest

    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    os.makedirs(landing)
    whole = ingest.apply_load

    def load_then_lose_files(*args, **kw):
        whole(*args, **kw)
        for name in os.listdir(landing):
            if name.startswith(args[2]):
                os.remove(os.path.join(landing, name))

    for n in (1, 2):  # the second load also asks the ledger of files
        raws = {d: wh_small.resolve(f"raw_{d}") for d in DOMAINS}
        for d in DOMAINS:
            _land(wh_small, landing, d, raws[d], f"load{n}")
        with monkeypatch.context() as m:
            m.setattr(ingest, "apply_load", load_then_lose_files)
            seen = run_available(spark, landing, root, refresh=False)
        assert seen == {d: raws[d].count() for d in DOMAINS}


@pytest.mark.parametrize("incremental", [False, True])
def test_batch_pipeline_matches_lazy_marts(spark, wh_small, tmp_path, incremental):
    from carelake.pipeline import run_batch

    root = str(tmp_path / "wh")
    raws = {d: wh_small.resolve(f"raw_{d}") for d in DOMAINS}
    run_batch(spark, root, raws, load_key=0, n_buckets=4, incremental=incremental)
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    for name in ("fact_billing", "dim_patient", "dim_doctor", "mv_monthly_revenue", "dt_dept_appt",
                 "dt_demographics", "dim_date", "dt_monthly_revenue"):
        cols = [c for c in wh_small.table(name).columns]
        assert _rows(stored.table(name), cols) == _rows(wh_small.table(name), cols), name


def test_failed_batch_is_not_consumed(spark, wh_small, tmp_path, monkeypatch):
    """The offset advances only when the micro-batch commits."""
    import carelake.streaming.ingest as S

    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "wh"), str(tmp_path / "ckpt")
    os.makedirs(landing)
    _land(wh_small, landing, "patients", wh_small.resolve("raw_patients"), "all")
    real = S.apply_load

    def broken(*a, **k):
        raise RuntimeError("simulated failure inside the micro-batch")

    monkeypatch.setattr(S, "apply_load", broken)
    q = S.start_ingest(spark, landing, root, "patients", checkpoint=ckpt + "/patients")
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the query surfaces the batch failure
        pass
    assert q.exception() is not None

    monkeypatch.setattr(S, "apply_load", real)
    seen = []
    q = S.start_ingest(spark, landing, root, "patients", checkpoint=ckpt + "/patients", on_rows=seen.append)
    q.awaitTermination()
    assert sum(seen) == 150
    core = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE).table("core_patients")
    assert core.count() == wh_small.table("core_patients").count()


def test_incremental_aggregates_equal_full_rebuild(spark, wh_small, tmp_path):
    """Additive aggregates maintained per batch (+new - replaced) equal a
    full rebuild from the merged CORE, and a replayed batch is absorbed once."""
    from carelake.pipeline import ingest
    from carelake.plans.registry import BUILDERS
    from carelake.streaming.incremental import SPECS

    root = str(tmp_path / "wh")
    for load_key, (d, part) in enumerate([("patients", 1), ("appointments", 1), ("billing", 1),
                                          ("patients", 2), ("appointments", 2), ("billing", 2)]):
        col, hi, lo = MERGE_SPLITS[d]
        raw = wh_small.resolve(f"raw_{d}")
        rows = raw.filter(F.coalesce(F.col(col) < hi, F.lit(True))) if part == 1 else raw.filter(F.col(col) >= lo)
        ingest(spark, root, d, rows, load_key, n_buckets=4, incremental=True)
    # replay the last billing batch: MERGE is idempotent, the delta is skipped
    col, hi, lo = MERGE_SPLITS["billing"]
    ingest(spark, root, "billing", wh_small.resolve("raw_billing").filter(F.col(col) >= lo), 5,
           n_buckets=4, incremental=True)

    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    core_only = Warehouse.from_storage(spark, root, [f"core_{d}" for d in DOMAINS], role=ENGINEER_ROLE)
    # facts are projections of the merged CORE, never a stale copy
    assert stored.table("fact_billing").count() == stored.table("core_billing").count()
    for name in SPECS:
        want = BUILDERS[name](core_only)
        got = stored.table(name)
        assert got.columns == want.columns, name
        assert _rows(got, want.columns) == _rows(want, want.columns), name
