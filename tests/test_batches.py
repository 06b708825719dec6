"""Loads by any route keep their own batch; stored queries equal a rebuild from CORE."""

import os

from pyspark.sql import functions as F

from carelake.constants import DOMAINS, ENGINEER_ROLE
from carelake.jobs import run_concurrently
from carelake.pipeline import ingest, run_batch
from carelake.plans.catalog import MERGE_SPLITS, catalog
from carelake.schemas import RAW_COLUMNS
from carelake.sources.batches import claim
from carelake.streaming import run_available
from carelake.warehouse import Warehouse


def _parts(wh, domain):
    """Two disjoint loads of a domain: before the split date (or without a date), and after."""
    col, hi, _ = MERGE_SPLITS[domain]
    early = F.coalesce(F.col(col) < hi, F.lit(True))
    raw = wh.resolve(f"raw_{domain}")
    return raw.filter(early), raw.filter(~early)


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _assert_equals_rebuild(spark, root):
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    names = [f"{layer}_{d}" for layer in ("raw", "core") for d in DOMAINS] + ["exceptions"]
    rebuilt = Warehouse.from_storage(spark, root, names, role=ENGINEER_ROLE)
    pairs = {n: (q(stored), q(rebuilt)) for n, q in catalog().items()
             if not n.startswith(("raw_", "core_", "merge_", "clean_", "rejects_", "mask_"))}
    equal = run_concurrently({n: (lambda a=a, b=b: _rows(a) == _rows(b)) for n, (a, b) in pairs.items()}, 8)
    assert [n for n, ok in equal.items() if not ok] == []


def test_claims_are_unique_and_repeatable(spark, tmp_path):
    root = str(tmp_path)
    ids = [claim(spark, root, t) for t in ("a", "b", "a", "c")]
    assert ids == [0, 1, 0, 2]


def test_two_loads_under_one_key_keep_both(spark, wh_small, tmp_path):
    root = str(tmp_path / "wh")
    first, second = _parts(wh_small, "billing")
    a = ingest(spark, root, "billing", first, 0, n_buckets=4, incremental=True)
    b = ingest(spark, root, "billing", second, 0, n_buckets=4, incremental=True)
    again = ingest(spark, root, "billing", first, 0, n_buckets=4, incremental=True)
    assert a == again != b
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert stored.table("raw_billing").count() == first.count() + second.count()
    want = Warehouse.from_storage(spark, root, ["core_billing"], role=ENGINEER_ROLE)
    for name in ("dt_payment_revenue", "mv_monthly_revenue"):
        assert _rows(stored.table(name)) == _rows(want.table(name)), name


def test_stored_queries_equal_a_rebuild_after_later_loads(spark, wh_small, tmp_path):
    """Later loads bring new days, doctors and services; one of them comes without the incremental flag."""
    root = str(tmp_path / "wh")
    parts = {d: _parts(wh_small, d) for d in DOMAINS}
    few = {"patients": parts["patients"][0],
           "appointments": parts["appointments"][0].filter("doctor_id IS NULL OR doctor_id <> 'D1'"),
           "billing": parts["billing"][0]}
    run_batch(spark, root, few, n_buckets=4, incremental=True)
    ingest(spark, root, "appointments", parts["appointments"][1], n_buckets=4, incremental=True)
    ingest(spark, root, "billing", parts["billing"][1], n_buckets=4)
    ingest(spark, root, "patients", parts["patients"][1], n_buckets=4, incremental=True)
    _assert_equals_rebuild(spark, root)


def test_bulk_load_then_stream_lands_each_file_once(spark, wh_small, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    os.makedirs(landing)

    def land(domain, df, name):
        pdf = df.select(*RAW_COLUMNS[domain]).toPandas()
        pdf.columns = [c.upper() for c in pdf.columns]
        pdf.to_csv(os.path.join(landing, f"{domain}_{name}.csv"), index=False)

    first, second = _parts(wh_small, "billing")
    land("billing", first, "one")
    wh = Warehouse.from_landing(spark, landing)
    ingest(spark, root, "billing", wh.resolve("raw_billing"), n_buckets=4, incremental=True, load_once=True)
    land("billing", second, "two")
    run_available(spark, landing, root, refresh="incremental", n_buckets=4)
    run_available(spark, landing, root, checkpoint=str(tmp_path / "reset"), refresh="incremental", n_buckets=4)
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert stored.table("raw_billing").count() == first.count() + second.count()
    want = Warehouse.from_storage(spark, root, ["core_billing"], role=ENGINEER_ROLE)
    for name in ("dt_payment_revenue", "mv_monthly_revenue", "dt_monthly_revenue"):
        assert _rows(stored.table(name)) == _rows(want.table(name)), name


def test_date_filter_prunes_core_files(spark, wh_small, tmp_path):
    """Inside a bucket, files hold spans of dates, so a date filter opens some of them only."""
    root = str(tmp_path / "wh")
    ingest(spark, root, "billing", wh_small.resolve("raw_billing"), n_buckets=1)
    core = spark.read.parquet(f"{root}/core/billing")
    spans = core.groupBy(F.input_file_name().alias("f")).agg(F.min("bill_date").alias("lo"), F.max("bill_date").alias("hi"))
    rows = sorted((r.lo, r.hi) for r in spans.collect())
    assert all(a[1] <= b[0] for a, b in zip(rows, rows[1:]))
