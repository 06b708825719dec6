"""Loads in any order, kept aggregates, orphan ledgers, landing ledger and retention of a root."""

import os
import time

import pytest
from pyspark.sql import functions as F

from carelake import pipeline
from carelake.constants import DOMAINS, ENGINEER_ROLE
from carelake.pipeline import apply_load, ingest
from carelake.plans.catalog import MERGE_SPLITS, catalog
from carelake.plans.registry import BUILDERS
from carelake.retention import retain
from carelake.schemas import RAW_COLUMNS
from carelake.sources import batches, versioned
from carelake.sources.sinks import list_names
from carelake.sources.tables import core_table
from carelake.streaming import incremental, run_available
from carelake.warehouse import Warehouse

KEPT = [*incremental.SPECS, "dim_doctor", "dim_service", "dim_date", "dim_department", "vw_patient_utilization",
        "vw_daily_opd_trend", "vw_doctor_performance", "vw_high_value_patients"]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def assert_kept_equals_rebuild(spark, root, names=KEPT, domains=DOMAINS):
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    core = Warehouse.from_storage(spark, root, [f"core_{d}" for d in domains], role=ENGINEER_ROLE)
    assert not any(core.holds(n) for n in incremental.SPECS)
    for name in names:
        assert rows(stored.table(name)) == rows(BUILDERS[name](core)), name
    assert rows(catalog()["fk_orphans"](stored)) == rows(catalog()["fk_orphans"](core))
    return stored


def small(wh_small, domain, n=60):
    return wh_small.resolve(f"raw_{domain}").limit(n)


def test_failed_load_replayed_after_a_later_one(spark, wh_small, tmp_path, monkeypatch):
    """A's MERGE fails, B (the same ids) is loaded, A is replayed: B's values stay, and every kept result is a rebuild's."""
    root = str(tmp_path / "wh")
    for d in DOMAINS:
        ingest(spark, root, d, wh_small.resolve(f"raw_{d}"), incremental=True)
    raw = wh_small.resolve("raw_billing")
    load_a = raw.withColumn("department", F.lit("DeptA"))
    load_b = raw.withColumn("department", F.lit("DeptB"))
    token_a, token_b = batches.claim(spark, root, "A"), batches.claim(spark, root, "B")
    real = versioned.merge
    monkeypatch.setattr(pipeline.versioned, "merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        apply_load(spark, root, "billing", load_a, token_a, incremental=True)
    monkeypatch.setattr(pipeline.versioned, "merge", real)
    apply_load(spark, root, "billing", load_b, token_b, incremental=True)
    apply_load(spark, root, "billing", load_a, token_a, incremental=True)
    stored = assert_kept_equals_rebuild(spark, root)
    assert {r[0] for r in stored.table("core_billing").select("department").distinct().collect()} == {"DeptB"}
    assert stored.table("mv_monthly_revenue").filter("bill_count <= 0").count() == 0


def test_load_that_failed_after_its_merge(spark, wh_small, tmp_path, monkeypatch):
    """CORE is ahead of the aggregates until the replay: readers then resolve over CORE, and the replay catches up."""
    root = str(tmp_path / "wh")
    first, second = small(wh_small, "billing", 100), wh_small.resolve("raw_billing")
    ingest(spark, root, "billing", first, incremental=True)
    n = batches.claim(spark, root, "late")
    monkeypatch.setattr(incremental, "advance", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        apply_load(spark, root, "billing", second, n, incremental=True)
    monkeypatch.undo()
    torn = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert not torn.holds("mv_monthly_revenue")
    assert torn.table("mv_monthly_revenue").agg(F.sum("bill_count")).first()[0] == torn.table("core_billing").count()
    apply_load(spark, root, "billing", second, n, incremental=True)
    level = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert level.holds("mv_monthly_revenue")
    assert rows(level.table("mv_monthly_revenue")) == rows(torn.table("mv_monthly_revenue"))


def test_group_below_zero_is_an_error(spark):
    spec = incremental.SPECS["dt_appt_status"]
    bad = spark.createDataFrame([("X", 1, 1), ("X", -2, -2)], "status string, count long, _rows long")
    with pytest.raises(Exception, match="more rows taken"):
        incremental.fold(spec, bad).collect()


def test_results_that_are_no_sums_follow_inserts_moves_and_overwrites(spark, wh_small, tmp_path):
    """Last visits, distinct doctors and patients, the latest doctor row, spans and departments go forth and back."""
    root = str(tmp_path / "wh")
    for d in DOMAINS:
        ingest(spark, root, d, wh_small.resolve(f"raw_{d}"), incremental=True)
    a = wh_small.resolve("raw_appointments")
    last_day = a.filter(F.col("appt_date").rlike(r"^\d{4}-\d\d-\d\d$")).agg(F.max("appt_date")).first()[0]
    steps = [
        # a later day with a new name for a doctor; then those rows move back to an early day
        ("appointments", a.limit(40).withColumn("appt_date", F.lit("2031-05-05")).withColumn("doctor_name", F.lit("New Name"))),
        ("appointments", a.limit(40).withColumn("appt_date", F.lit("2001-02-03")).withColumn("department", F.lit("Attic"))),
        # all rows of the last day go to another doctor and patient
        ("appointments", a.filter(F.col("appt_date") == last_day).withColumn("doctor_id", F.lit("77")).withColumn("patient_id", F.lit("3"))),
        ("billing", small(wh_small, "billing").withColumn("bill_date", F.lit("2032-01-01")).withColumn("service_desc", F.lit("Renamed"))),
        ("billing", small(wh_small, "billing").withColumn("department", F.lit("Cellar"))),
        ("patients", wh_small.resolve("raw_patients").limit(30).withColumn("gender", F.lit("X"))),
    ]
    for i, (d, part) in enumerate(steps):
        ingest(spark, root, d, part, incremental=True)
        if i in (1, 5):
            assert_kept_equals_rebuild(spark, root)
    stored = assert_kept_equals_rebuild(spark, root)
    assert all(stored.holds(n) for n in (*incremental.SPECS, "latest_doctor", "orphans_billing", "orphans_appointments"))


def test_doctor_upkeep_opens_few_files(spark, wh_small, tmp_path):
    """A load that touches one day looks its doctors' last day up, not all of CORE."""
    root = str(tmp_path / "wh")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ingest(spark, root, "appointments", wh_small.resolve("raw_appointments"), incremental=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = core_table(root, "appointments")
    state = versioned.entry(spark, table.path)
    doctor = spark.read.parquet(incremental.latest_state(spark, root, "latest_doctor")[1]).limit(1).select("doctor_id")
    looked = incremental.touched_doctor_rows(spark, root, table, state["version"], doctor)
    whole = versioned.read(spark, table)
    opened = [f for f in looked.inputFiles() if "/core/" in f]
    assert 0 < len(opened) <= 2 < len(whole.inputFiles())
    assert 0 < looked.count() < whole.count() / 4


def test_orphans_are_drained_by_a_later_patients_load(spark, wh_small, tmp_path):
    root = str(tmp_path / "wh")
    p = wh_small.resolve("raw_patients")
    ingest(spark, root, "billing", wh_small.resolve("raw_billing"), incremental=True)
    counts = []
    for part in (p.filter("cast(patient_id as int) % 2 = 0"), p):
        ingest(spark, root, "patients", part, incremental=True)
        stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
        core = Warehouse.from_storage(spark, root, ["core_patients", "core_billing"], role=ENGINEER_ROLE)
        assert stored.holds("orphans_billing")
        got = rows(stored.table("orphans_billing"))
        want = core.table("fact_billing").join(core.table("dim_patient"), "patient_key", "left_anti")
        assert got == rows(want.select(F.col("bill_id").alias("record_id"), "patient_key"))
        counts.append(len(got))
    assert counts[0] > counts[1] > 0
    # bills that move to a known patient leave, others that move to an unknown one enter
    some = wh_small.resolve("raw_billing").limit(50)
    known = p.filter("cast(patient_id as int) is not null and dob is not null").first().patient_id
    ingest(spark, root, "billing", some.withColumn("patient_id", F.lit("987654")), incremental=True)
    up = len(rows(Warehouse.from_storage(spark, root).table("orphans_billing")))
    ingest(spark, root, "billing", some.withColumn("patient_id", F.lit(known)), incremental=True)
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    core = Warehouse.from_storage(spark, root, ["core_patients", "core_billing"], role=ENGINEER_ROLE)
    want = core.table("fact_billing").join(core.table("dim_patient"), "patient_key", "left_anti")
    got = rows(stored.table("orphans_billing"))
    assert got == rows(want.select(F.col("bill_id").alias("record_id"), "patient_key")) and len(got) < up


def land(landing, domain, df, name):
    pdf = df.select(*RAW_COLUMNS[domain]).toPandas()
    pdf.columns = [c.upper() for c in pdf.columns]
    pdf.to_csv(os.path.join(landing, f"{domain}_{name}.csv"), index=False)


def test_corrected_file_of_the_same_name_is_landed(spark, wh_small, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    os.makedirs(landing)

    def load():
        return ingest(spark, root, "billing", Warehouse.from_landing(spark, landing).resolve("raw_billing"), load_once=True)

    raw = small(wh_small, "billing").cache()
    land(landing, "billing", raw, "day 1")
    load()
    load()
    stored = lambda: Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    n = raw.count()
    assert stored().table("raw_billing").count() == n
    time.sleep(1.1)
    land(landing, "billing", raw.withColumn("department", F.lit("Corrected")), "day 1")
    load()
    assert stored().table("raw_billing").count() == 2 * n
    assert {r[0] for r in stored().table("core_billing").select("department").distinct().collect()} == {"Corrected"}
    batches.compact_files(spark, root, "billing")
    assert list_names(spark, f"{root}/_batches/files/billing") == [f"batch_id={batches.COMPACTED}"]
    load()
    assert stored().table("raw_billing").count() == 2 * n


def test_feed_reset_can_redeliver(spark, wh_small, tmp_path):
    """T5: a new checkpoint with redelivery lands every file again as a load of its own; CORE and aggregates stay."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    os.makedirs(landing)
    raw = small(wh_small, "billing").cache()
    land(landing, "billing", raw, "one")
    run_available(spark, landing, root, refresh="incremental")
    before = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    core, n = rows(before.table("core_billing").drop("_load_seq")), before.table("raw_billing").count()
    seen = run_available(spark, landing, root, checkpoint=str(tmp_path / "reset"), refresh="incremental", redeliver=True)
    after = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    assert seen["billing"] == n and after.table("raw_billing").count() == 2 * n
    assert rows(after.table("core_billing").drop("_load_seq")) == core
    assert after.table("core_billing").agg(F.min("_load_seq")).first()[0] > before.table("core_billing").agg(F.max("_load_seq")).first()[0]
    for name in ("mv_monthly_revenue", "agg_patient_billing"):
        assert rows(after.table(name)) == rows(before.table(name))


def test_retention_of_a_root(spark, wh_small, tmp_path):
    root = str(tmp_path / "wh")
    parts = small(wh_small, "billing", 200).cache()
    for i in range(12):
        ingest(spark, root, "billing", parts.filter(F.col("bill_id").cast("long") % 12 >= i % 3), i, incremental=True)
    gone = retain(spark, root, keep_versions=1, keep_loads=3, grace=0)
    assert gone["segments"] > 0 and gone["loads"] == 9
    assert len(list_names(spark, f"{root}/_batches/done")) == 3 and list_names(spark, f"{root}/_staging/billing") == []
    assert all(len(incremental.states(spark, root, n)) <= incremental.KEEP_STATES for n in incremental.specs_for("billing"))
    ingest(spark, root, "billing", small(wh_small, "billing", 250), 99, incremental=True)
    stored = Warehouse.from_storage(spark, root, role=ENGINEER_ROLE)
    core = Warehouse.from_storage(spark, root, ["core_billing"], role=ENGINEER_ROLE)
    for name in incremental.specs_for("billing"):
        assert stored.holds(name) and rows(stored.table(name)) == rows(BUILDERS[name](core)), name


def test_one_token_has_one_id_for_two_drivers(spark, tmp_path, monkeypatch):
    """Both see no token; the one that comes second takes the first one's id."""
    root = str(tmp_path)
    real, calls = batches.publish_text, []

    def slow(spark_, path, text):
        if not calls:
            calls.append(path)
            assert real(spark_, path, "41")  # the other driver is faster
        return real(spark_, path, text)

    monkeypatch.setattr(batches, "publish_text", slow)
    assert batches.claim(spark, root, "t") == 41 == batches.claim(spark, root, "t")


def test_splits_cover_every_domain():
    assert set(MERGE_SPLITS) == set(DOMAINS)
