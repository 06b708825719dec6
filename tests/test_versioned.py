"""Versions of a keyed table under replays, readers, writers, compaction and retention."""

import datetime
import threading

import pytest
from pyspark.sql import functions as F

from carelake.sources import versioned as V
from carelake.sources.sinks import list_names

SCHEMA = "id long, d date, dept string, v string"
DAY = datetime.date(2025, 1, 1)


def batch(spark, ids, v, day=None):
    rows = [(i, day or DAY + datetime.timedelta(days=i * 7 % 360), f"dept{i % 3}", v) for i in ids]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def table(tmp_path):
    return V.Table(str(tmp_path / "core"), "id", ("d", "dept"))


def values(spark, table, version=None):
    rows = V.read(spark, table, version).select("id", "v").collect()
    out = {r.id: r.v for r in rows}
    assert len(out) == len(rows)
    return out


def test_latest_load_wins_in_any_order(spark, table):
    assert V.merge(spark, table, batch(spark, [], "x"), 1) is None
    V.merge(spark, table, batch(spark, range(100), "one"), 1)
    V.merge(spark, table, batch(spark, range(10, 20), "three"), 3)
    cleaned = {r.id: r._cleaned_at for r in V.read(spark, table).collect()}
    late = V.merge(spark, table, batch(spark, [*range(15, 25), 500], "two"), 2)
    want = {i: "one" for i in range(100)} | {i: "two" for i in [*range(20, 25), 500]} | {i: "three" for i in range(10, 20)}
    assert values(spark, table) == want
    # first-insert time is kept; a replay changes nothing and makes no version
    assert all(r._cleaned_at == cleaned[r.id] for r in V.read(spark, table).collect() if r.id != 500)
    assert V.merge(spark, table, batch(spark, [*range(15, 25), 500], "two"), 2) == late
    assert V.merge(spark, table, batch(spark, [], "x"), 4) == late and V.versions(spark, table.path)[-1] == late
    named = {n.removeprefix("seg=") for n in list_names(spark, table.path) if n.startswith("seg=")}
    assert named == set(list_names(spark, f"{table.path}/_index")) and len(named) == 3
    new, old = V.changes(spark, table, 0, late)
    assert sorted(r.id for r in new.collect()) == sorted([*range(10, 20), *range(20, 25), 500])
    assert {r.v for r in old.collect()} == {"one"} and old.count() == 15


def test_versions_stay_readable(spark, table):
    V.merge(spark, table, batch(spark, range(30), "a"), 1)
    V.merge(spark, table, batch(spark, range(5), "b"), 2)
    V.compact(spark, table)
    assert set(values(spark, table, 0).values()) == {"a"}
    assert values(spark, table, 1) == values(spark, table, 2) == values(spark, table)


def test_two_writers_lose_nothing(spark, table):
    V.merge(spark, table, batch(spark, range(50), "a"), 1)
    errors = []

    def write(seq, ids):
        try:
            V.merge(spark, table, batch(spark, ids, f"w{seq}"), seq)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    writers = [threading.Thread(target=write, args=(seq, range(seq, seq + 20))) for seq in (2, 3, 4)]
    writers.append(threading.Thread(target=lambda: V.compact(spark, table)))
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert errors == []
    want = {i: "a" for i in range(50)}
    for seq in (2, 3, 4):
        want |= {i: f"w{seq}" for i in range(seq, seq + 20)}
    assert values(spark, table) == want


def test_a_lost_race_starts_again_from_the_newer_version(spark, table, monkeypatch):
    V.merge(spark, table, batch(spark, range(10), "a"), 1)
    real, raced = V._commit, []

    def commit(spark_, path, new):
        if not raced:
            raced.append(1)
            monkeypatch.setattr(V, "_commit", real)
            V.merge(spark, table, batch(spark, [1, 2], "three"), 3)
        return real(spark_, path, new)

    monkeypatch.setattr(V, "_commit", commit)
    V.merge(spark, table, batch(spark, [2, 4], "two"), 2)
    got = values(spark, table)
    assert (got[1], got[2], got[4]) == ("three", "three", "two") and len(got) == 10
    live = {s for s in list_names(spark, table.path) if s.startswith("seg=")}
    assert len(live) == 3  # the delta of the lost race is gone


def test_reader_during_merges_sees_whole_batches(spark, table):
    """Every batch writes one value to all its keys: a reader that saw half a batch would see two."""
    V.merge(spark, table, batch(spark, range(40), "0"), 0)
    seen, errors, stop = [], [], threading.Event()

    def look():
        while not stop.is_set():
            try:
                got = {r.v for r in V.read(spark, table).select("v").collect()}
                assert len(got) == 1, got
                seen.append(got.pop())
            except Exception as e:  # noqa: BLE001
                errors.append(e)
                return

    reader = threading.Thread(target=look)
    reader.start()
    for seq in range(1, 21):
        V.merge(spark, table, batch(spark, range(40), str(seq)), seq)
        if seq % 7 == 0:
            V.compact(spark, table)
            V.vacuum(spark, table.path, keep=12)
    stop.set()
    reader.join()
    assert errors == [] and seen == sorted(seen, key=int) and len(set(seen)) > 2


def test_small_batch_writes_little(spark, table):
    # rows of some width, so that files are more than their footers
    wide = spark.range(40_000).select(
        "id", F.expr("date_add(DATE'2024-01-01', cast(id % 700 as int))").alias("d"), F.lit("x").alias("dept"),
        F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((F.col("id") + 7).cast("string"), 512)).alias("v"))
    V.merge(spark, table, wide, 1)
    whole = V.bytes_of(spark, table.path, [s["name"] for s in V.entry(spark, table.path)["base"]])
    V.merge(spark, table, wide.filter("id % 100 = 3").coalesce(1), 2)
    state = V.entry(spark, table.path)
    assert state["rows"] == 400 and len(state["deltas"]) == 1
    assert V.bytes_of(spark, table.path, state["deltas"]) < 0.05 * whole


def test_month_filter_opens_few_files_after_merges(spark, table):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        V.merge(spark, table, batch(spark, range(3000), "a"), 1)
        for seq in range(2, 12):
            V.merge(spark, table, batch(spark, range(3000 + seq * 10, 3010 + seq * 10), "n"), seq)
        V.compact(spark, table)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = V.live_files(spark, table.path, V.entry(spark, table.path))
    first, last = datetime.date(2025, 3, 1), datetime.date(2025, 3, 20)
    opened = V.read(spark, table, between=(first, last))
    base = [f for f in opened.inputFiles() if "/seg=1-" in f]
    assert 0 < len(base) < 0.1 * len([f for f in files if f["segment"].startswith("1-")])
    want = V.read(spark, table).filter(F.col("d").between(first, last))
    assert sorted(opened.collect()) == sorted(want.collect()) and opened.count() > 0
    assert V.read(spark, table, days=[first]).count() == V.read(spark, table).filter(F.col("d") == first).count()


def test_merge_opens_only_files_that_may_hold_its_keys(spark, tmp_path):
    by_key = V.Table(str(tmp_path / "t"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        V.merge(spark, by_key, batch(spark, range(0, 8000, 2), "a"), 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    state = V.entry(spark, by_key.path)
    total = len(V.live_files(spark, by_key.path, state))
    few = V.holding(spark, by_key, state, batch(spark, [10, 11, 7990], "x"))
    assert total >= 6 and len(few) == 2
    assert V.holding(spark, by_key, state, batch(spark, [10**12], "x")) == set()
    V.merge(spark, by_key, batch(spark, [10, 11, 7990], "x"), 2)
    after = V.entry(spark, by_key.path)
    assert len(after["touched"]) == 2
    before = {(f["segment"], f["file"]) for f in V.live_files(spark, by_key.path, after)}
    V.compact(spark, by_key)
    kept = {(f["segment"], f["file"]) for f in V.live_files(spark, by_key.path, V.entry(spark, by_key.path))}
    assert len(before & kept) == total - 2  # files without a replaced row stay where they are
    got = values(spark, by_key)
    assert len(got) == 4001 and got[10] == got[11] == got[7990] == "x" and got[12] == "a"


def test_retention_is_bounded_and_spares_readers(spark, table):
    V.merge(spark, table, batch(spark, range(20), "0"), 0)
    reader = V.read(spark, table)
    version = V.entry(spark, table.path)["version"]
    with V.lease(spark, table.path, version):
        for seq in range(1, 51):
            V.merge(spark, table, batch(spark, [seq % 20], str(seq)), seq)
            if seq % 10 == 0:
                V.compact(spark, table)
                V.vacuum(spark, table.path, keep=5, grace=0)
        assert {r.v for r in reader.collect()} == {"0"}  # the long reader finishes
        segments = [n for n in list_names(spark, table.path) if n.startswith("seg=")]
        assert len(segments) <= 1 + 5 + 11 and len(V.versions(spark, table.path)) <= 6
    got = values(spark, table)
    assert len(got) == 20 and got[50 % 20] == "50" and got[1] == "41"
    V.vacuum(spark, table.path, keep=1, grace=0)
    assert len(V.versions(spark, table.path)) == 1 and values(spark, table) == got
    assert V.changes(spark, table, 0, V.entry(spark, table.path)["version"]) is None
    # an expired lease holds nothing
    with V.lease(spark, table.path, 0, seconds=-1):
        V.vacuum(spark, table.path, keep=1, grace=0)
        assert list_names(spark, f"{table.path}/_leases") == []
