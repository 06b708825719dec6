"""Batch pipeline (E1 + E2): land -> reject / clean -> MERGE -> refresh MART.

Each load writes RAW first and re-reads it from storage, so the landed rows
are the lineage cut for the rest of the batch (a lost executor recomputes
from parquet, never from the original files).  Patients are merged before
appointments and billing (X14).  The MART refresh writes every computed
table from the stored CORE; facts and the patient dimension are projections
of CORE resolved at read time (CORE files are ordered by date and department,
so their date filters prune).

A load's number orders it among all loads: CORE keeps the row of the highest
number for each key, whichever of them is finished, replayed or repeated last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake.constants import DOMAINS
from carelake.jobs import run_concurrently
from carelake.operators import clean as C
from carelake.plans.registry import MART_SNAPSHOTS
from carelake.schemas import RAW_COLUMNS
from carelake.sources import batches, versioned
from carelake.sources.sinks import delete, exists, mark_core_change, write_exceptions, write_partitioned, write_raw, write_snapshot
from carelake.sources.tables import core_table

#: Kept for callers of the bucketed layout; CORE is no longer divided by key hash.
DEFAULT_BUCKETS = 16
#: Deltas that a CORE table gathers before a load compacts it.
MAX_DELTAS = 16


def _read_batch(spark: SparkSession, path: str, schema: StructType, batch_id: int) -> DataFrame:
    """One batch's partition under ``path``, read by its own folder and with the schema it was written with; no
    rows if the batch wrote none."""
    folder = f"{path}/batch_id={batch_id}"
    columns = StructType([f for f in schema.fields if f.name != "batch_id"])
    if exists(spark, folder):
        df = spark.read.schema(columns).parquet(folder)
    else:
        df = spark.createDataFrame([], columns)
    return df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def ingest(spark: SparkSession, root: str, domain: str, landed: DataFrame, load_key: str | int | None = None,
           n_buckets: int = DEFAULT_BUCKETS, incremental: bool = False, load_once: bool = False) -> int:
    """One bulk load of one domain; returns its batch id.

    ``load_key`` names the load for a replay: the same key with the same rows
    is the same batch, which is finished if it failed and left alone if not.  The same key with other rows, or no key, is a new
    batch, so no load overwrites another.
    """
    token = f"load/{uuid.uuid4()}"
    if load_key is not None:
        token = f"load/{domain}/{load_key}/{batches.content_key(landed, RAW_COLUMNS[domain])}"
    batch_id = batches.claim(spark, root, token)
    apply_load(spark, root, domain, landed, batch_id, n_buckets, incremental, load_once)
    return batch_id


def apply_load(spark: SparkSession, root: str, domain: str, landed: DataFrame, batch_id: int,
               n_buckets: int = DEFAULT_BUCKETS, incremental: bool = False, load_once: bool = False) -> None:
    """Land, clean and merge the batch with the claimed id ``batch_id`` (the body of a load or micro-batch).

    With ``incremental`` the kept aggregates absorb what the MERGE changed
    (:mod:`carelake.streaming.incremental`); a root that keeps them has
    every load absorbed.  With ``load_once`` the rows of landing files that
    another load has committed are left out (S8).
    """
    if batches.is_done(spark, root, batch_id):
        return
    incremental = incremental or has_state(spark, root, domain)
    if load_once:
        landed = batches.unloaded(spark, root, domain, landed, batch_id)
    write_raw(landed.withColumn("batch_id", F.lit(batch_id).cast("bigint")), root, domain)
    raw = _read_batch(spark, f"{root}/raw/{domain}", landed.schema, batch_id)
    prepared = C.prepare(domain, raw)
    # Exceptions and the deduplicated batch both derive from the landed rows
    # and do not depend on each other: two jobs side by side.  The staged
    # batch is read twice by the MERGE (bucket list, upsert) and is also the
    # recovery point if an executor is lost.
    staged = f"{root}/_staging/{domain}"
    run_concurrently({
        "exceptions": lambda: write_exceptions(C.exceptions(domain, prepared, batch_id), root),
        "stage": lambda: write_partitioned(
            C.clean(domain, prepared).withColumn("batch_id", F.lit(batch_id).cast("bigint")), staged, ["batch_id"]),
    }, 2)
    batch = _read_batch(spark, staged, C.clean(domain, prepared).schema, batch_id).drop("batch_id")
    table = core_table(root, domain)
    versioned.merge(spark, table, batch, batch_id)
    mark_core_change(spark, root, domain)
    if incremental:
        from carelake.streaming.incremental import advance

        advance(spark, root, domain)
    if len((versioned.entry(spark, table.path) or {"deltas": ()})["deltas"]) >= MAX_DELTAS:
        versioned.compact(spark, table)
    if load_once:
        batches.record_files(spark, root, domain, raw, batch_id)
    batches.mark_done(spark, root, batch_id)
    delete(spark, f"{staged}/batch_id={batch_id}")


def has_state(spark: SparkSession, root: str, domain: str) -> bool:
    from carelake.streaming.incremental import latest_state, specs_for

    return any(latest_state(spark, root, name) is not None for name in specs_for(domain))


def compact_core(spark: SparkSession, root: str) -> dict[str, int | None]:
    """Fold the deltas of every CORE table into its base files (maintenance, apart from the loads)."""
    return {d: versioned.compact(spark, core_table(root, d)) for d in DOMAINS}


def ingest_all(spark: SparkSession, root: str, landed: dict[str, DataFrame], load_key: str | int | None = None,
               n_buckets: int = DEFAULT_BUCKETS, parallel: bool = True, incremental: bool = False,
               load_once: bool = False) -> None:
    """Patients first (X14), then appointments and billing side by side."""
    if "patients" in landed:
        ingest(spark, root, "patients", landed["patients"], load_key, n_buckets, incremental, load_once)
    rest = {d: (lambda d=d: ingest(spark, root, d, landed[d], load_key, n_buckets, incremental, load_once))
            for d in DOMAINS if d != "patients" and d in landed}
    run_concurrently(rest, 2 if parallel else 1)


def refresh_mart(spark: SparkSession, root: str, skip: tuple[str, ...] = (), **wh_kw) -> dict[str, str]:
    """Rebuild the MART snapshots from stored CORE (T6), as concurrent jobs.

    Facts and ``dim_patient`` are projections resolved over CORE at read time,
    so they are never stale.  ``skip`` names tables kept current elsewhere
    (the incremental aggregates).
    """
    from carelake.warehouse import Warehouse

    workers = wh_kw.pop("parallel_jobs", 4)
    wh = Warehouse.from_storage(spark, root, [f"core_{d}" for d in DOMAINS], masked=False, **wh_kw)
    names = [n for n in MART_SNAPSHOTS if n not in skip]
    plans = {n: wh.resolve(n) for n in names}  # plans built on the driver thread
    return run_concurrently({n: (lambda n=n: write_snapshot(spark, plans[n], root, n)) for n in names}, workers)


def run_batch(spark: SparkSession, root: str, landed: dict[str, DataFrame], load_key: str | int | None = None,
              n_buckets: int = DEFAULT_BUCKETS, incremental: bool = False, load_once: bool = False,
              **wh_kw) -> dict[str, str]:
    """Full load: every domain merged into CORE, then the MART refreshed.

    With ``incremental`` the additive aggregates' state is also started, so
    later loads can maintain them per batch instead of rebuilding.
    """
    ingest_all(spark, root, landed, load_key, n_buckets, incremental=incremental, load_once=load_once)
    skip: tuple[str, ...] = ()
    if incremental:
        from carelake.streaming.incremental import SPECS

        skip = tuple(SPECS)  # published by the incremental state just started
    return refresh_mart(spark, root, skip=skip, **wh_kw)
