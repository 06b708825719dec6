"""Landing directory -> micro-batches -> CORE MERGE -> MART refresh.

One streaming query per domain reads the landing directory through the file
source (routed by file name).  The file-source checkpoint is the change
feed's offset: a file is delivered once, existing files first (T1), the
offset advances only when the micro-batch commits (T3), and a new checkpoint
directory delivers everything again (T5): files that were landed stay landed
once, or with ``redeliver`` are landed as new loads and merged again.  ``foreachBatch`` runs the same
``pipeline.apply_load`` as the batch path under an id claimed for (query id,
micro-batch), so a replayed micro-batch rewrites itself and nothing else.
Files that any earlier load has committed are not landed again.

``trigger(availableNow=True)`` is the has-data gate (T2): it processes what is
pending and stops, doing nothing when no new file arrived.  A
``processingTime="5 minutes"`` trigger gives the scheduled form.
"""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.constants import DOMAINS
from carelake.pipeline import DEFAULT_BUCKETS, apply_load, refresh_mart
from carelake.sources.batches import claim, is_done, stream_id
from carelake.sources.csv import stream_landing


def start_ingest(spark: SparkSession, landing: str, root: str, domain: str, *, checkpoint: str | None = None,
                 trigger: dict | None = None, n_buckets: int = DEFAULT_BUCKETS,
                 max_files_per_trigger: int | None = None, incremental: bool = False, on_rows=None,
                 redeliver: bool = False) -> StreamingQuery:
    """Start the query of one domain; ``on_rows`` is told the rows of every finished micro-batch.

    With ``redeliver`` files are taken that earlier loads have landed (a replay of the feed): each is a load of its own,
    later than those before it.
    """
    ckpt = checkpoint or f"{root}/_checkpoints/{domain}"

    def process(batch_df, batch_id: int) -> None:
        session = batch_df.sparkSession
        claimed = claim(session, root, f"stream/{stream_id(session, ckpt)}/{batch_id}")
        if on_rows is None or is_done(session, root, claimed):  # a finished load reads nothing that could be counted on
            apply_load(session, root, domain, batch_df, claimed, n_buckets, incremental, load_once=not redeliver)
            rows = batch_df.count() if on_rows is not None else 0
        else:  # counted as the load's first scan of the files passes by
            seen = Observation()
            counted = batch_df.observe(seen, F.count(F.lit(1)).alias("rows"))
            apply_load(session, root, domain, counted, claimed, n_buckets, incremental, load_once=not redeliver)
            rows = seen.get["rows"]
        if on_rows is not None:
            on_rows(rows)

    src = stream_landing(spark, landing, domain, max_files_per_trigger)
    return (src.writeStream.queryName(f"ingest_{domain}")
            .foreachBatch(process)
            .option("checkpointLocation", ckpt)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def run_available(spark: SparkSession, landing: str, root: str, *, checkpoint: str | None = None,
                  refresh: bool | str = True, n_buckets: int = DEFAULT_BUCKETS,
                  max_files_per_trigger: int | None = None, redeliver: bool = False, **wh_kw) -> dict[str, int]:
    """Process every pending file of every domain, then refresh the MART.

    ``refresh``: True / "full" rebuilds every MART snapshot after the run;
    "incremental" updates the additive aggregates inside each micro-batch
    (dimensions and facts then resolve over CORE); False skips the refresh.
    Returns rows consumed per domain; when nothing was pending the MART is
    not refreshed (the has-data gate).
    """
    incremental = refresh == "incremental"
    consumed: dict[str, int] = dict.fromkeys(DOMAINS, 0)
    for d in DOMAINS:  # patients first
        def add(rows: int, d: str = d) -> None:
            consumed[d] += rows

        q = start_ingest(spark, landing, root, d,
                         checkpoint=None if checkpoint is None else f"{checkpoint}/{d}", n_buckets=n_buckets,
                         incremental=incremental, max_files_per_trigger=max_files_per_trigger, on_rows=add,
                         redeliver=redeliver)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    if refresh and not incremental and any(consumed.values()):
        refresh_mart(spark, root, **wh_kw)
    return consumed
