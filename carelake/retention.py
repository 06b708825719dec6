"""What a root keeps.

Versions, states and snapshots are never changed in place, so old ones pile up
until this job takes them.  It keeps the newest few of each and whatever a
reader holds by a lease (``versioned.lease``), and may run beside loads.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from carelake.constants import DOMAINS
from carelake.sources import batches, versioned
from carelake.sources.sinks import committed, delete, list_names
from carelake.sources.tables import core_table

#: Snapshots of each MART table, and loads whose notes are kept.
KEEP_SNAPSHOTS, KEEP_LOADS = 3, 1000


def retain(spark: SparkSession, root: str, *, keep_versions: int = versioned.KEEP_VERSIONS,
           keep_snapshots: int = KEEP_SNAPSHOTS, keep_loads: int = KEEP_LOADS, grace: float = 3600.0) -> dict[str, int]:
    """Delete what is no longer needed; returns how many segments, snapshots, staged batches and notes went.

    CORE is compacted first, so that superseded rows can go at all.  A kept aggregate whose commits are taken is built
    again at the next load; with ``keep_versions`` above the loads between two runs this does not happen.
    """
    gone = {"segments": 0, "snapshots": 0, "staged": 0}
    for d in DOMAINS:
        table = core_table(root, d)
        versioned.compact(spark, table)
        gone["segments"] += versioned.vacuum(spark, table.path, keep_versions, grace)
        batches.compact_files(spark, root, d)
        for n in list_names(spark, f"{root}/_staging/{d}"):
            number = n.removeprefix("batch_id=")
            if number.isdigit() and batches.is_done(spark, root, int(number)):
                delete(spark, f"{root}/_staging/{d}/{n}")
                gone["staged"] += 1
    for name in list_names(spark, f"{root}/mart"):
        folder = f"{root}/mart/{name}"
        found = sorted(int(n[2:]) for n in list_names(spark, folder) if n.startswith("v=") and committed(spark, f"{folder}/{n}"))
        for v in found[:-keep_snapshots]:
            delete(spark, f"{folder}/v={v}")
            gone["snapshots"] += 1
    gone["loads"] = batches.fold_claims(spark, root, keep_loads)
    return gone
