"""Parquet sinks of the warehouse layout.

Layout under one root (shared storage on a cluster)::

    raw/<domain>/batch_id=<n>/                  landed rows (per micro-batch)
    raw/exceptions/source_table=<t>/batch_id=<n>/
    core/<domain>/                              versions of upserted CORE (M1, ``versioned``)
    mart/<name>/v=<version>/                    refreshed snapshots
    _state/<name>/v=<CORE version>/             aggregates kept current by load (T6)

Every batch-keyed write overwrites exactly its own partitions (dynamic
partition overwrite), so a replayed micro-batch rewrites instead of
duplicating.  MART snapshots are written to a new version directory and the
readers pick the newest committed one, so a refresh never overwrites what a
reader is scanning.
"""

import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from carelake.constants import DOMAINS

_PUBLISH = threading.Lock()

# CORE tables behind each computed dimension.
DIMENSION_INPUTS = {
    "dim_date": ("appointments", "billing"),
    "dim_doctor": ("appointments",),
    "dim_service": ("billing",),
    "dim_department": ("appointments", "billing"),
}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def committed(spark: SparkSession, path: str) -> bool:
    """A snapshot directory whose writing job committed (``_SUCCESS``)."""
    fs, p = _fs(spark, path.rstrip("/") + "/_SUCCESS")
    return bool(fs.exists(p))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a small metadata file, None where there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small metadata file whole, or not at all if the name is taken (on stores whose rename is atomic)."""
    jvm = spark.sparkContext._jvm
    hidden = path.rsplit("/", 1)[0] + f"/.{uuid.uuid4().hex}"
    write_text(spark, hidden, text)
    to = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kinds = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    with _PUBLISH:  # a local folder's rename has no such check of its own
        if exists(spark, path):
            delete(spark, hidden)
            return False
        try:
            context.rename(jvm.org.apache.hadoop.fs.Path(hidden), to, kinds)
        except Exception:  # noqa: BLE001 - whichever way the store says that the name is taken
            delete(spark, hidden)
            if exists(spark, path):
                return False
            raise
    return True


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of the warehouse, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none where it is missing), without hidden ones."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [n for n in (st.getPath().getName() for st in fs.listStatus(p)) if not n.startswith(".")]


def has_partitions(spark: SparkSession, path: str) -> bool:
    """A partitioned table with at least one partition directory.

    Partition-overwrite jobs swap whole directories at commit and leave no
    root ``_SUCCESS`` marker, so presence of ``col=value`` directories is the
    committed state.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    return any(st.isDirectory() and "=" in st.getPath().getName() for st in fs.listStatus(p))


def write_partitioned(df: DataFrame, path: str, partition_by: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_raw(df: DataFrame, root: str, domain: str) -> None:
    write_partitioned(df, f"{root}/raw/{domain}", ["batch_id"])


def write_exceptions(df: DataFrame, root: str) -> None:
    write_partitioned(df, f"{root}/raw/exceptions", ["source_table", "batch_id"])


def write_snapshot(spark: SparkSession, df: DataFrame, root: str, name: str) -> str:
    version = time.time_ns() // 1000
    path = f"{root}/mart/{name}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def latest_snapshot(spark: SparkSession, root: str, name: str) -> str | None:
    fs, p = _fs(spark, f"{root}/mart/{name}")
    if not fs.exists(p):
        return None
    versions = []
    for st in fs.listStatus(p):
        n = st.getPath().getName()
        if st.isDirectory() and n.startswith("v="):
            full = st.getPath().toString()
            if committed(spark, full):
                versions.append((int(n[2:]), full))
    return max(versions)[1] if versions else None


def mark_core_change(spark: SparkSession, root: str, domain: str) -> None:
    """Note when CORE of ``domain`` last changed (after its MERGE)."""
    write_text(spark, f"{root}/_core_changed/{domain}", str(time.time_ns() // 1000))


def _outdated(spark: SparkSession, root: str, name: str, snapshot: str) -> bool:
    """A dimension snapshot begun before the last change of a CORE table it derives from."""
    version = int(snapshot.rstrip("/").rsplit("v=", 1)[1])
    changes = (read_text(spark, f"{root}/_core_changed/{d}") for d in DIMENSION_INPUTS.get(name, ()))
    return any(c is not None and int(c) >= version for c in changes)


def read_stored_tables(spark: SparkSession, root: str, names=None) -> dict[str, DataFrame]:
    """Every committed table under ``root`` (optionally only ``names``).

    Facts are inner-joined to the computed dimensions, so an outdated
    dimension would drop the facts of new days, doctors and services: such a
    snapshot is left out and the dimension resolves over the kept aggregates,
    or over CORE where there are none.  CORE tables are bound to the version
    that is the newest now; a kept aggregate comes only if it is at that
    version, so a load that failed half-way is never seen in part.
    """
    from carelake.sources.tables import core_table
    from carelake.sources.versioned import entry, read
    from carelake.streaming.incremental import stored_states

    out: dict[str, DataFrame] = {}
    at: dict[str, int] = {}
    for d in DOMAINS:
        if (names is None or f"raw_{d}" in names) and has_partitions(spark, f"{root}/raw/{d}"):
            out[f"raw_{d}"] = spark.read.parquet(f"{root}/raw/{d}")
        now = entry(spark, f"{root}/core/{d}")
        if now is None:
            continue
        at[d] = now["version"]
        if names is None or f"core_{d}" in names:
            out[f"core_{d}"] = read(spark, core_table(root, d), at[d])
    if (names is None or "exceptions" in names) and has_partitions(spark, f"{root}/raw/exceptions"):
        out["exceptions"] = spark.read.parquet(f"{root}/raw/exceptions")
    fs, p = _fs(spark, f"{root}/mart")
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if names is not None and name not in names:
                continue
            path = latest_snapshot(spark, root, name)
            if path and not _outdated(spark, root, name, path):
                out[name] = spark.read.parquet(path)
    return out | {n: df for n, df in stored_states(spark, root, at).items() if names is None or n in names}
