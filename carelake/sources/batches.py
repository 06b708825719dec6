"""Batch identity (S8, S9, M2, T5): one id per load, unique below a root.

A load is named by a *token*: a stream's micro-batch by its query id and
number, a bulk load by its key and the content of its rows.  The first claim
of a token allots the next free number below ``<root>/_batches``; a later
claim of the same token (a replay) returns the same number.  So the replay
of a failed load rewrites its own partitions, that of a finished load does
nothing (its rows must not overwrite those of later loads), and two different
loads never share a number, whichever route (bulk load, stream, reset stream)
they come by.

``_batches/files`` records the landing files a committed load has taken, by
path, length and modification time: a file is landed once, whether a bulk load
or a stream sees it first, and a corrected file of the same name is landed
again.  A load asks the ledger for its own few paths only (a pushed-down
filter; :func:`compact_files` keeps the ledger in path order).
Names starting with '_' are invisible to the parquet reader.
"""

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.sources.sinks import (
    _fs,
    delete,
    exists,
    has_partitions,
    list_names,
    publish_text,
    read_text,
    write_partitioned,
    write_text,
)

FILES_SCHEMA = "_source_file string, length bigint, modified bigint, load bigint"
#: Partition of the ledger that holds the compacted entries.
COMPACTED = -1
_LOCK = threading.Lock()


def claim(spark: SparkSession, root: str, token: str) -> int:
    """The id of the load named ``token``; allotted on first use.

    The number is taken by creating its file without overwriting, so two
    drivers cannot take the same one (on stores with atomic create).  A crash
    before the token is recorded only leaves a number unused.
    """
    with _LOCK:
        named = f"{root}/_batches/tokens/{hashlib.sha256(token.encode()).hexdigest()[:32]}"
        known = read_text(spark, named)
        if known:
            return int(known)
        last = f"{root}/_batches/last"
        n = int(read_text(spark, last) or -1) + 1
        while not _take(spark, f"{root}/_batches/ids/{n}"):
            n += 1
        write_text(spark, last, str(n))
        if publish_text(spark, named, str(n)):
            return n
        return int(read_text(spark, named))  # another driver claimed the token meanwhile; n stays unused


def _take(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.createNewFile(p))


def is_done(spark: SparkSession, root: str, batch_id: int) -> bool:
    return exists(spark, f"{root}/_batches/done/{batch_id}")


def mark_done(spark: SparkSession, root: str, batch_id: int) -> None:
    """The batch is in CORE and in every aggregate: claiming it again does no work."""
    write_text(spark, f"{root}/_batches/done/{batch_id}", "")


def content_key(landed: DataFrame, columns: list[str]) -> str:
    """Row count and order-free hash sums of the business columns: equal for the same rows landed again."""
    h = F.xxhash64(*columns)
    r = landed.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    return f"{r[0]}/{r[1]}/{r[2]}"


def identities(spark: SparkSession, rows: DataFrame) -> set[tuple[str, int, int]]:
    """(path, length, modification time in ms) of the landing files behind some rows: as many as the load has files.

    The length comes from the store; of a file that has gone since, it is -1.
    """
    names = rows.filter(F.col("_source_file").isNotNull()).select(
        "_source_file", F.unix_millis(F.col("_loaded_at").cast("timestamp")).alias("modified")).distinct().collect()
    out = set()
    for path, modified in names:
        fs, p = _fs(spark, path)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(path))
        out.add((path, int(fs.getFileStatus(p).getLen()) if fs.exists(p) else -1, int(modified or 0)))
    return out


def _ledger(spark: SparkSession, root: str, domain: str) -> DataFrame | None:
    path = f"{root}/_batches/files/{domain}"
    return spark.read.schema(FILES_SCHEMA + ", batch_id bigint").parquet(path) if has_partitions(spark, path) else None


def taken(spark: SparkSession, root: str, domain: str, files: set[tuple[str, int, int]], batch_id: int) -> set[tuple[str, int, int]]:
    """Which of ``files`` another committed load has taken."""
    ledger = _ledger(spark, root, domain)
    if ledger is None or not files:
        return set()
    mine = ledger.filter(F.col("_source_file").isin(sorted({f[0] for f in files})) & (F.col("load") != batch_id))
    return files & {tuple(r) for r in mine.select("_source_file", "length", "modified").distinct().collect()}


def unloaded(spark: SparkSession, root: str, domain: str, landed: DataFrame, batch_id: int) -> DataFrame:
    """Rows of files that no other committed load has taken."""
    if _ledger(spark, root, domain) is None:
        return landed
    gone = {f[0] for f in taken(spark, root, domain, identities(spark, landed), batch_id)}
    if not gone:
        return landed
    return landed.filter(F.col("_source_file").isNull() | ~F.col("_source_file").isin(sorted(gone)))


def record_files(spark: SparkSession, root: str, domain: str, raw: DataFrame, batch_id: int) -> None:
    """Note the files of a committed load."""
    rows = [(*f, batch_id, batch_id) for f in sorted(identities(spark, raw))]
    if rows:
        files = spark.createDataFrame(rows, FILES_SCHEMA + ", batch_id bigint").coalesce(1)
        write_partitioned(files, f"{root}/_batches/files/{domain}", ["batch_id"])


def compact_files(spark: SparkSession, root: str, domain: str) -> None:
    """Fold the ledger's partitions into one in path order.  Entries may be there twice in between, which changes no
    answer; the partitions that were folded go last."""
    path = f"{root}/_batches/files/{domain}"
    parts = [n for n in list_names(spark, path) if n.startswith("batch_id=") and n != f"batch_id={COMPACTED}"]
    ledger = _ledger(spark, root, domain)
    if ledger is None or not parts:
        return
    folded = f"{root}/_batches/folding/{domain}"
    ledger.select("_source_file", "length", "modified", "load").distinct().write.mode("overwrite").parquet(folded)
    rows = spark.read.schema(FILES_SCHEMA).parquet(folded).withColumn("batch_id", F.lit(COMPACTED).cast("bigint"))
    order = ["_source_file"]
    write_partitioned(rows.repartitionByRange(*order).sortWithinPartitions(*order), path, ["batch_id"])
    for n in parts:
        delete(spark, f"{path}/{n}")
    delete(spark, folded)


def fold_claims(spark: SparkSession, root: str, keep: int = 1000) -> int:
    """Drop the notes of finished loads but the newest ``keep``: a stream replays its last micro-batch only, and a bulk
    load that is repeated under its key after so many others counts as a new one.  Returns how many went."""
    with _LOCK:
        done = sorted((int(n) for n in list_names(spark, f"{root}/_batches/done") if n.isdigit()), reverse=True)
        old = {n for n in done[keep:]}
        for name in list_names(spark, f"{root}/_batches/tokens"):
            if int(read_text(spark, f"{root}/_batches/tokens/{name}") or -1) in old:
                delete(spark, f"{root}/_batches/tokens/{name}")
        for n in old:
            delete(spark, f"{root}/_batches/ids/{n}")
            delete(spark, f"{root}/_batches/done/{n}")
        return len(old)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that owns ``checkpoint`` (written before its first batch); a new folder is a new id."""
    path = f"{checkpoint}/metadata"
    return read_text(spark, path).strip() if exists(spark, path) else checkpoint
