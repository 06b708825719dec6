"""M1/M2: keyed upsert (MERGE ... WHEN MATCHED UPDATE / NOT MATCHED INSERT).

``upsert`` is the logical operator, one full outer join: target rows whose key is absent from the
batch are kept; batch rows replace or insert, carrying the target's
first-insert ``_cleaned_at``.  There is no delete branch.  Replaying the same
batch yields the same table (idempotent), which is what makes a failed
micro-batch safe to re-run.

``merge_into_path`` applies it to a parquet table partitioned by
``key_bucket = pmod(xxhash64(key), n)``: only buckets the batch touches are
read and rewritten (dynamic partition overwrite).  It is the plain form for a
table with one writer and no readers meanwhile; the pipeline's CORE tables are
versions with a log (:mod:`carelake.sources.versioned`).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.sources.sinks import _fs, committed, has_partitions, write_partitioned

BUCKET_COL = "key_bucket"


def upsert(target: DataFrame, batch: DataFrame, key: str, cleaned_at=None) -> DataFrame:
    """Result of merging ``batch`` (one row per key) into ``target``."""
    now = F.localtimestamp() if cleaned_at is None else F.lit(cleaned_at).cast("timestamp_ntz")
    src = batch if "_cleaned_at" in batch.columns else batch.withColumn("_cleaned_at", F.lit(None).cast("timestamp_ntz"))
    src = src.select(*target.columns, F.lit(True).alias("_new"))
    t, b = target.alias("t"), src.alias("b")
    new = F.col("b._new")
    cleaned = F.coalesce(F.col("t._cleaned_at"), F.when(new, now))
    return t.join(b, F.col(f"t.`{key}`") == F.col(f"b.`{key}`"), "full_outer").select(*[
        F.when(new, cleaned).otherwise(F.col("t._cleaned_at")).alias(c) if c == "_cleaned_at"
        else F.when(new, F.col(f"b.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
        for c in target.columns])


def bucket_of(key: str, n_buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_buckets)).cast("int")


def clustered(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows by bucket and then clustering columns, range-partitioned.

    A range may end inside a bucket, so a bucket larger than a partition is
    written by several tasks, each holding its own span of dates (S14), and
    small buckets share one.  No number of partitions is given, so adaptive
    execution sizes them by the data.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def stored_bucket_count(spark: SparkSession, path: str) -> int | None:
    """Bucket count fixed when the table was created (``_n_buckets=N`` marker;
    names starting with '_' are invisible to the parquet reader)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    for st in fs.listStatus(p):
        n = st.getPath().getName()
        if n.startswith("_n_buckets="):
            return int(n.split("=", 1)[1])
    return None


def _record_bucket_count(spark: SparkSession, path: str, n_buckets: int) -> None:
    fs, p = _fs(spark, f"{path.rstrip('/')}/_n_buckets={n_buckets}")
    fs.mkdirs(p)


def merge_into_path(
    spark: SparkSession, path: str, batch: DataFrame, key: str, n_buckets: int, sort_by: list[str] | None = None,
    replaced_path: str | None = None,
) -> None:
    """MERGE ``batch`` into the bucketed parquet table at ``path``.

    Reads only the touched buckets (partition pruning on ``key_bucket``),
    merges them into a staging table and then overwrites exactly those
    partitions of the target (dynamic partition overwrite: directories are
    swapped at job commit, so a failed swap job can simply be re-run from the
    staged copy).  ``sort_by`` orders rows inside
    each bucket file (S14 clustering) so parquet min/max statistics prune.

    ``replaced_path`` records the change set: the target rows this batch
    replaces, as they were before the MERGE.  It is written once per batch
    (a replay after a committed MERGE reuses it), so downstream incremental
    aggregates can subtract exactly what was replaced.
    """
    order = [BUCKET_COL] + list(sort_by or [])
    # A key must always hash to the same bucket: an existing table keeps the
    # bucket count it was created with, whatever the caller passes.
    n_buckets = stored_bucket_count(spark, path) or n_buckets
    src = batch.withColumn(BUCKET_COL, bucket_of(key, n_buckets))
    if "_cleaned_at" not in src.columns:
        src = src.withColumn("_cleaned_at", F.lit(None).cast("timestamp_ntz"))
    if not has_partitions(spark, path):
        if replaced_path and not committed(spark, replaced_path):
            src.limit(0).write.mode("overwrite").parquet(replaced_path)
        first = src.withColumn("_cleaned_at", F.coalesce("_cleaned_at", F.localtimestamp()))
        # The marker comes first and the write replaces only bucket folders:
        # a load that fails in between leaves the count that a retry must use.
        _record_bucket_count(spark, path, n_buckets)
        write_partitioned(clustered(first, order), path, [BUCKET_COL])
        return
    target = spark.read.parquet(path)
    # The touched buckets are at most ``n_buckets`` small ints: a static
    # partition filter on them prunes the target scan to those directories.
    touched = sorted(r[0] for r in src.select(BUCKET_COL).distinct().collect())
    if not touched:
        return
    affected = target.filter(F.col(BUCKET_COL).isin(touched))
    if replaced_path and not committed(spark, replaced_path):
        affected.join(src.select(key), key, "left_semi").write.mode("overwrite").parquet(replaced_path)
    merged = upsert(affected, src.select(*target.columns), key)
    # Never overwrite a path from a plan that reads it: the merged buckets are
    # written to a staging table first (also the recovery point if an
    # executor is lost), then swapped into the target partition by partition.
    staging = path.rstrip("/") + "__merge_staging"
    (clustered(merged, order)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET_COL).parquet(staging))
    write_partitioned(spark.read.parquet(staging), path, [BUCKET_COL])
