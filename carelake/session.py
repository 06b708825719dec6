"""SparkSession defaults and the shared checkpoint location."""

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "carelake", **conf) -> SparkSession:
    """Session for local runs and tests; on a cluster the submitter's settings win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the session names none (local tests) is a scratch folder created
    and registered; on a cluster the setting must point at shared storage.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = tempfile.mkdtemp(prefix="carelake-ckpt-", dir=os.environ.get("CARELAKE_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d
