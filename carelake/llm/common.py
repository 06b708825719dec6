"""Helpers the operators share: the shared scratch folder, written tables, row keys."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"

_UNSET_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Only where it is unset (plain test sessions) a
    local temporary folder is used instead."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _UNSET_DIRS:
        _UNSET_DIRS[app] = tempfile.mkdtemp(prefix="carelake-")
    return _UNSET_DIRS[app]


def ship(spark: SparkSession) -> None:
    """Hand the package to the executors' Python once per application, so that nothing depends on their paths."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="carelake-"), "carelake_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("carelake", os.path.relpath(full, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: a lineage cut that every executor
    sees and that outlives a lost executor.  Each call writes a folder of its own."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps partitions and their order (never a local one)."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def text_key(text: Column) -> Column:
    """Key of a text next to its doc_id: rows that repeat a doc_id with other words stay apart, rows that
    repeat both get the same decision."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_names(columns: list[str], *names: str) -> list[str]:
    """``names``, each lengthened until no column has it (Spark compares them without case)."""
    used = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
