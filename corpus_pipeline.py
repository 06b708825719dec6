"""The corpus pipeline: documents through five operators, each stage written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``.  Rows with
nulls, empty and very long texts, repeated rows, empty tables and further columns pass through as the operators' own
docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm.byte_bpe import encode_documents
from carelake.llm.common import materialize, ship
from carelake.llm.line_dedup import drop_lines
from carelake.llm.mixing import apply_mix
from carelake.llm.quality_rules import keep_good
from carelake.llm.simhash import keep_one

RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, or the verdict on their host, reject go."""
    ship(spark)
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that three documents or more hold stay in the last of them only."""
    ship(spark)
    return drop_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest id stays."""
    ship(spark)
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one a source's share ends in is cut there."""
    ship(spark)
    return apply_mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) and digests of what was encoded and decoded again."""
    import public_tokenizers

    ship(spark)
    path = public_tokenizers.path(RANK_FILE)
    out = encode_documents(docs, path, public_tokenizers.PATTERN, with_decoded=False)
    return out.select("doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: SimHash needs XXH64, which DuckDB lacks; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
