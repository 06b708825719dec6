"""Landing CSV files -> all-string RAW rows.

Format: ',' delimiter, one header line, optional '"' quoting, spaces trimmed,
short rows padded with NULL and long rows cut (PERMISSIVE + positional
schema), and the tokens of ``NULL_TOKENS`` read as NULL.  Spark's
``nullValue`` takes a single token, so the token rule is a Column expression
applied after the scan.  ``.csv.gz`` files are read transparently (gzip is
not splittable: land many files rather than one large one).

Files are routed to a domain by name (``FILE_GLOB``); columns are mapped by
position, the header is skipped.  Every row carries ``_source_file`` and
``_loaded_at`` (the file's modification time) from the file-source metadata.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.constants import FILE_GLOB, NULL_TOKENS
from carelake.schemas import RAW_COLUMNS, raw_schema

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "enforceSchema": "true",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}


def null_token(c: Column) -> Column:
    """TRIM_SPACE + NULL_IF: trimmed text, NULL for any null token."""
    t = F.trim(c)
    return F.when(t.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(t)


def normalise(df: DataFrame, domain: str) -> DataFrame:
    return df.select(
        *[null_token(F.col(c)).alias(c) for c in RAW_COLUMNS[domain]],
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_loaded_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def _reader(spark: SparkSession, domain: str, streaming: bool, max_files: int | None):
    r = (spark.readStream if streaming else spark.read).format("csv").schema(raw_schema(domain))
    r = r.options(**CSV_OPTIONS).option("pathGlobFilter", FILE_GLOB[domain])
    if streaming and max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r


def read_landing(spark: SparkSession, path: str, domain: str) -> DataFrame:
    """Batch scan of every file of ``domain`` under ``path`` (S9 bulk load)."""
    return normalise(_reader(spark, domain, False, None).load(path), domain)


def stream_landing(spark: SparkSession, path: str, domain: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan (T1): each file is delivered once, existing files first."""
    return normalise(_reader(spark, domain, True, max_files_per_trigger).load(path), domain)


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """S3: LIST @stage -- file path, size and modification time, no content read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(path)
    return files.select("path", "length", "modificationTime")
