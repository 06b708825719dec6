"""V0-V5 data-quality checks and J5/J6 foreign-key integrity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.constants import DOMAINS, SOURCE_TABLE
from carelake.functions.metrics import count_rows, rate_pct
from carelake.operators.integrity import fk_orphans as _orphans
from carelake.operators.integrity import fk_valid as _valid
from carelake.schemas import KEYS


def _count(df: DataFrame, **labels) -> DataFrame:
    cols = [F.lit(v).alias(k) for k, v in labels.items()]
    return df.agg(count_rows().alias("cnt")).select(*cols, "cnt")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raw_row_counts(wh) -> DataFrame:
    """V0: rows landed per RAW table."""
    return _union([_count(wh.table(f"raw_{d}"), tbl=SOURCE_TABLE[d]) for d in DOMAINS])


def layer_pass_rate(wh) -> DataFrame:
    """V1: RAW vs CORE counts with the share that reached CORE.

    Six one-row counts are unioned and folded per domain by a conditional
    aggregate (no join between the scalar counts).
    """
    counts = _union(
        [_count(wh.table(f"{layer}_{d}"), domain=d.upper(), layer=layer) for d in DOMAINS for layer in ("raw", "core")]
    )
    g = counts.groupBy("domain").agg(
        F.sum(F.when(F.col("layer") == "raw", F.col("cnt"))).cast("bigint").alias("raw_count"),
        F.sum(F.when(F.col("layer") == "core", F.col("cnt"))).cast("bigint").alias("core_count"),
    )
    return g.select("domain", "raw_count", "core_count", rate_pct(F.col("core_count"), F.col("raw_count"), 1).alias("pass_rate_pct"))


def rejection_summary(wh) -> DataFrame:
    """V2: rejected records by table and reason, largest first."""
    e = wh.table("exceptions")
    g = e.groupBy("source_table", "rejection_reason").agg(count_rows().alias("rejected_count"))
    return g.orderBy(F.col("rejected_count").desc(), "source_table", "rejection_reason")


def dim_duplicate_keys(wh) -> DataFrame:
    """V3: dimension keys that occur more than once (expected: none)."""
    parts = []
    for tbl, key in (("DIM_PATIENT", "patient_key"), ("DIM_DOCTOR", "doctor_key")):
        g = wh.table(tbl.lower()).groupBy(F.col(key).alias("dim_key")).agg(count_rows().alias("cnt"))
        parts.append(g.filter(F.col("cnt") > 1).select(F.lit(tbl).alias("tbl"), "dim_key", "cnt"))
    return _union(parts)


def core_duplicate_keys(wh) -> DataFrame:
    """G14 for CORE: ids that occur more than once (none, while every load is a MERGE).  The KPI counts of distinct ids
    count rows, which rests on this."""
    parts = []
    for d in DOMAINS:
        g = wh.table(f"core_{d}").groupBy(F.col(KEYS[d]).alias("core_key")).agg(count_rows().alias("cnt"))
        parts.append(g.filter(F.col("cnt") > 1).select(F.lit(f"CORE_{d.upper()}").alias("tbl"), "core_key", "cnt"))
    return _union(parts)


def null_fk_check(wh) -> DataFrame:
    """V4: fact rows without a patient key."""
    return _union([
        _count(wh.table(t).filter(F.col("patient_key").isNull()), fact_table=t.upper(), issue="NULL_PATIENT_FK")
        for t in ("fact_appointment", "fact_billing")
    ])


def negative_amounts(wh) -> DataFrame:
    """V5: CORE billing rows with a negative amount (expected: 0)."""
    b = wh.table("core_billing")
    return b.filter((F.col("gross_amount") < 0) | (F.col("net_amount") < 0)).agg(
        count_rows().alias("negative_amounts")
    )


def fk_valid_appointments(wh) -> DataFrame:
    return _valid(wh.table("fact_appointment"), wh.table("dim_patient"), "patient_key")


def fk_valid_billing(wh) -> DataFrame:
    return _valid(wh.table("fact_billing"), wh.table("dim_patient"), "patient_key")


def fk_orphans(wh) -> DataFrame:
    """Fact rows whose patient is not in the patient dimension; from the ledgers that loads keep, where stored."""
    parts = []
    for fact, ledger, key in (("fact_appointment", "orphans_appointments", "appt_id"), ("fact_billing", "orphans_billing", "bill_id")):
        if wh.holds(ledger):
            rows = wh.table(ledger).select("record_id", "patient_key")
        else:
            rows = _orphans(wh.table(fact), wh.table("dim_patient"), "patient_key").select(F.col(key).alias("record_id"), "patient_key")
        parts.append(rows.select(F.lit(fact.upper()).alias("fact_table"), "record_id", "patient_key"))
    return _union(parts)
