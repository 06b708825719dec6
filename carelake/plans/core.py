"""CORE layer as seen by a one-shot batch: prepared RAW -> clean -> dedup.

When CORE was materialised by the incremental pipeline, the stored table is
resolved instead (the Warehouse holds it explicitly) and these builders are
never reached.
"""

from pyspark.sql import DataFrame

from carelake.operators import clean as C


def prepared(domain: str):
    def build(wh) -> DataFrame:
        return C.prepare(domain, wh.resolve(f"raw_{domain}"))

    return build


def core(domain: str):
    def build(wh) -> DataFrame:
        df = C.clean(domain, wh.resolve(f"prepared_{domain}"))
        return df.select(*C.core_columns(domain), "_loaded_at", "_source_file")

    return build


def rejects(domain: str):
    def build(wh) -> DataFrame:
        return C.rejects(domain, wh.resolve(f"prepared_{domain}"))

    return build


def exceptions(wh) -> DataFrame:
    parts = [C.exceptions(d, wh.resolve(f"prepared_{d}")) for d in ("patients", "appointments", "billing")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
