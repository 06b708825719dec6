"""S1 as a checked query: RAW rows rendered as CSV lines and read back with the landing rules."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.constants import NULL_TOKENS
from carelake.sources.csv import CSV_OPTIONS, null_token

COLUMNS = ["patient_id", "full_name", "gender", "city", "email"]


def csv_scan_nulls(wh) -> DataFrame:
    """Every kind of null token, padded and quoted fields, short and long lines.

    A missing gender is written as one of the null tokens, every seventh city too; each fifth line ends before the
    e-mail (a short row), the one after has a field too many (a long row).
    """
    r = wh.table("raw_patients")
    n = F.col("patient_id").cast("bigint")
    token = F.element_at(F.array(*map(F.lit, NULL_TOKENS)), (n % len(NULL_TOKENS) + 1).cast("int"))
    quoted = lambda c: F.when(n % 3 == 0, F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)
    padded = lambda c: F.concat(F.lit("  "), c, F.lit(" "))
    fields = [
        F.col("patient_id"),
        quoted(F.col("full_name")),
        F.coalesce(F.col("gender"), token),
        padded(F.when(n % 7 == 3, token).otherwise(quoted(F.col("city")))),
    ]
    email = F.when(n % 5 == 1, F.concat(F.col("email"), F.lit(",further"))).otherwise(F.col("email"))
    line = F.when(n % 5 == 0, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, email))
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "enforceSchema")}
    row = F.from_csv(line, ", ".join(f"{c} string" for c in COLUMNS), options)
    return r.select(row.alias("row")).select(*[null_token(F.col(f"row.{c}")).alias(c) for c in COLUMNS])
