"""RAW tables derived from the driver's TPC-H-like parquet tables.

The mapping is a fixed recipe (integer arithmetic only, so every engine
computes identical strings); it produces dirty rows on purpose: bad dates,
'[at]' emails, short phones, padded / unknown statuses, negative amounts,
unsupported payment modes and missing insurers.  All joins are equi-joins
declared through the DataFrame API; Catalyst broadcasts the small reference
tables (nation, region, the ten doctor rows) from their file statistics.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the recipe --------------------------------------------
GENDER_BY_MOD4 = {0: "Male", 1: "Female", 2: "Other"}  # 3 -> NULL
SLOT_BY_MOD4 = {0: "Morning", 1: "Afternoon", 2: "Evening"}  # 3 -> NULL
STATUS_BY_EVENT = {
    "signup": " scheduled ",
    "purchase": "Completed",
    "error": "No-Show",
    "view": "CANCELLED",
    "click": "Unknown",
}
MODE_BY_FLAGS = {"AF": "Cash", "AO": "Card", "NF": "UPI", "NO": "Insurance", "RF": "Insurance", "RO": "Cheque"}
BAD_DOB = "31/02/1995"
SHORT_PHONE = "12345"
DOCTOR_COUNT = 10


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(expr: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(expr == F.lit(k), F.lit(v)) if out is None else out.when(expr == F.lit(k), F.lit(v)))
    return out


def _s(c: Column) -> Column:
    return c.cast("string")


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _audit(source: str) -> list[Column]:
    return [F.lit(None).cast("timestamp_ntz").alias("_loaded_at"), F.lit(source).alias("_source_file")]


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    d = F.date_add(F.lit("1950-01-01").cast("date"), ((k * 37) % 20000).cast("int"))
    reg = F.date_add(F.lit("2015-01-01").cast("date"), ((k * 13) % 3000).cast("int"))
    joined = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    return joined.select(
        _s(k).alias("patient_id"),
        F.concat(F.lit("Patient "), _s(k % 400)).alias("full_name"),
        F.when(k % 20 == 0, F.lit(BAD_DOB))
        .when(k % 20 == 1, F.date_format(d, "dd/MM/yyyy"))
        .otherwise(_iso(d))
        .alias("dob"),
        _case(k % 4, GENDER_BY_MOD4).alias("gender"),
        F.when(k % 10 == 3, F.lit(SHORT_PHONE)).otherwise(_s(F.lit(9000000000) + k)).alias("phone"),
        F.when(k % 10 == 7, F.concat(F.lit("p"), _s(k), F.lit("[at]example.com")))
        .otherwise(F.concat(F.lit("p"), _s(k), F.lit("@example.com")))
        .alias("email"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        _iso(reg).alias("registration_date"),
        *_audit("customer"),
    )


def raw_appointments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    # Doctors are suppliers 0..9: a fixed-size side, broadcast by size statistics.
    doctors = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name").filter(
        F.col("s_suppkey").between(0, DOCTOR_COUNT - 1)
    )
    e = F.col("event_id")
    joined = ev.join(doctors, (e % DOCTOR_COUNT) == F.col("s_suppkey"))
    return joined.select(
        _s(e).alias("appt_id"),
        _iso(F.col("ts")).alias("appt_date"),
        _s(F.col("user_id")).alias("patient_id"),
        _s(e % DOCTOR_COUNT).alias("doctor_id"),
        F.col("s_name").alias("doctor_name"),
        F.concat(F.lit("Dept "), _s(F.col("user_id") % 5)).alias("department"),
        _case(e % 4, SLOT_BY_MOD4).alias("slot"),
        _case(F.col("event_type"), STATUS_BY_EVENT).alias("status"),
        *_audit("events"),
    )


def raw_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    g = F.col("l_extendedprice").cast("decimal(12,2)")
    signed = F.when(F.col("l_partkey") % 20 == 0, -g).otherwise(g)

    def part_of(rate: str) -> Column:
        amt = (g * F.col(rate).cast("decimal(4,2)")).cast("decimal(12,2)")
        return F.when(F.col(rate) == 0, F.lit(None).cast("string")).otherwise(_s(amt))

    flags = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    insurer = F.concat(F.lit("Insurer "), _s(F.col("l_suppkey") % 7))
    return joined.select(
        _s(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("bill_id"),
        _iso(F.col("l_shipdate")).alias("bill_date"),
        _s(F.col("o_custkey")).alias("patient_id"),
        F.col("p_type").alias("service_code"),
        F.concat(F.col("p_type"), F.lit(" service")).alias("service_desc"),
        F.concat(F.lit("Dept "), _s(F.col("l_partkey") % 5)).alias("department"),
        _s(signed).alias("gross_amount"),
        part_of("l_discount").alias("discount_amount"),
        part_of("l_tax").alias("tax_amount"),
        _s(signed).alias("net_amount"),
        _case(flags, MODE_BY_FLAGS).alias("payment_mode"),
        F.when(flags == "NO", insurer)
        .when((flags == "RF") & (F.col("l_suppkey") % 2 == 0), insurer)
        .alias("insurer_name"),
        *_audit("lineitem"),
    )


RAW_BUILDERS = {
    "patients": raw_patients,
    "appointments": raw_appointments,
    "billing": raw_billing,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {d: f(spark, sf_dir) for d, f in RAW_BUILDERS.items()}
