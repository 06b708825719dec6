import datetime

from pyspark.sql import functions as F

from carelake.functions.masking import mask_email, mask_name, mask_phone
from carelake.functions.metrics import rate_pct
from carelake.functions.parse import date_key, parse_dob, try_id, try_money
from carelake.plans.mart import age_group


def _one(spark, col, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_try_id_number_semantics(spark):
    vals = [("1001",), (" 1001 ",), ("1001.6",), ("1,001",), ("1e3",), ("abc",), (None,), ("99999999999999999999",)]
    assert _one(spark, try_id("s"), vals) == [1001, 1001, 1002, None, 1000, None, None, None]


def test_try_money_half_up_and_overflow(spark):
    vals = [("1.005",), ("-12.344",), ("x",), ("12345678901.00",)]
    out = _one(spark, try_money("s"), vals)
    assert [str(v) if v is not None else None for v in out] == ["1.01", "-12.34", None, None]


def test_dob_formats(spark):
    vals = [("1995-03-05",), ("05/03/1995",), ("31/02/1995",), ("1995-02-31",), ("5/3/1995",), (None,)]
    out = _one(spark, parse_dob("s"), vals)
    d = datetime.date(1995, 3, 5)
    assert out == [d, d, None, None, None, None]


def test_date_key(spark):
    out = _one(spark, date_key(F.col("d")), [(datetime.date(2024, 2, 29),)], "d date")
    assert out == [20240229]


def test_masks_for_public_and_exempt(spark):
    df = spark.createDataFrame(
        [("9876543210", "a.b@x.com", "Ann"), (None, None, None), ("12", "nodomain", "Bo")],
        "phone string, email string, name string",
    )
    pub = df.select(mask_phone(F.col("phone"), "PUBLIC"), mask_email(F.col("email"), "PUBLIC"),
                    mask_name(F.col("name"), "PUBLIC")).collect()
    assert [tuple(r) for r in pub] == [
        ("******3210", "****@x.com", "****"),
        (None, None, "****"),
        ("******12", "****", "****"),
    ]
    eng = df.select(mask_phone(F.col("phone"), "ACCOUNTADMIN"), mask_name(F.col("name"), "ACCOUNTADMIN")).collect()
    assert [tuple(r) for r in eng] == [("9876543210", "Ann"), (None, None), ("12", "Bo")]


def test_rate_pct_half_up_and_zero_guard(spark):
    df = spark.createDataFrame([(1, 8), (1, 400), (0, 0), (2, 3)], "k long, n long")
    out = [r[0] for r in df.select(rate_pct(F.col("k"), F.col("n"), 1)).collect()]
    assert [None if v is None else float(v) for v in out] == [12.5, 0.3, None, 66.7]


def test_age_group_bands_and_leap_day(spark):
    as_of = datetime.date(2026, 1, 1)
    dobs = [datetime.date(2008, 1, 2), datetime.date(2008, 1, 1), datetime.date(1990, 6, 1),
            datetime.date(1975, 1, 1), datetime.date(1960, 1, 1), datetime.date(1959, 12, 31),
            datetime.date(2000, 2, 29)]
    out = _one(spark, age_group(F.col("dob"), as_of), [(d,) for d in dobs], "dob date")
    assert out == ["0-17", "18-35", "18-35", "51-65", "66+", "66+", "18-35"]
