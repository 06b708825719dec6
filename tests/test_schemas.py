"""CORE tables carry the declared types; presentation converts only at the edge."""

import datetime

from carelake.functions.present import present
from carelake.schemas import CORE_SCHEMAS


def test_core_types_match_declared_schemas(wh_small):
    for d, schema in CORE_SCHEMAS.items():
        got = dict(wh_small.table(f"core_{d}").dtypes)
        want = {f.name: f.dataType.simpleString() for f in schema.fields}
        assert {k: got[k] for k in want} == want, d


def test_present_converts_dates_decimals_ints(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 2), 3)], "d date, i int").selectExpr(
        "d", "cast(12.5 as decimal(12,2)) as m", "i")
    out = present(df)
    assert dict(out.dtypes) == {"d": "string", "m": "double", "i": "bigint"}
    assert tuple(out.collect()[0]) == ("2024-01-02", 12.5, 3)
