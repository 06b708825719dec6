"""Representative queries against the independent DuckDB oracle (sf0.001).

The full set (87 keys) runs with ``python tools/compare_oracle.py``.
"""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
SAMPLE = ["core_billing", "exceptions_log", "merge_billing", "vw_patient_utilization", "vw_daily_opd_trend",
          "payer_mix", "mv_monthly_revenue", "page_high_value", "vip_patients_masked", "layer_pass_rate",
          "dim_date"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        return None if isinstance(x, float) and math.isnan(x) else x

    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _norm(df.columns, [tuple(r) for r in df.collect()]) == _norm(rel.columns, rel.fetchall())
