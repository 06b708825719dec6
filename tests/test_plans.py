"""Plan properties of every registered query (sf0.001 lineage)."""

import pytest

import __spark_entry__ as E
from carelake.plans.catalog import catalog

BAD_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in E.queries().items():
        if name not in catalog():
            continue  # the training-data operators have tests of their own
        df = fn(spark, "/root/testdata/sf0.001")
        out[name] = df._jdf.queryExecution().executedPlan().toString()
    return out


def test_every_query_has_an_oracle():
    assert set(catalog()) <= set(E.queries()) and set(catalog()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_no_python_udf_no_cartesian(plans):
    for name, plan in plans.items():
        for node in BAD_NODES:
            assert node not in plan, f"{name}: {node}"


def test_scan_is_pruned(plans):
    plan = plans["dt_payment_revenue"]
    scan = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line][0]
    assert "l_quantity" not in scan  # only the columns the lineage needs are read


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["patient_key", "patient_id", "full_name"]


def test_exceptions_run_each_rule_once(wh_small):
    """No filter on the reason list is inferred and pushed below the rules: they stand in the plan once per domain."""
    from carelake.operators import clean as C

    for d in ("patients", "appointments", "billing"):
        plan = C.exceptions(d, wh_small.resolve(f"prepared_{d}"), 1)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(f"THEN {C.RULES[d]()[0].reason} END") == 1, d
