"""Every registered query runs on the smallest tables, plans without Cartesian
products or Python UDFs, and the flagship entry works."""

import pytest

import __spark_entry__ as E

NAMES = sorted(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "movement_type" in df.columns


def test_every_query_of_the_library_has_an_oracle():
    """The optional corpus operators have SQL only where SQL can say them."""
    from martforge.oracle import oracle_sql
    from martforge.registry import queries

    assert set(queries()) == set(oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_runs_and_plans_cleanly(spark, small_dir, name):
    df = E.queries()[name](spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"
    df.write.format("noop").mode("overwrite").save()
