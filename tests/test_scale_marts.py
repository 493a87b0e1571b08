"""Sales and the budget mart at size: what is shuffled, and results that the plans must keep."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from martforge import registry as R
from martforge.operators import stats
from martforge.plans import budgets as bd
from martforge.plans import closeouts as co
from martforge.plans import sales as sl
from martforge.sources.layout import SECTION_LABELS, Layout

DAY = dt.date(2020, 2, 3)
MONEY = "decimal(38,7)"


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def carcass(spark, *rows):
    """(tattoo, price) a row; the other figures are the same in all."""
    c = spark.createDataFrame([(t, DAY, Decimal(p)) for t, p in rows], f"tattoo int, kill_date date, value {MONEY}")
    same = {"plant": F.lit("P1"), "quantity": F.lit(3), "avg_live_wt": F.lit("250.25").cast("decimal(18,4)"),
            "avg_carcass_wt": F.lit("200.5").cast("decimal(18,4)"), "back_fat": F.lit("0.5").cast("decimal(4,2)"),
            "loin_depth": F.lit("2").cast("decimal(4,2)"), "lean": F.lit("0.5").cast("decimal(4,2)"), "yield": F.lit("0.7").cast("decimal(4,2)")}
    same |= {k: F.col("value") for k in ("base_price_cwt", "vob_cwt", "value_cwt", "base_price", "vob")}
    return c.withColumns(same)


def loads(spark, *tattoos):
    return spark.createDataFrame([(f"G{t}", DAY, t) for t in tattoos], "group_num string, kill_date date, tattoo int")


def test_carcass_rows_meet_their_load_as_they_are_stored(spark):
    df = sl.sales(carcass(spark, (5, "1.125"), (5, "1.135"), (12345, "2"), (-5, "3"), (7, "4")), loads(spark, 5, 12345, -5, None))
    got = sorted((r.group_num, r.tattoo, r.load_id, r.value, r.avg_carcass_wt, r.avg_live_wt, r.kill_week) for r in df.collect())
    assert [g[:4] for g in got] == [
        ("G-5", "00-5", "G-5-00-5", Decimal(3)), ("G12345", "12345", "G12345-12345", Decimal(2)),
        ("G5", "0005", "G5-0005", Decimal("1.12")), ("G5", "0005", "G5-0005", Decimal("1.14"))]
    assert {g[4:] for g in got} == {(200, Decimal("250.2"), "2020 06")}
    shuffles = [x for x in physical(df).split("\n") if "Exchange hashpartitioning" in x]
    assert shuffles and all("(tattoo#" in x and "L, kill_date#" in x for x in shuffles)


def test_a_figure_that_does_not_fit_matters_only_with_a_load(spark):
    rows = carcass(spark, (1, "2"), (2, "1" + "0" * 20))
    assert [r.group_num for r in sl.sales(rows, loads(spark, 1)).collect()] == ["G1"]
    assert sl.sales(rows, loads(spark, 2)).select("avg_carcass_wt").first()[0] == 200
    with pytest.raises(Exception, match="OUT_OF_RANGE|NUMERIC_VALUE"):
        sl.sales(rows, loads(spark, 1, 2)).select("value").collect()


def test_sales_and_load_stats_are_both_statistics(spark):
    rows = [("A", "A-1", 200, "70"), ("A", "A-1", 203, "71.5"), ("A", "A-2", 190, None), ("A", "A-2", None, "69.1234"),
            ("A", "A-3", 210, "70"), ("A", "A-3", 222, "70"), ("A", "A-3", 180, "70"), ("B", "B-1", 5, "1"), ("C", "C-1", None, None),
            (None, None, 7, "2"), (None, None, 9, "3"), ("D", "D-1", 4_000_000_000, "1"), ("D", "D-1", 4_000_000_003, "1")]
    df = spark.createDataFrame([(g, d, w, y and Decimal(y)) for g, d, w, y in rows],
                               "group_num string, load_id string, avg_carcass_wt long, yield_per decimal(18,4)").withColumn("lean_per", F.col("yield_per") - 1)
    both = {r.group_num: r.asDict() for r in stats.sales_and_load_stats(df).collect()}
    one = {r.group_num: r.asDict() for r in stats.sales_stats(df).collect()}
    two = {r.group_num: r.asDict() for r in stats.load_stddev_avg(df).collect()}
    assert both == {g: one[g] | two[g] for g in one}


def test_the_budget_mart_reads_the_sales_once(spark, small_dir):
    plan = E.queries()["budget_actuals"](spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode([0,1,2])") == 1
    assert "actuals-keys" in physical(E.queries()["budget_actuals"](spark, small_dir))


def test_cells_are_read_once(spark):
    anchors = [0, 10, 20, 36, 42, 50, 56, 62, 68]
    cells = [("A", r, 0, t) for r, t in zip(anchors, SECTION_LABELS)] + [("A", 22, 0, "Deaths"), ("A", 22, 3, "3"), ("B", 1, 3, "x")]
    frame = spark.createDataFrame(cells, "file_id string, row_no int, col_no int, value string")
    parts = co.CloseoutParts(frame, Layout.default(spark))
    assert "Scan ExistingRDD" not in physical(parts.anchors)
    wide = parts.wide()
    assert "form-records" in physical(wide)
    assert [(r.group_id, r.deaths_out_number) for r in wide.collect()] == [("A", 3)]


def test_both_runs_of_the_actuals_read_facts_written_once(spark, small_dir):
    stored, batch, _ = R.budget_loads(spark, small_dir)
    for frame in (stored, batch):
        plan = physical(frame)
        assert "lineitem" not in plan
        assert all(f"actuals-{name}" in plan for name in ("closeouts", "sales", "ingredients", "movements"))


def test_staged_sources_keep_every_row_of_their_groups(spark):
    names = {c for columns in bd.ACTUALS_READS.values() for c in columns} - {"group_num"}
    rows = spark.createDataFrame([("G1",), ("G1",), ("G2",), (None,)], "group_num string").withColumns(dict.fromkeys(sorted(names), F.lit("1")))
    keys = spark.createDataFrame([("G1",), ("G1",), (None,)], "group_num string")
    out = bd.staged_sources({name: rows for name in bd.ACTUALS_READS} | {"groups": keys}, keys, ["1", "2"])
    assert out["groups"] is keys
    for name, columns in bd.ACTUALS_READS.items():
        assert out[name].columns == columns
        assert [r.group_num for r in out[name].collect()] == ["G1", "G1"]
    other = bd.staged_sources({name: rows for name in bd.ACTUALS_READS}, keys, ["2"])
    assert other["ingredients"].isEmpty() and other["movements"].count() == 2
