"""Work that several reports or facts of a query share is done once, and text is made where it is written."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from martforge import registry as R
from martforge.plans import sales as sl
from martforge.sources import definitions as df
from martforge.sources import exports as ex
from martforge.sources import reports as rp
from martforge.sources import testdata as td

DAY = dt.date(2020, 2, 3)


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_records_become_text_after_they_are_dealt_to_months(spark, small_dir):
    plan = optimized(ex.report_records(spark, small_dir, "carcass"))
    assert 0 < plan.index("concat_ws") < plan.index("explode") < plan.index("RepartitionByExpression")
    assert "Sort" not in plan


def test_a_month_is_one_file_that_begins_with_its_banner(spark, small_dir):
    root = ex.write_reports(spark, small_dir, ["movements", "carcass"])
    for d, raw in ((df.MOVEMENTS, td.movements_raw), (df.CARCASS, td.carcass)):
        lines = rp.read_report_lines(spark, ex.files_of(root, d))
        months = raw(spark, small_dir).select(F.date_format("movement_date" if d is df.MOVEMENTS else "kill_date", "yyyy-MM")).distinct().count()
        assert lines.select("file_path").distinct().count() == months
        heads = lines.filter(f"line_no = {d.banner_rows}").select("line").distinct().collect()
        assert len(heads) == 1 and heads[0].line.count(",") == d.width - 1
        assert lines.filter(f"line_no = 1 AND line = '{d.name} report, row 1'").count() == months
        assert lines.filter(f"line_no >= {d.first_record}").count() == raw(spark, small_dir).count()


def test_text_cells_are_quoted_and_figures_are_not_asked(spark):
    row = spark.createDataFrame([("a,b", Decimal("1.5"), None)], "plant string, tattoo decimal(4,1), kill_date string")
    d = df.ReportDef("x", "x", 0, ((0, "plant", "string"), (1, "tattoo", "decimal(4,1)"), (2, "kill_date", "string")), width=3)
    cells = {c: F.col(c).cast("string") for c in row.columns}
    assert row.select(ex.record_line(d, cells, {"tattoo"})).first()[0] == '"a,b",1.5,' == row.select(ex.record_line(d, cells)).first()[0]


def test_both_sheets_ask_the_same_of_their_joins(spark, small_dir):
    for sheet in (td.ingredient_qty, td.ingredient_cost):
        assert "array(l_quantity" in optimized(sheet(spark, small_dir)).replace("#", " ").replace("array(l_quantity ", "array(l_quantity")


def test_facts_of_the_orphans_and_the_actuals_read_lines_joined_once(spark, small_dir):
    for plan in (physical(E.queries()["fk_orphans"](spark, small_dir)), physical(R.q_budget_actuals(spark, small_dir))):
        assert "lineitem" not in plan and "/lines-" in plan


def test_loads_of_some_groups_are_told_from_all_loads(spark):
    figures = {k: F.lit("1").cast("decimal(10,2)") for k in (*sl.ROUNDING, "back_fat", "loin_depth", "lean", "yield")}
    carcass = spark.createDataFrame([(t, DAY, "P1", 3) for t in (1, 2, 3)], "tattoo int, kill_date date, plant string, quantity int").withColumns(figures)
    loads = spark.createDataFrame([("A", DAY, 1), ("B", DAY, 1), ("A", DAY, 2), ("B", DAY, 3), (None, DAY, 3)], "group_num string, kill_date date, tattoo int")
    groups = spark.createDataFrame([("A",), ("A",), (None,)], "group_num string")
    assert [(r.group_num, r.tattoo) for r in sl.sales(carcass, loads, groups=groups).collect()] == [("A", "0002")]
    assert [(r.group_num, r.tattoo) for r in sl.sales(carcass, loads).collect()] == [("A", "0002")]


def test_a_typed_cell_is_worked_out_once(spark):
    lines = spark.createDataFrame([("f", df.LOADS.first_record, ",".join([""] * 20 + ["G1"] + [""] * 7 + ["2024-05-01"] + [""] * 5 + ["P1", "", "", "x7"]))], "file_path string, line_no int, line string")
    taken = rp.load_report(lines, df.LOADS)
    assert [(r.field, r.text, r.reason) for r in rp.rejected(taken).collect()] == [("tattoo", "x7", "not int")]
    assert optimized(rp.accepted(taken)).count("as date") <= 2
