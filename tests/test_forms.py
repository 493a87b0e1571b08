from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge.operators import forms
from martforge.plans import closeouts as co
from martforge.sources.layout import LAYOUT_SCHEMA, SECTION_LABELS, Layout, layout_df, layout_rows, read_layout

ANCHORS = [0, 10, 20, 36, 42, 50, 56, 62, 68]


def form(file_id, extra, anchors=ANCHORS, labels=SECTION_LABELS):
    cells = [(file_id, r, 0, t) for r, t in zip(anchors, labels)]
    return cells + [(file_id, r, c, v) for r, c, v in extra]


def cells_df(spark, rows):
    return spark.createDataFrame(rows, "file_id string, row_no int, col_no int, value string")


def test_anchor_search_skips_early_titles_and_rejects_missing(spark):
    early = form("A", [(5, 0, "Expenses")])  # title of section 8 before its turn
    missing = form("B", [], anchors=ANCHORS[:-1], labels=SECTION_LABELS[:-1])
    df = cells_df(spark, early + missing)
    a = {r.file_id: r for r in forms.section_anchors(df, SECTION_LABELS).collect()}
    assert a["A"].anchors == ANCHORS and a["A"].complete
    assert not a["B"].complete
    assert [r.file_id for r in forms.rejected_forms(df, SECTION_LABELS).collect()] == ["B"]


def test_labelled_cells_last_wins_and_cleaning(spark):
    rows = form("A", [
        (12, 0, "Gilt Arrival To Iso"), (12, 3, "4"), (12, 8, "-100"),     # negative receipts -> 0
        (13, 0, "Purchase Wean Pigs"), (13, 3, "2"), (13, 5, ""),          # blank weight -> 0
        (15, 0, "Purchase Wean Pigs"), (15, 3, "6"), (15, 5, "-"),         # repeated label: last row wins
        (22, 0, "Deaths"), (22, 3, "3"), (22, 5, "90"),
    ])
    parts = co.CloseoutParts(cells_df(spark, rows), layout_df(spark))
    v = {r.header_str: r.value for r in parts.values.collect()}
    assert v["gilt_arrival_to_iso_in_receipts"] == 0
    assert v["purchase_wean_pigs_in_number"] == 6 and v["purchase_wean_pigs_in_total_wt"] == 0
    assert v["deaths_out_number"] == 3
    t = {r.header_str: r.value for r in parts.totals.collect()}
    assert t["totals_summary_pigs_in_number"] == 10
    shares = [r.value for r in parts.ratios.collect()
              if r.header_str.endswith("_in_per") and not r.header_str.startswith("totals")]
    assert sum(shares) == Decimal(1)
    wide = parts.wide().first()
    assert wide.group_id == "A" and wide.totals_summary_pigs_in_per == 1
    assert wide.deaths_out_avg_wt == Decimal("30.0") and wide.condemned_market_hog_out_number == 0


def test_layout_round_trip_through_csv(spark, tmp_path):
    path = str(tmp_path / "layout.csv")
    layout_df(spark).coalesce(1).write.option("header", "true").csv(path)
    back = read_layout(spark, path)
    assert back.count() == len(layout_rows()) == 255
    assert Layout.of(back).rows == Layout.default(spark).rows
    assert Layout.of(back).label_columns == [0, 6, 10]


def test_form_plan_is_broadcast_and_has_no_cartesian(spark):
    rows = form("A", [(12, 0, "Gilt Arrival To Iso"), (12, 3, "4")])
    plan = co.closeouts(cells_df(spark, rows), layout_df(spark))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_negative_cells_kept_in_chosen_sections(spark):  # Q8 per-section override
    rows = form("A", [(22, 0, "Deaths"), (22, 3, "-3"), (58, 0, "Total Income"), (58, 8, "-250")])
    parts = co.CloseoutParts(cells_df(spark, rows), layout_df(spark), clip_negative=[1, 2, 3, 4, 5, 7])
    v = {r.header_str: r.value for r in parts.values.collect()}
    assert v["deaths_out_number"] == 0 and v["total_income"] == -250


def test_refused_cells_are_listed_and_not_zero(spark):
    rows = form("A", [
        (12, 0, "Gilt Arrival To Iso"), (12, 3, "12 head"), (12, 5, "60"), (12, 8, "1000000000000"),
        (13, 0, "Purchase Wean Pigs"), (13, 3, "4"), (13, 5, "20"), (13, 8, "100"),
        (22, 0, "Deaths"), (22, 3, "2"), (22, 5, "-"),
    ])
    parts = co.CloseoutParts(cells_df(spark, rows), layout_df(spark))
    got = {(r.row_no, r.col_no, r.header_str, r.text, r.reason) for r in parts.rejects.collect()}
    assert got == {(12, 3, "gilt_arrival_to_iso_in_number", "12 head", "not a number"),
                   (12, 8, "gilt_arrival_to_iso_in_receipts", "1000000000000", "does not fit a cell")}
    v = {r.header_str: r.value for r in parts.values.collect()}
    assert v["gilt_arrival_to_iso_in_number"] is None and v["gilt_arrival_to_iso_in_total_wt"] == 60
    w = parts.wide().first()
    assert w.gilt_arrival_to_iso_in_number is None and w.gilt_arrival_to_iso_in_lb is None
    assert w.totals_summary_pigs_in_number is None and w.totals_summary_pigs_in_total_wt == 80
    assert w.purchase_wean_pigs_in_number == 4 and w.purchase_wean_pigs_in_per is None and w.purchase_wean_pigs_in_pig == 25
    assert w.deaths_out_total_wt == 0 and w.deaths_out_avg_wt == 0 and w.totals_summary_pigs_out_number == 2


def test_ties_are_settled_by_column_row_and_layout_order(spark):
    rows = [r for r in layout_rows() if r[3] != "deaths_out_number"]
    one = ("Deaths", "deaths", "out_number", "deaths_out_number", False, "num", 0, 2, -1, 6, 7)
    two = ("Dead", "deaths", "out_number", "deaths_out_number", False, "num", 0, 2, -1, 0, 3)
    cells = cells_df(spark, form("A", [(22, 6, "Deaths"), (22, 7, "5"), (24, 0, "Dead"), (24, 3, "8"), (25, 6, "Deaths"), (25, 7, "6")]))

    def found(*extra):
        parts = co.CloseoutParts(cells, spark.createDataFrame([*extra, *rows] if extra[0] is one else [*rows, *extra], LAYOUT_SCHEMA))
        return {r.header_str: r.value for r in parts.values.collect()}["deaths_out_number"]

    assert found(two) == 8
    assert found(one) == 6  # the later row
    assert found(one, two) == 8  # column 6 comes first in the layout, so column 0 is written last
    assert found(two, one) == 6  # column 0 comes first: other rows of the section use it


def test_a_layout_is_small_and_its_order_is_kept(spark):
    with pytest.raises(ValueError, match="10000"):
        Layout(spark, layout_rows() * 40)
    shuffled = spark.createDataFrame(layout_rows(), LAYOUT_SCHEMA).selectExpr("1000 - monotonically_increasing_id() % 1000 AS order_no", "*")
    assert Layout.of(shuffled).rows != Layout.of(layout_df(spark)).rows


def test_hot_form_is_combined_before_it_is_shuffled(spark):
    """A form with most cells: no per-form collection, no raw cells by form."""
    n = 4000
    hot = [("A", 70 + i, c, f"x{i}") for i in range(n) for c in (0, 3)]
    cells = cells_df(spark, form("A", [(22, 0, "Deaths"), (22, 3, "3"), *[r[1:] for r in hot]], anchors=[*ANCHORS[:-1], 70 + n])
                     + form("B", [(22, 0, "Deaths"), (22, 3, "4")]))
    parts = co.CloseoutParts(cells, layout_df(spark))
    plan = parts.wide()._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
    assert "hashpartitioning(file_id" in plan and "partial_max" in plan
    assert {r.group_id: r.deaths_out_number for r in parts.wide().collect()} == {"A": 3, "B": 4}
