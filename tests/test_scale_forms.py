"""Forms at size: what is shuffled and added up, and results that the plans must keep."""

from martforge.operators import forms
from martforge.plans import closeouts as co
from martforge.sources.layout import SECTION_LABELS, Layout


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_matches_become_headers_after_the_section_is_known(spark):
    anchors = [0, 10, 20, 36, 42, 50, 56, 62, 68]
    cells = [("A", r, 0, t) for r, t in zip(anchors, SECTION_LABELS)]
    # In two salts, so the last match is found over both; the label belongs to several sections.
    cells += [("A", 22, 0, "Deaths"), ("A", 22, 3, "3"), ("A", 29, 0, "Deaths"), ("A", 29, 3, "7"), ("A", 12, 0, "no label")]
    frame = spark.createDataFrame(cells, "file_id string, row_no int, col_no int, value string")
    parts = co.CloseoutParts(frame, Layout.default(spark))
    got = {r.header_str: r.value for r in parts.values.collect()}
    assert got["deaths_out_number"] == 7 and got["deaths_out_receipts"] == 0
    # A form's matches reach it by number, not with four texts each.
    assert "hashpartitioning(file_id#" in physical(parts.last) and "hashpartitioning(file_id#" in physical(parts.pivot)
    assert "header_str" not in "".join(x for x in physical(parts.last).split("\n") if "hashpartitioning" in x)
    assert parts.wide().first().totals_summary_pigs_out_number == 7


def test_totals_are_added_up_once(spark):
    layout = Layout.default(spark)
    flows = forms.Flows(layout, "totals_summary_pigs")
    assert flows.totals and flows.measure(2, "out", "totals_summary_pigs", "number") == "`__total_out_number`"


def test_titles_are_scanned_and_shuffled_once(spark):
    """One pass over the titles finds what a chain of minima finds, also without a name or row."""
    labels = ["A", "B", "B", "C"]
    rows = [("f", 5, "A"), ("f", 3, "C"), ("f", 7, "B"), ("f", 9, "C"), ("f", 2, "B"), ("f", 4, "other"),
            ("g", 1, "A"), ("g", None, "B"), ("h", 1, "C"), (None, 1, "A"), (None, 2, "B"), ("i", 1, "other")]
    frame = spark.createDataFrame(rows, "file_id string, row_no int, value string")
    found = forms.title_anchors(frame, labels)
    plan = physical(found)
    assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan
    got = {r.file_id: (r.anchors, r.complete) for r in found.collect()}
    assert got == {"f": ([5, 7, 7, 9], True), "g": ([1, None, None, None], False), "h": ([None] * 4, False), None: ([1, None, None, None], False)}


def test_tasks_follow_the_rows(spark, monkeypatch):
    """A few compressed megabytes of records are many cells, so tasks are counted by rows."""
    monkeypatch.setattr(forms, "TASK_RECORDS", 10)
    anchors = [0, 10, 20, 36, 42, 50, 56, 62, 68]
    cells = [(f"F{k}", r, 0, t) for k in range(6) for r, t in zip(anchors, SECTION_LABELS)]
    parts = co.CloseoutParts(spark.createDataFrame(cells, "file_id string, row_no int, col_no int, value string"), Layout.default(spark))
    assert parts.parts == 6
    assert ", 6), REPARTITION_BY_NUM" in physical(parts.pivot)
