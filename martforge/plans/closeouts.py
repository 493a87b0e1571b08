"""Closeout forms -> the 256-column closeout table (D8) and its parts.

See ``operators.forms`` for the plan shape.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge import schemas as S
from martforge.operators import forms
from martforge.session import write_staged
from martforge.sources.layout import SECTION_LABELS, Layout

CLOSEOUT_OUT = S.widen(S.CLOSEOUTS, drop=())
FIXED_HEADERS = [n for n, _ in S.CLOSEOUT_FIXED]
NUMERIC_HEADERS = [f.name for f in S.CLOSEOUTS.fields if f.name != "group_id" and f.name not in FIXED_HEADERS]


class CloseoutParts:
    """The intermediate tables of one extraction by one layout.

    The cells are read once, into row records in the shared folder; section titles,
    labelled and fixed cells are all found in those."""

    def __init__(self, cells: DataFrame, layout: DataFrame | Layout, *, clip_negative: bool | list[int] = True):
        self.layout = Layout.of(layout)
        self.records = write_staged(forms.form_rows(cells, [0, *self.layout.columns]), "form-records")
        self.parts = forms.tasks_for(self.records)
        self.anchors = forms.title_anchors(self.records.select("file_id", "row_no", F.col("c0").alias("value")), SECTION_LABELS)
        self.hits = forms.labelled_cells(self.records, self.anchors, self.layout, clip_negative=clip_negative, parts=self.parts)

    @cached_property
    def last(self) -> DataFrame:
        return forms.last_values(self.hits, self.layout, self.parts)

    @cached_property
    def values(self) -> DataFrame:
        return forms.extracted_values(self.last)

    @cached_property
    def rejects(self) -> DataFrame:
        return forms.cell_rejects(self.hits)

    @cached_property
    def pivot(self) -> DataFrame:
        return forms.pivoted(self.last, self.anchors.filter("complete").select("file_id"), self.layout)

    @cached_property
    def totals(self) -> DataFrame:
        return forms.flow_totals(self.pivot, self.layout, S.TOTAL_STEM)

    @cached_property
    def ratios(self) -> DataFrame:
        return forms.flow_ratios(self.pivot, self.layout, S.TOTAL_STEM)

    def wide_numeric(self) -> DataFrame:
        return forms.wide_numeric(self.pivot, self.layout, S.TOTAL_STEM)

    def wide(self) -> DataFrame:
        return forms.typed_wide(self.wide_numeric(), forms.fixed_wide(self.records, self.layout),
                                CLOSEOUT_OUT, FIXED_HEADERS)


def closeouts(cells: DataFrame, layout: DataFrame | Layout, **kw) -> DataFrame:
    return CloseoutParts(cells, layout, **kw).wide()


def form_sections(cells: DataFrame) -> DataFrame:
    """``(file_id, section, anchor_row)`` per form: the ordered title search."""
    a = forms.section_anchors(cells, SECTION_LABELS).filter("complete")
    return a.select("file_id", F.posexplode("anchors").alias("pos", "anchor_row")).select(
        "file_id", F.col("pos").cast("int").alias("section"), "anchor_row")
