"""Layout-driven extraction of one-sheet forms.

Input ``cells(file_id, row_no, col_no, value)``: the cells of every form, one
form per ``file_id``, and a ``Layout``.  Output: one wide row per form.

Physical plan: cells become row records by an aggregation on (form, row), so a form
with a third of all cells is combined map-side and spread by its rows.  The records are
what titles, labels and fixed cells are read from (``plans.closeouts`` writes them once,
to the shared folder).  Records are
without a label of the layout (a list whose size was checked when it was read) are left
out; the others, salted by row, meet the section bounds of their form, and only then
become a row a header.  The last match of a header is found in every salt first, so at
most that many rows a header go to the form.  Section titles go by in the order of their
rows.  Nothing is collected per form or on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions.mathx import BLANK_CELLS, serial_to_date
from martforge.functions.text import after_colon
from martforge.sources.layout import Layout

CELL_VALUE = "decimal(18,6)"
FLOW_CATEGORIES = (1, 2)
MEASURES = ("number", "total_wt", "receipts")
#: Parts that the matches of one form are dealt to.
SALTS = 8
SALT = "__salt"
#: Row records that a task is dealt: what it sorts and sums up then fits into its memory.
TASK_RECORDS = 400_000
#: What a refused cell is until the wide row has NULL for it; no cell has this value.
REFUSED = "-999999999999.999999"


def section_anchors(cells: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Row of each section title per form (W4): ``(file_id, anchors, complete)``.

    Anchor k is the first row at or after anchor k-1 whose column-0 text is
    title k, so a title that also appears earlier in the form is skipped.
    ``complete`` is false when a title is missing: such forms go to ``rejected_forms``.
    """
    titles = cells.filter(F.col("col_no") == 0).groupBy("file_id", "row_no").agg(F.max("value").alias("value"))
    return title_anchors(titles, labels)


def title_anchors(titles: DataFrame, labels: Sequence[str]) -> DataFrame:
    """``section_anchors`` from the column-0 text of each row: ``(file_id, row_no, value)``.

    One scan and one shuffle: the titles of a form go by in the order of their rows."""
    found = titles.filter(F.col("value").isin(*labels)).select("file_id", "row_no", "value")
    kinds = [f.dataType.simpleString() for f in found.schema.fields]
    sorted_titles = found.repartition("file_id").sortWithinPartitions("file_id", "row_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a form follow each other: its anchors so far are all that is held."""
        at, rows, begun = None, [], False
        for batch in batches:
            done = []
            for form, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or form != at:
                    if begun:
                        done.append((at, rows))
                    at, rows, begun = form, [], True
                # A form without a name has no other anchor than its first.
                while row is not None and len(rows) < (1 if form is None else len(labels)) and text == labels[len(rows)]:
                    rows.append(row)
            if done:
                yield forms_of(done, batch.schema)
            last = batch.schema
        if begun:
            yield forms_of([(at, rows)], last)

    def forms_of(done: list, schema: pa.Schema) -> pa.RecordBatch:
        anchors = [[*rows, *[None] * (len(labels) - len(rows))] for _, rows in done]
        return pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in done], schema.field(0).type), pa.array(anchors, pa.list_(schema.field(1).type)),
             pa.array([len(rows) == len(labels) for _, rows in done], pa.bool_())], ["file_id", "anchors", "complete"])

    return sorted_titles.mapInArrow(run, f"file_id {kinds[0]}, anchors array<{kinds[1]}>, complete boolean")


def rejected_forms(cells: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Forms whose section titles are missing or out of order (the reference raises)."""
    a = section_anchors(cells, labels)
    all_files = cells.select("file_id").distinct()
    return all_files.join(a.filter("complete"), "file_id", "left_anti")


def form_rows(cells: DataFrame, columns: Sequence[int]) -> DataFrame:
    """One record per (form, row) with the text of each needed column as ``c<n>``.

    ``columns`` are the sheet columns the layout reads: plan-time parameters, so the
    record is a plain aggregation with one conditional ``max`` per column.
    """
    cols = sorted(set(columns))
    return cells.filter(F.col("col_no").isin(*cols)).groupBy("file_id", "row_no").agg(
        *[F.max(F.when(F.col("col_no") == c, F.col("value"))).alias(f"c{c}") for c in cols]
    )


def tasks_for(records: DataFrame) -> int:
    """Tasks for the steps behind the staged ``records``.  Left to their compressed size,
    these steps get a few tasks of many forms, which sort and sum on disk."""
    return max(1, -(-records.count() // TASK_RECORDS))


def _cell_in(col: Column, columns: Sequence[int]) -> Column:
    """Text of the record column whose number is the value of ``col``."""
    out = None
    for c in columns:
        out = F.when(col == c, F.col(f"c{c}")) if out is None else out.when(col == c, F.col(f"c{c}"))
    return out


def checked_cell(text: Column, clip: Column) -> tuple[Column, Column]:
    """Value of a report cell, and why it has none.

    Blank and dash cells give 0, and negative ones where ``clip`` is true.  Text that is
    no number, and numbers that do not fit, have a reason; their value is ``REFUSED``.
    """
    v = F.trim(text)
    n = v.try_cast(CELL_VALUE)
    zero, refused = F.lit("0").cast(CELL_VALUE), F.lit(REFUSED).cast(CELL_VALUE)
    blank = v.isin(*BLANK_CELLS)
    fits = n.isNotNull() & (n != refused)
    reason = F.when(blank | fits, F.lit(None).cast("string")).when(
        v.try_cast("double").isNotNull(), F.lit("does not fit a cell")).otherwise(F.lit("not a number"))
    value = F.when(blank, zero).when(~F.coalesce(fits, F.lit(False)), refused).when(clip & (n < 0), zero).otherwise(n)
    return value, reason


def labelled_cells(rows: DataFrame, anchors: DataFrame, layout: Layout, *,
                   clip_negative: bool | Sequence[int] = True, parts: int = 1) -> DataFrame:
    """Every cell that the layout finds by a label (J8-J10, P12, F17), with its value or
    the reason why it has none.

    A row of section k (``anchor_k + 2 <= row < anchor_{k+1} - 2``) whose text in a label
    column equals a layout ``search_str`` of category k gives the cell in that layout
    row's ``value_col``.  ``clip_negative`` is the legacy rule that turns negative cells into
    0 (Q8): ``True`` for every section, ``False`` for none, or the sections where it applies.
    ``rank`` orders the matches of a header as they would be written: by label column (in
    the layout's order), row, and place in the layout.  The work is dealt to ``parts`` tasks.
    """
    columns = layout.columns
    labels = {c: sorted({r.search_str for r in layout.rows if r.labelled and r.col_no == c}) for c in layout.label_columns}
    some = F.lit(False)
    for c, listed in labels.items():
        some = some | F.coalesce(F.col(f"c{c}").isin(listed), F.lit(False))
    bounds = anchors.filter("complete").select(
        F.col("file_id").alias("__file"), "anchors", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__part")
    ).repartition(parts, "__file", "__part")
    salted = rows.filter(some).withColumn(SALT, F.pmod(F.col("row_no"), F.lit(SALTS))).repartition(parts, "file_id", SALT)
    # The bounds of a task are a few of each form's, so records meet them unsorted.
    met = salted.join(bounds.hint("shuffle_hash"), (F.col("file_id") == F.col("__file")) & (F.col(SALT) == F.col("__part")))
    texts = F.explode(F.array(*[F.struct(F.lit(int(c)).alias("label_col"), F.col(f"c{c}").alias("label")) for c in layout.label_columns]))
    cand = met.select("*", texts.alias("l")).select("*", "l.label_col", "l.label").filter(F.col("label") != "")
    found = cand.join(F.broadcast(layout.labels), (F.col("label_col") == F.col("col_no")) & (F.col("label") == F.col("search_str")))
    low = F.try_element_at("anchors", (F.col("category") + 1).cast("int")) + 2
    high = F.try_element_at("anchors", (F.col("category") + 2).cast("int")) - 2
    found = found.filter((F.col("row_no") >= low) & (F.col("row_no") < high))
    raw = F.coalesce(_cell_in(F.col("value_col"), columns), F.lit(""))
    clip = F.lit(clip_negative) if isinstance(clip_negative, bool) else F.col("category").isin(*clip_negative)
    value, reason = checked_cell(raw, clip)
    return found.select(
        "file_id", SALT, "row_no", "value_col", "header_str", "slot", raw.alias("text"),
        value.alias("value"), reason.alias("reason"),
        # 2**14 layout rows at most, 2**31 sheet rows, 2**14 label columns.
        (F.shiftleft(F.col("col_rank").cast("long"), 45) + F.shiftleft(F.col("row_no").cast("long"), 14) + F.col("order_no")).alias("rank"),
    )


def salted_values(hits: DataFrame, parts: int) -> DataFrame:
    """The last match of each header (``slot``) in every salt, dealt by form."""
    salted = hits.groupBy("file_id", SALT, "slot").agg(F.max_by("value", "rank").alias("value"), F.max("rank").alias("rank"))
    return salted.repartition(parts, "file_id")


def last_values(hits: DataFrame, layout: Layout, parts: int = 1) -> DataFrame:
    """Long ``(file_id, header_str, category, adjust_str, column_str, value)``: the last
    match of each header wins (W5).  A refused cell has ``REFUSED``.

    The matches lie by form and salt already; what is left of each salt is dealt by form,
    where the pivot needs it too.  A header goes by its number in the layout, and gets its
    names back after that."""
    last = salted_values(hits, parts).groupBy("file_id", "slot").agg(F.max_by("value", "rank").alias("value"))
    return last.join(F.broadcast(layout.slots), "slot").select("file_id", "header_str", "category", "adjust_str", "column_str", "value")


def extracted_values(values: DataFrame) -> DataFrame:
    """``last_values`` with NULL for refused cells."""
    return values.withColumn("value", F.nullif("value", F.lit(REFUSED).cast(CELL_VALUE)))


def cell_rejects(hits: DataFrame) -> DataFrame:
    """Cells that have no value (K3): ``(file_id, row_no, col_no, header_str, text, reason)``."""
    return hits.filter(F.col("reason").isNotNull()).select(
        "file_id", "row_no", F.col("value_col").alias("col_no"), "header_str", "text", "reason")


def fixed_wide(rows: DataFrame, layout: Layout) -> DataFrame:
    """One row per form with every fixed cell (category 0), as text.

    ``date`` cells hold a spreadsheet serial day (F11), ``split`` cells hold
    ``'Label: value'`` (F18); other cells are taken as they are; empty cells
    give NULL.  Positions are plan-time layout parameters, so this is one
    aggregation per form over the row records (no join, no pivot).
    """
    aggs = []
    for r in layout.rows:
        if not r.fixed:
            continue
        v = F.col(f"c{r.col_no}")
        text = (F.when(v.isNull() | (v == ""), F.lit(None).cast("string"))
                .when(F.lit(r.data_type == "date"), serial_to_date(v).cast("string"))
                .when(F.lit(r.data_type == "split"), after_colon(v))
                .otherwise(v))
        aggs.append(F.max(F.when(F.col("row_no") == r.row_no, text)).alias(r.header_str))
    if not aggs:
        return rows.select("file_id").distinct()
    at = {r.row_no for r in layout.rows if r.fixed}
    return rows.filter(F.col("row_no").isin(*at)).groupBy("file_id").agg(*aggs)


# ---------------------------------------------------------------------------
# One pivot; totals and ratios are expressions over its columns, for the wide row
# and for the long results alike.
# ---------------------------------------------------------------------------
def pivoted(values: DataFrame, files: DataFrame, layout: Layout) -> DataFrame:
    """One row per complete form with the extracted value of every header (R4); NULL
    where the form has none.  The header list is the layout's, so no job looks for it."""
    w = values.groupBy("file_id").pivot("header_str", layout.extracted).agg(F.first("value"))
    return files.join(w, "file_id", "left")


def with_totals(pivot: DataFrame, flows: "Flows") -> DataFrame:
    """The pivot with the totals of the flow sections, each added up once for all the
    expressions that read it."""
    return pivot.selectExpr("*", *[f"{e} AS `{name}`" for name, e in flows.totals.items()])


class Flows:
    """SQL of the totals and ratios of the flow sections (A6, A7), from the layout's rows."""

    ZERO = f"CAST(0 AS {CELL_VALUE})"

    def __init__(self, layout: Layout, total_stem: str):
        self.layout, self.total = layout, total_stem
        self.header = {(r.category, r.adjust_str, r.column_str): r.header_str for r in layout.rows if not r.fixed}
        self.has = set(layout.extracted)
        #: Sums over all stems but the totals row, by the name of their column (``with_totals``).
        self.totals = {
            f"__total_{d}_{m}": " + ".join([self.ZERO, *[self.measure(c, d, s, m) for s in self.stems(c, d) if s != total_stem]])
            for c, d in self.directions() for m in MEASURES
        }

    def cell(self, header: str | None) -> str:
        """An extracted value: 0 where the form has none, NULL where it was refused."""
        if header not in self.has:
            return self.ZERO
        return f"nullif(coalesce(`{header}`, {self.ZERO}), CAST('{REFUSED}' AS {CELL_VALUE}))"

    def stems(self, category: int, d: str) -> list[str]:
        """Stems of a flow section, each once even if the layout finds its header twice."""
        return list(dict.fromkeys(r.adjust_str for r in self.layout.rows if r.category == category and r.column_str == f"{d}_number"))

    def measure(self, category: int, d: str, stem: str, m: str) -> str:
        """A measure of a stem; of the totals row the sum over all others (a total read
        from the form is ignored, as in the reference)."""
        if stem != self.total:
            return self.cell(self.header.get((category, stem, f"{d}_{m}")))
        return f"`__total_{d}_{m}`"

    def present(self, category: int, d: str, stem: str, measures: Sequence[str] = MEASURES) -> str:
        """Whether the form has any cell of a stem (of the totals row: of any other)."""
        stems = [stem] if stem != self.total else [s for s in self.stems(category, d) if s != self.total]
        heads = [h for s in stems for m in measures if (h := self.header.get((category, s, f"{d}_{m}"))) in self.has]
        return "(" + " OR ".join([f"`{h}` IS NOT NULL" for h in heads] or ["false"]) + ")"

    def ratio(self, category: int, d: str, stem: str, kind: str, digits: int) -> str:
        """Share, unit value, price per lb or average weight, from unrounded inputs (Q18);
        NULL for a zero denominator."""
        top, below = {
            "per": (("number", stem), ("number", self.total)), "pig": (("receipts", stem), ("number", stem)),
            "lb": (("receipts", stem), ("total_wt", stem)), "avg_wt": (("total_wt", stem), ("number", stem)),
        }[kind]
        num, den = (self.measure(category, d, s, m) for m, s in (top, below))
        r = f"try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE))"
        if digits > 0:
            r = f"rint({r} * {float(10 ** digits)}D) / {float(10 ** digits)}D"
        return f"CAST({r} AS {CELL_VALUE})"

    def directions(self):
        return zip(FLOW_CATEGORIES, ("in", "out"))


def wide_numeric(pivot: DataFrame, layout: Layout, total_stem: str) -> DataFrame:
    """One row per form with every numeric header.

    Every header is rounded once at its layout digits; missing values and ratios over
    zero are 0, and what depends on a refused cell is NULL.  The generated column
    expressions are passed as SQL text in one ``selectExpr`` call.
    """
    flows = Flows(layout, total_stem)
    digits = {r.header_str: r.round_digits or 0 for r in layout.rows}

    def rounded(e: str, h: str) -> str:
        d = digits.get(h, 0)
        return f"CAST({f'bround({e}, {d})' if d > 0 else e} AS {CELL_VALUE})"

    out = {h: rounded(flows.cell(h), h) for h in layout.extracted}
    for cat, d in flows.directions():
        for stem in flows.stems(cat, d):
            if stem == total_stem:
                for m in MEASURES:
                    h = flows.header.get((cat, stem, f"{d}_{m}"))
                    out[h] = rounded(flows.measure(cat, d, stem, m), h)
            for kind, (m, s) in {"per": ("number", total_stem), "pig": ("number", stem), "lb": ("total_wt", stem),
                                 "avg_wt": ("number", stem)}.items():
                h = flows.header.get((cat, stem, f"{d}_{kind}"))
                if h is not None:
                    den = flows.measure(cat, d, s, m)
                    out[h] = f"if({den} = 0, {Flows.ZERO}, {flows.ratio(cat, d, stem, kind, digits.get(h, 0))})"
    numeric = dict.fromkeys(r.header_str for r in layout.rows if not r.fixed)
    return with_totals(pivot, flows).selectExpr("file_id", *[f"{out.get(h, Flows.ZERO)} AS `{h}`" for h in numeric])


def _unpivoted(pivot: DataFrame, rows: Sequence[tuple[str, str, str]], name: str) -> DataFrame:
    """Long ``(file_id, header_str, <name>)`` of (header, value, condition) rows."""
    if not rows:
        return pivot.selectExpr("file_id", "'' AS header_str", f"{Flows.ZERO} AS {name}").limit(0)
    listed = ", ".join(f"named_struct('header_str', '{h}', '{name}', {v}, 'there', {cond})" for h, v, cond in rows)
    return pivot.selectExpr("file_id", f"inline(array({listed}))").filter("there").drop("there")


def flow_totals(pivot: DataFrame, layout: Layout, total_stem: str) -> DataFrame:
    """Totals row per form and flow section (A6): the sum over every other category of
    number, total weight and receipts, for measures the form has."""
    f = Flows(layout, total_stem)
    rows = [(f.header[cat, total_stem, f"{d}_{m}"], f.measure(cat, d, total_stem, m), f.present(cat, d, total_stem, [m]))
            for cat, d in f.directions() for m in MEASURES if (cat, total_stem, f"{d}_{m}") in f.header]
    return _unpivoted(with_totals(pivot, f), rows, "value")


def flow_ratios(pivot: DataFrame, layout: Layout, total_stem: str) -> DataFrame:
    """Share, unit value, price per lb and average weight per category a form has,
    including the totals row (A7), rounded half-even at their header's digits; NULL
    over a zero or refused denominator (Q9)."""
    f = Flows(layout, total_stem)
    digits = {r.header_str: r.round_digits or 0 for r in layout.rows}
    rows = []
    for cat, d in f.directions():
        for stem in f.stems(cat, d):
            for kind in ("per", "pig", "lb", "avg_wt"):
                h = f.header.get((cat, stem, f"{d}_{kind}"))
                if h is not None:
                    rows.append((h, f.ratio(cat, d, stem, kind, digits[h]), f.present(cat, d, stem, (*MEASURES, "avg_age_in"))))
    return _unpivoted(with_totals(pivot, f), rows, "value")


def typed_wide(num: DataFrame, fx: DataFrame, schema: T.StructType, fixed_headers: Sequence[str],
               key: str = "group_id") -> DataFrame:
    """Join the numeric and fixed halves of each form and cast to the target types;
    a column that the layout does not have is NULL."""
    w = num.join(fx, "file_id", "left")
    have = set(w.columns)
    exprs = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        if f.name == key:
            exprs.append(f"CAST(file_id AS {t}) AS `{key}`")
        elif f.name not in have:
            exprs.append(f"CAST(NULL AS {t}) AS `{f.name}`")
        elif f.name in fixed_headers:
            exprs.append(f"try_cast(`{f.name}` AS {t}) AS `{f.name}`")
        elif isinstance(f.dataType, T.LongType):
            exprs.append(f"CAST(bround(`{f.name}`, 0) AS {t}) AS `{f.name}`")
        else:
            exprs.append(f"CAST(`{f.name}` AS {t}) AS `{f.name}`")
    return w.selectExpr(*exprs)
