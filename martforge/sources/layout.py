"""Closeout form layout (S6) and the section labels of the form.

The layout says where every output column sits in a one-sheet closeout form:
fixed cells by absolute position (category 0), and labelled cells per section
(category 1..7): find ``search_str`` in column ``col_no`` of the section's
rows, take the cell in ``value_col`` of that row.  Rows without a
``search_str`` are computed columns (totals and ratios).

The reference reads this table from a CSV that it does not ship, so ours is
generated by rule from the declared closeout columns (``schemas``); a CSV with
the same fields can be read with ``read_layout``.
"""

from __future__ import annotations

from functools import cached_property
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import schemas as S
from martforge.sources.reports import csv_options, read_report_lines

# The section titles a closeout form carries in column 0, in
# order.  Section k's rows lie between title k and title k+1.
SECTION_LABELS = [
    "Group Detail Report", "Summary Pigs IN", "Summary Pigs OUT", "Adjustments", "Performance",
    "Feed Cost Summary", "P & L Summary", "Expenses", "Group Comments",
]

LAYOUT_SCHEMA = T.StructType([
    T.StructField("search_str", T.StringType()),
    T.StructField("adjust_str", T.StringType()),
    T.StructField("column_str", T.StringType()),
    T.StructField("header_str", T.StringType()),
    T.StructField("fixed", T.BooleanType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("round_digits", T.IntegerType()),
    T.StructField("category", T.IntegerType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("col_no", T.IntegerType()),
    T.StructField("value_col", T.IntegerType()),
])

# Layout rule parameters: where labels and values sit in each section.
FLOW_VALUE_COLS = {"number": 3, "total_wt": 5, "receipts": 8, "avg_age_in": 10}
ADJUSTMENT_VALUE_COLS = {"number": 3, "per": 4, "total_wt": 5, "avg_wt": 6}
PAIR_VALUE_COLS = {"w_dead": 3, "wo_dead": 5}
METRIC_LABEL_COL, METRIC_VALUE_COL = 6, 8
FEED_VALUE_COLS = {"cwt_net_wt_produced": 3, "ton_total_feed": 5, "qty": 8}
ENERGY_LABEL_COL, ENERGY_VALUE_COL = 10, 12
MONEY_VALUE_COL = 8


def label(stem: str) -> str:
    """Form label of a column stem: ``'gilt_arrival_to_iso' -> 'Gilt Arrival To Iso'``."""
    return stem.replace("_", " ").title()


def _digits(t: T.DataType) -> int:
    if isinstance(t, T.DecimalType):
        return 2 if t in (S.MONEY, S.SMALLMONEY) else t.scale
    return 0


def fixed_position(i: int) -> tuple[int, int]:
    """Rule placing the i-th fixed field: rows 1..8, columns 1, 4, 7."""
    return 1 + i % 8, 1 + 3 * (i // 8)


def fixed_data_type(name: str, t: T.DataType) -> str:
    if isinstance(t, T.DateType):
        return "date"
    if name in ("group_num", "producer", "business_unit"):
        return "split"
    return "str" if isinstance(t, T.StringType) else "num"


Row = tuple


def layout_rows() -> list[Row]:
    rows: list[Row] = []
    types = dict(S.closeout_columns())

    def add(search, stem, col_str, header, category, col_no=-1, value_col=-1, fixed=False,
            data_type="num", row_no=-1):
        rows.append((search, stem, col_str, header, fixed, data_type, _digits(types[header]),
                     category, row_no, col_no, value_col))

    for i, (name, t) in enumerate(S.CLOSEOUT_FIXED):
        r, c = fixed_position(i)
        add(None, None, None, name, 0, c, -1, True, fixed_data_type(name, t), r)
    for cat, direction in ((1, "in"), (2, "out")):
        for header, stem, measure, _ in S.flow_columns(direction):
            col_str = f"{direction}_{measure}"
            if measure in FLOW_VALUE_COLS:
                add(label(stem), stem, col_str, header, cat, 0, FLOW_VALUE_COLS[measure])
            else:
                add(None, stem, col_str, header, cat)
    for header, _ in S.ADJUSTMENT:
        measure = header[len("inventory_adjustment_"):]
        add(label("inventory_adjustment"), "inventory_adjustment", measure, header, 3, 0,
            ADJUSTMENT_VALUE_COLS[measure])
    for stem, _ in S.PERFORMANCE_PAIRS:
        for variant, vc in PAIR_VALUE_COLS.items():
            add(label(stem), stem, variant, S.pair_name(stem, variant), 4, 0, vc)
    for name, _ in S.SPACE_TIME:
        add(label(name), name, "value", name, 4, METRIC_LABEL_COL, METRIC_VALUE_COL)
    for measure, _ in S.FEED_MEASURES:
        for stem in S.FEED_STEMS:
            add(label(stem), stem, measure, f"{measure}_{stem}", 5, 0, FEED_VALUE_COLS[measure])
    for name, _ in S.ENERGY:
        add(label(name), name, "value", name, 5, ENERGY_LABEL_COL, ENERGY_VALUE_COL)
    for cat, names, suffix in ((6, S.PROFIT, "_profit"), (7, S.EXPENSES, "_expense")):
        for name in names:
            stem = name[: -len(suffix)] if name.endswith(suffix) else name
            add(label(stem), stem, "value", name, cat, 0, MONEY_VALUE_COL)
    return rows


class LayoutRow(NamedTuple):
    """A row of a layout; see ``LAYOUT_SCHEMA``."""

    search_str: str | None
    adjust_str: str | None
    column_str: str | None
    header_str: str
    fixed: bool
    data_type: str | None
    round_digits: int | None
    category: int
    row_no: int
    col_no: int
    value_col: int

    @property
    def labelled(self) -> bool:
        return self.search_str is not None and self.category > 0


def _names(r: LayoutRow) -> tuple:
    return r.header_str, r.category, r.adjust_str, r.column_str


class Layout:
    """A layout as the extraction uses it: its rows in order, and its labels as a table.

    Both come of one read.  A layout describes the columns of one target table, so it is
    small; one of more than ``MAX_ROWS`` rows is refused, and nothing of it is broadcast.
    """

    MAX_ROWS = 10_000

    def __init__(self, spark: SparkSession, rows):
        self.spark, self.rows = spark, tuple(LayoutRow(*r) for r in rows)
        if len(self.rows) > self.MAX_ROWS:
            raise ValueError(f"a layout of more than {self.MAX_ROWS} rows")

    @classmethod
    def of(cls, layout: "DataFrame | Layout") -> "Layout":
        """A layout from its table; ``order_no`` (see ``read_layout``) tells the order of
        the rows, else the order in which the table gives them."""
        if isinstance(layout, Layout):
            return layout
        ordered = layout.orderBy("order_no") if "order_no" in layout.columns else layout
        return cls(layout.sparkSession, ordered.select(*LAYOUT_SCHEMA.names).limit(cls.MAX_ROWS + 1).collect())

    @classmethod
    def default(cls, spark: SparkSession) -> "Layout":
        return cls(spark, layout_rows())

    @cached_property
    def label_columns(self) -> list[int]:
        return sorted({r.col_no for r in self.rows if r.labelled})

    @cached_property
    def columns(self) -> list[int]:
        """Every sheet column the layout reads: label, value and fixed-cell columns."""
        cols = {r.col_no for r in self.rows if r.fixed or r.labelled} | {r.value_col for r in self.rows if r.labelled}
        return sorted(c for c in cols if c >= 0)

    @cached_property
    def extracted(self) -> list[str]:
        """Headers of labelled cells, in the layout's order."""
        return list(dict.fromkeys(r.header_str for r in self.rows if r.labelled))

    @cached_property
    def labels(self) -> DataFrame:
        """The labelled rows, with their place (``order_no``), the place of their label
        column among those of their category (``col_rank``) and the number of their header
        (``slot``)."""
        ranks: dict[int, dict[int, int]] = {}
        out = []
        slot = {names: n for n, names in enumerate(self._named)}
        for n, r in enumerate(self.rows):
            if r.labelled:
                seen = ranks.setdefault(r.category, {})
                out.append((n, seen.setdefault(r.col_no, len(seen)), r.category, r.col_no, r.search_str, r.value_col, r.header_str, slot[_names(r)]))
        return self._local(out, {"order_no": pa.int32(), "col_rank": pa.int32(), "category": pa.int32(), "col_no": pa.int32(),
                                 "search_str": pa.string(), "value_col": pa.int32(), "header_str": pa.string(), "slot": pa.int32()})

    @cached_property
    def _named(self) -> list[tuple]:
        return list(dict.fromkeys(_names(r) for r in self.rows if r.labelled))

    @cached_property
    def slots(self) -> DataFrame:
        """The header, category and stems of every ``slot`` of ``labels``."""
        return self._local([(n, *names) for n, names in enumerate(self._named)],
                           {"slot": pa.int32(), "header_str": pa.string(), "category": pa.int32(), "adjust_str": pa.string(), "column_str": pa.string()})

    def _local(self, rows: list[tuple], types: dict[str, pa.DataType]) -> DataFrame:
        columns = list(zip(*rows)) or [()] * len(types)
        return self.spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types)))


def layout_df(spark: SparkSession) -> DataFrame:
    """The layout as a small DataFrame (a few hundred rows, fixed by the table)."""
    return spark.createDataFrame(layout_rows(), LAYOUT_SCHEMA)


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Layout CSV with a header row and declared types (S6), never inferred; ``order_no``
    is the line number, as the order of the rows settles ties."""
    lines = read_report_lines(spark, path).filter(F.col("line_no") > 0)
    fields = F.from_csv("line", LAYOUT_SCHEMA.simpleString(), csv_options(nullValue=""))
    return lines.select(F.col("line_no").alias("order_no"), fields.alias("r")).select("order_no", "r.*")


def headers() -> list[str]:
    return [r[3] for r in layout_rows()]
