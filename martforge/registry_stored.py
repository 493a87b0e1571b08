"""Registered queries over what the library writes: stored facts and report exports.

Tables and exports go to the cluster's shared folder, each call to a new place; all of
them are written from the whole input tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge import params as P
from martforge import registry as R
from martforge.operators import quality as qa
from martforge.operators import report_slices as rs
from martforge.plans import budgets as bd
from martforge.plans import closeouts as co
from martforge.plans import ingredients as ing
from martforge.plans import movements as mv
from martforge.plans import run as rn
from martforge.plans import sales as sl
from martforge.schemas import BUDGETS, GROUPS, VARCHAR_LEN
from martforge.session import ensure_checkpoint_dir
from martforge.sinks.tables import Slice
from martforge.sources import catalog as cat
from martforge.sources import definitions as df
from martforge.sources import exports as ex
from martforge.sources import reports as rp
from martforge.sources import testdata as td
from martforge.sources.layout import LAYOUT_SCHEMA, Layout, layout_rows, read_layout


def new_place(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# --- slice-sized commits (U2-U7, K2) ---------------------------------------------

def committed(spark: SparkSession, name: str, stored: DataFrame, batch: DataFrame, part: Slice) -> DataFrame:
    """The stored fact after the slice was replaced by the batch's rows of it."""
    t = rn.stores(spark, new_place(spark, "tables"))[name]
    t.append(stored)
    t.replace_slice(batch.filter(t.holds(part)), part)
    return t.read()


def q_commit_ingredients(spark: SparkSession, d: str) -> DataFrame:
    old, new = R.old_load(), R.report_window("ingredients")
    return committed(spark, "ingredients", ing.ingredients(td.ingredient_qty(spark, d, old), td.ingredient_cost(spark, d, old)),
                     ing.ingredients(td.ingredient_qty(spark, d, new), td.ingredient_cost(spark, d, new)),
                     Slice(R.start_of("ingredients")))


def _movements(spark: SparkSession, d: str, where) -> DataFrame:
    return mv.movements(td.movements_raw(spark, d, where), rename=P.ENTITY_RENAME)


def q_commit_movements(spark: SparkSession, d: str) -> DataFrame:
    return committed(spark, "movements", _movements(spark, d, R.old_load()), _movements(spark, d, R.report_window("movements")),
                     Slice(R.start_of("movements"), "movements"))


def q_commit_deaths(spark: SparkSession, d: str) -> DataFrame:
    stored = _movements(spark, d, R.old_load()).unionByName(mv.deaths(td.deaths_raw(spark, d, R.old_load())))
    return committed(spark, "movements", stored, mv.deaths(td.deaths_raw(spark, d, R.report_window("deaths"))),
                     Slice(R.start_of("deaths"), "deaths"))


def q_commit_sales(spark: SparkSession, d: str) -> DataFrame:
    old, new = R.old_load(), R.report_window("sales")
    return committed(spark, "sales", sl.sales(td.carcass(spark, d, old), td.loads(spark, d, old)),
                     sl.sales(td.carcass(spark, d, new), td.loads(spark, d, new)), Slice(R.start_of("sales")))


def q_commit_budgets(spark: SparkSession, d: str) -> DataFrame:
    stored, batch, start = R.budget_loads(spark, d)
    return committed(spark, "budgets", stored, batch, Slice(start, "actual"))


def q_commit_closeouts(spark: SparkSession, d: str) -> DataFrame:
    stored, batch, start = R.closeout_loads(spark, d)
    return committed(spark, "closeouts", stored, batch, Slice(start))


# --- the gate of a keyed load (K7, U8) ---------------------------------------------

def budget_sheet_twice(spark: SparkSession, d: str) -> DataFrame:
    """The budget sheet, loaded with a second one that repeats some of its rows, changes
    others and has rows without an id."""
    sheet = bd.budget_init(td.budgets(spark, d))
    n = F.substring("group_num", 2, 18).cast("long")
    second = (sheet.filter((n % 3 == 0) | (n % 11 == 1))
              .withColumn("rent_cost_week", F.when(n % 6 == 0, F.col("rent_cost_week") + 1).otherwise(F.col("rent_cost_week")))
              .withColumn("budget_id", F.when(n % 11 != 1, F.col("budget_id"))))
    return sheet.unionByName(second)


def q_budget_gate(spark: SparkSession, d: str) -> DataFrame:
    """What a load of the doubled sheet accepts and refuses when some rows are stored,
    and some of those with another rate."""
    sheet = bd.budget_init(td.budgets(spark, d))
    n = F.substring("group_num", 2, 18).cast("long")
    stored = sheet.filter(n % 5 == 0).withColumn(
        "feed_grinding_rate", F.when(n % 10 == 0, F.col("feed_grinding_rate") + 1).otherwise(F.col("feed_grinding_rate")))
    out = qa.gate(budget_sheet_twice(spark, d), BUDGETS, "budget_id", max_len=VARCHAR_LEN["budgets"], stored=stored)
    return out.select("budget_id", "group_num", F.col("rent_cost_week").cast("decimal(18,4)").alias("rent_cost_week"), "n_rows", "reason", "accepted")


def q_mart_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Groups whose inputs to the actuals mart differ between rows (J4): the mart takes one
    row a group, and these are the groups where that is a choice."""
    rates = budget_sheet_twice(spark, d).select("group_num", *bd.RATE_COLS)
    return qa.conflicts(rates)


# --- reports from text (S1, S3, K3) -------------------------------------------------

def loaded(spark: SparkSession, d: str, names: list[str]) -> dict[str, DataFrame]:
    """Typed records of the exports of ``names``, read back from their files."""
    root = ex.write_reports(spark, d, names)
    return {n: rp.load_report(rp.read_report_lines(spark, ex.files_of(root, df.DEFINITIONS[n])), df.DEFINITIONS[n]) for n in names}


def q_text_groups(spark: SparkSession, d: str) -> DataFrame:
    return rp.accepted(loaded(spark, d, ["groups"])["groups"]).select(*GROUPS.names)


def q_text_movements(spark: SparkSession, d: str) -> DataFrame:
    return mv.movements(rp.accepted(loaded(spark, d, ["movements"])["movements"]), rename=P.ENTITY_RENAME)


def q_text_sales(spark: SparkSession, d: str) -> DataFrame:
    got = loaded(spark, d, ["carcass", "loads"])
    return sl.sales(rp.accepted(got["carcass"]), rp.accepted(got["loads"]))


def q_text_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Cells and records of the exports that no load takes, counted by what is wrong."""
    out = None
    for name, records in loaded(spark, d, ["groups", "movements", "carcass", "loads"]).items():
        part = rp.rejected(records).select(F.lit(name).alias("report"), "field", F.when(F.col("field").isNotNull(), F.col("text")).alias("text"), "reason")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("report", "field", "text", "reason").agg(F.count(F.lit(1)).alias("n_cells"))


def q_report_lines(spark: SparkSession, d: str) -> DataFrame:
    """Line numbers of the movement exports, by file: lines, first and last record."""
    root = ex.write_reports(spark, d, ["movements"])
    lines = rp.read_report_lines(spark, ex.files_of(root, df.MOVEMENTS))
    month = F.regexp_extract("file_path", "file=movements_([^/]+)/", 1)
    records = F.col("line_no") >= df.MOVEMENTS.first_record
    return lines.groupBy(month.alias("month")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.min(F.when(records, F.col("line_no"))).alias("first_record"),
        F.max("line_no").alias("last_line"), F.count(F.when(records, 1)).alias("n_records"))


# --- forms: refused cells, a given layout (F17, K3, S6, W5) --------------------------

def damaged_cells(spark: SparkSession, d: str) -> DataFrame:
    """The closeout forms with some figures written as text and some too large."""
    c = td.cells(spark, d)
    at, v = F.col("col_no"), F.col("value")
    text = (at == 3) & F.col("row_no").between(12, 16) & (v == "2")
    large = (at == 8) & F.col("row_no").between(22, 28) & v.endswith("7")
    return c.withColumn("value", F.when(text, F.lit("2 head")).when(large, F.concat(F.lit("100000000000000"), v)).otherwise(v))


def q_form_cell_rejects(spark: SparkSession, d: str) -> DataFrame:
    return co.CloseoutParts(damaged_cells(spark, d), Layout.default(spark)).rejects


def q_form_extract_damaged(spark: SparkSession, d: str) -> DataFrame:
    """Extracted values of the damaged forms: a refused cell is NULL, not 0."""
    return co.CloseoutParts(damaged_cells(spark, d), Layout.default(spark)).values.select("file_id", "header_str", "value")


def other_layout() -> list[tuple]:
    """A second layout: rows in reverse order, receipts and weights of outgoing animals
    swapped, unit values of incoming animals to four digits, and a header written twice."""
    rows = []
    for r in reversed(layout_rows()):
        search, stem, column, header, fixed, kind, digits, category, row, col, value_col = r
        if category == 2 and column in ("out_receipts", "out_total_wt"):
            value_col = {8: 5, 5: 8}.get(value_col, value_col)
        rows.append((search, stem, column, header, fixed, kind, 4 if column == "in_pig" else digits, category, row, col, value_col))
    rows.append(("Standard Market Sale", "standard_market_sale", "out_number", "standard_market_sale_out_number", False, "num", 0, 2, -1, 0, 5))
    return rows


def q_form_pivot_given_layout(spark: SparkSession, d: str) -> DataFrame:
    """The numeric columns by the second layout, read from its CSV file."""
    place = new_place(spark, "layout")
    spark.createDataFrame(other_layout(), LAYOUT_SCHEMA).coalesce(1).write.option("header", "true").csv(place)
    return co.CloseoutParts(td.cells(spark, d), read_layout(spark, place)).wide_numeric()


# --- catalogs, codes and requests (S9, S10, G4, G6) -----------------------------------

def q_catalog_walk(spark: SparkSession, d: str) -> DataFrame:
    """Trees of one to six levels, flattened whole."""
    nodes = cat.walk_catalog(td.deep_catalog_docs(spark, d))
    return nodes.select("depth", F.array_join("path", "/").alias("path"), "value")


def q_decoded_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests by name, by code, and by neither."""
    return rs.decoded(td.requests(spark, d), cat.code_dictionary(td.code_docs(spark, d)))


def q_slice_movements_applied(spark: SparkSession, d: str) -> DataFrame:
    """The movement report by applied date and producer code."""
    raw = td.movements_raw_applied(spark, d)
    picked = rs.date_window(raw, P.SLICE_START, P.SLICE_END, date_col=rs.DATE_TYPES["applied_date"])
    facts = mv.movements(picked.drop("applied_date"), rename=P.ENTITY_RENAME)
    return rs.report_slice_by(facts, "producer", [P.SLICE_PRODUCER_CODE], groups=td.groups(spark, d),
                              codes=cat.code_dictionary(td.code_docs(spark, d)))


def q_slice_feed_usage_by(spark: SparkSession, d: str) -> DataFrame:
    """Feed usage between two dates, of sites and mills."""
    f = rs.date_window(R.q_ingredients(spark, d), P.SLICE_START, P.SLICE_END, date_col="delivery_date")
    f = rs.report_slice_by(f, "site", [P.SLICE_SITE], groups=td.groups(spark, d))
    return rs.report_slice_by(f, "feed_mill", list(P.SLICE_MILLS), groups=td.groups(spark, d))


# --- the run (D11) ------------------------------------------------------------------

RUN_STEPS = ("groups", "ingredients", "movements", "deaths", "sales", "budget_init")


def q_run_report(spark: SparkSession, d: str) -> DataFrame:
    """The books of two consecutive runs: a first load of an older download, then a
    newer one, whose budget sheet repeats and changes rows."""
    place = new_place(spark, "warehouse")
    config = rn.RunConfig(P.LOOKBACK_DAYS, P.ENTITY_RENAME, P.EXCLUDED_PRODUCER, P.ACTUALS_GROUP_TYPES, P.HOME_MILL,
                          P.CANDIDATE_EXCLUDE_TOKEN)

    joined = td.staged_lines(spark, d)

    def download(groups: DataFrame, where, budgets: DataFrame) -> rn.Reports:
        return rn.Reports(groups=groups, ingredient_qty=td.ingredient_qty(spark, d, where, joined),
                          ingredient_cost=td.ingredient_cost(spark, d, where, joined), movements=td.movements_raw(spark, d, where, joined),
                          deaths=td.deaths_raw(spark, d, where, joined), carcass=td.carcass(spark, d, where, joined),
                          loads=td.loads(spark, d, where, joined), cells=None, layout=None, budgets=budgets)

    old = download(td.groups_target(spark, d), R.old_load(), td.budgets(spark, d))
    new = download(td.groups(spark, d), R.report_window("sales"), budget_sheet_twice(spark, d))
    first = rn.run(spark, old, place, as_of=P.AS_OF, config=config, first_load=True, steps=RUN_STEPS)
    second = rn.run(spark, new, place, as_of=P.AS_OF, config=config, steps=RUN_STEPS)
    numbered = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return numbered.select("run", "step", "rows_in", "accepted", "rejected", "replaced")


def queries() -> dict[str, R.Query]:
    return {
        "run_report": q_run_report,
        "form_cell_rejects": q_form_cell_rejects,
        "form_extract_damaged": q_form_extract_damaged,
        "form_pivot_given_layout": q_form_pivot_given_layout,
        "catalog_walk": q_catalog_walk,
        "decoded_requests": q_decoded_requests,
        "slice_movements_applied": q_slice_movements_applied,
        "slice_feed_usage_by": q_slice_feed_usage_by,
        "commit_ingredients": q_commit_ingredients,
        "commit_movements": q_commit_movements,
        "commit_deaths": q_commit_deaths,
        "commit_sales": q_commit_sales,
        "commit_budgets": q_commit_budgets,
        "commit_closeouts": q_commit_closeouts,
        "budget_gate": q_budget_gate,
        "mart_conflicts": q_mart_conflicts,
        "text_groups": q_text_groups,
        "text_movements": q_text_movements,
        "text_sales": q_text_sales,
        "text_rejects": q_text_rejects,
        "report_lines": q_report_lines,
    }
