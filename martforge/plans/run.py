"""The run driver (D11): dimensions, then facts, then forms, then the mart.

The reference decides step order by dictionary order and builds the actuals
mart before this run's facts are applied (quirk Q14).  Here the order is an
explicit dependency chain, and every step after the first reads the tables
committed by the steps before it, which also cuts the lineage between steps
(each stage restarts from written Parquet, so a lost executor never replays
the whole run).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions.calendar import lookback_starts
from martforge.operators import dimsync
from martforge.operators import forms as fm
from martforge.operators.quality import gate, reject_reason
from martforge.plans import budgets as bd
from martforge.plans import closeouts as co
from martforge.plans import ingredients as ing
from martforge.plans import movements as mv
from martforge.plans import sales as sl
from martforge.schemas import GROUPS, TABLES, VARCHAR_LEN
from martforge.session import ensure_checkpoint_dir
from martforge.sinks.tables import Folder, MonthTable, Slice
from martforge.sources.layout import SECTION_LABELS

# Dependency order of the steps.
STEPS = ("groups", "ingredients", "movements", "deaths", "sales", "budget_init", "closeouts", "budget_actuals")


@dataclass
class Reports:
    """One download of every report, as DataFrames in report shape."""

    groups: DataFrame
    ingredient_qty: DataFrame
    ingredient_cost: DataFrame
    movements: DataFrame
    deaths: DataFrame
    carcass: DataFrame
    loads: DataFrame
    cells: DataFrame
    layout: DataFrame
    budgets: DataFrame | None = None


@dataclass(frozen=True)
class RunConfig:
    """What a run depends on besides the reports; nothing here has a default.

    ``lookback``: days per table; ``entity_rename``: report names of entities;
    ``excluded_producer`` / ``group_types`` / ``home_mill``: the actuals mart;
    ``candidate_exclude_token``: group codes that no closeout form is loaded for.
    """

    lookback: Mapping[str, int]
    entity_rename: Mapping[str, str]
    excluded_producer: str
    group_types: Sequence[str]
    home_mill: str
    candidate_exclude_token: str


#: Start of the slices of a first load or backfill.
BEGINNING = _dt.date(1, 1, 1)

#: The run report: a row per step.
RUN_REPORT = "run string, step string, rows_in long, accepted long, rejected long, replaced long"


def movement_family() -> Column:
    """Which of the two movement reports owns a row; rows without a category are the movement report's."""
    return F.when(F.coalesce(F.col("event_category"), F.lit("")).isin(*mv.DEATH_CATEGORIES), "deaths").otherwise("movements")


def stores(spark: SparkSession, warehouse: str) -> dict[str, MonthTable]:
    w = warehouse.rstrip("/")
    return {
        "groups": MonthTable(spark, f"{w}/groups", GROUPS, "open_date"),
        "ingredients": MonthTable(spark, f"{w}/ingredients", ing.INGREDIENT_OUT, "delivery_date"),
        "movements": MonthTable(spark, f"{w}/movements", mv.MOVEMENT_OUT, "movement_date", movement_family()),
        "sales": MonthTable(spark, f"{w}/sales", sl.SALES_OUT, "kill_date"),
        "budgets": MonthTable(spark, f"{w}/budgets", bd.BUDGET_OUT, "start_date", F.coalesce(F.col("budget_type"), F.lit(""))),
        "closeouts": MonthTable(spark, f"{w}/closeouts", co.CLOSEOUT_OUT, "start_date"),
    }


class Loader:
    """Commits the batches of one run and keeps its books."""

    def __init__(self, spark: SparkSession, warehouse: str, *, strict: bool = True, typed: bool = True):
        self.spark, self.warehouse, self.strict, self.typed = spark, warehouse.rstrip("/"), strict, typed
        self.run_id = uuid.uuid4().hex
        self.tables = stores(spark, warehouse)
        self.lines: list[tuple] = []

    def staged(self, batch: DataFrame) -> tuple[DataFrame, Folder]:
        """The batch, computed once."""
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/batch-{uuid.uuid4().hex}"
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path), Folder(self.spark, path)

    def refuse(self, name: str, rows: DataFrame) -> None:
        """Keep refused rows under ``_rejects/<name>/run=<id>``."""
        rows.write.mode("append").parquet(f"{self.warehouse}/_rejects/{name}/run={self.run_id}")

    def book(self, step: str, rows_in: int, accepted: int, rejected: int, replaced: int) -> None:
        self.lines.append((self.run_id, step, rows_in, accepted, rejected, replaced))

    def replace_slice(self, step: str, store: str, batch: DataFrame, part: Slice) -> None:
        """Typed load (K3) of a batch and replacement of its slice.

        Refused are rows that do not fit the declared types or lengths and, with
        ``strict``, rows outside the slice; without it those are appended (legacy)."""
        t = self.tables[store]
        inside = F.coalesce(t.holds(part), F.lit(False))
        reason = reject_reason(batch, TABLES[store], VARCHAR_LEN.get(store)) if self.typed else F.lit(None).cast("string")
        if self.strict:
            reason = F.coalesce(reason, F.when(~inside, F.lit("outside the slice that this load replaces")))
        rows, folder = self.staged(batch.withColumn("reason", reason))
        good = rows.filter(F.col("reason").isNull()).drop("reason")
        rejected = rows.filter(F.col("reason").isNotNull()).count()
        self.refuse(store, rows.filter(F.col("reason").isNotNull()))
        done = t.replace_slice(good.filter(inside), part, computed=True)
        accepted = done.accepted
        if not self.strict:
            t.append(good.filter(~inside))
            accepted += good.filter(~inside).count()
        self.book(step, accepted + rejected, accepted, rejected, done.replaced)
        folder.delete()

    def append_gated(self, step: str, store: str, batch: DataFrame, key: str) -> None:
        """Append rows whose key is new (U8); duplicates, conflicts and NULL keys are refused (K7)."""
        t = self.tables[store]
        gated, folder = self.staged(gate(batch.select(*t.schema.names), TABLES[store], key, max_len=VARCHAR_LEN.get(store), stored=t.read()))
        good = gated.filter("accepted").select(*t.schema.names)
        rejected = gated.filter("reason IS NOT NULL")
        t.append(good)
        self.refuse(store, rejected.select(*t.schema.names, "reason"))
        n = gated.agg(F.sum("n_rows"), F.count(F.when(F.col("accepted"), 1)), F.sum(F.when(F.col("reason").isNotNull(), F.col("n_rows")))).first()
        self.book(step, n[0] or 0, n[1], n[2] or 0, 0)
        folder.delete()

    def replace_dimension(self, step: str, store: str, report: DataFrame) -> None:
        """Key-diff synchronisation of a dimension."""
        t = self.tables[store]
        stored = t.read()
        came, folder = self.staged(report)
        diff = dimsync.dim_diff(came, stored).groupBy("action").count().collect()
        n = {r["action"]: r["count"] for r in diff}
        rows_in, taken = came.count(), sum(n.get(a, 0) for a in ("insert", "update", "keep"))
        t.replace(dimsync.dim_sync(came, stored))
        self.book(step, rows_in, taken, rows_in - taken, n.get("delete", 0) + n.get("update", 0))
        folder.delete()

    def report(self) -> DataFrame:
        return self.spark.createDataFrame(self.lines, RUN_REPORT)


def run(spark: SparkSession, reports: Reports, warehouse: str, *, as_of: _dt.date | str, config: RunConfig,
        first_load: bool = False, strict: bool = True, typed: bool = True, steps: Sequence[str] = STEPS) -> DataFrame:
    """Apply one download to the warehouse; returns the run report, which is also
    appended to ``<warehouse>/_runs``: per step the rows that came, were accepted,
    were refused, and were replaced.

    ``first_load=True`` starts every slice at the beginning, so that no history
    is outside of it (a first load or a backfill).  ``strict=True`` loads no batch
    rows outside their own slice, so rerunning the same download is idempotent
    (the legacy behaviour, ``strict=False``, duplicates death rows reported by
    the movement report, quirk Q13).  ``typed=True`` routes fact rows that
    overflow the declared types, and with ``strict`` those outside the slice, to
    ``_rejects`` (K3) instead of committing them; forms without all section titles
    are listed in ``_rejects/forms``, cells that are no numbers in ``_rejects/form_cells``.
    ``steps`` are the steps to run, always in the order of ``STEPS``.
    """
    start = dict.fromkeys(config.lookback, BEGINNING) if first_load else lookback_starts(as_of, dict(config.lookback))
    load = Loader(spark, warehouse, strict=strict, typed=typed)
    st = load.tables

    def step(name: str) -> bool:
        return name in steps

    if step("groups"):
        load.replace_dimension("groups", "groups", reports.groups)
    if step("ingredients"):
        load.replace_slice("ingredients", "ingredients", ing.ingredients(reports.ingredient_qty, reports.ingredient_cost),
                           Slice(start["ingredients"]))
    if step("movements"):
        load.replace_slice("movements", "movements", mv.movements(reports.movements, rename=dict(config.entity_rename)),
                           Slice(start["movements"], "movements"))
    if step("deaths"):
        load.replace_slice("deaths", "movements", mv.deaths(reports.deaths), Slice(start["deaths"], "deaths"))
    if step("sales"):
        load.replace_slice("sales", "sales", sl.sales(reports.carcass, reports.loads), Slice(start["sales"]))
    if step("budget_init") and reports.budgets is not None:
        load.append_gated("budget_init", "budgets", bd.budget_init(reports.budgets), "budget_id")

    groups = st["groups"].read()
    if step("closeouts"):
        wanted = bd.closeout_candidates(groups, start["closeouts"], config.candidate_exclude_token).select("group_num")
        cells = reports.cells.join(wanted.withColumnRenamed("group_num", "file_id"), "file_id", "left_semi")
        load.refuse("forms", fm.rejected_forms(cells, SECTION_LABELS).withColumn("reason", F.lit("a section title is missing or out of order")))
        parts = co.CloseoutParts(cells, reports.layout)
        load.refuse("form_cells", parts.rejects)
        load.replace_slice("closeouts", "closeouts", parts.wide().join(wanted, "group_num", "left_semi"), Slice(start["closeouts"]))
    if step("budget_actuals"):
        load.replace_slice("budget_actuals", "budgets", bd.budget_actuals(
            groups, st["closeouts"].read(), st["sales"].read(), st["budgets"].read(), st["ingredients"].read(),
            st["movements"].read(), start=start["budget_actuals"], excluded_producer=config.excluded_producer,
            group_types=config.group_types, home_mill=config.home_mill), Slice(start["budget_actuals"], "actual"))
    load.report().write.mode("append").parquet(f"{load.warehouse}/_runs")
    return load.report()


def testdata_reports(spark: SparkSession, sf_dir: str, *, window_start: _dt.date | str | None = None,
                     with_budgets: bool = True) -> Reports:
    """One download built from the test tables (lines shipped on or after ``window_start``)."""
    from martforge.sources import testdata as td
    from martforge.sources.layout import layout_df

    w = None
    if window_start is not None:
        w = F.col("l_shipdate") >= F.lit(f"{window_start} 00:00:00").cast("timestamp_ntz")
    return Reports(
        groups=td.groups(spark, sf_dir),
        ingredient_qty=td.ingredient_qty(spark, sf_dir, w),
        ingredient_cost=td.ingredient_cost(spark, sf_dir, w),
        movements=td.movements_raw(spark, sf_dir, w),
        deaths=td.deaths_raw(spark, sf_dir, w),
        carcass=td.carcass(spark, sf_dir, w),
        loads=td.loads(spark, sf_dir, w),
        cells=td.cells(spark, sf_dir),
        layout=layout_df(spark),
        budgets=td.budgets(spark, sf_dir) if with_budgets else None,
    )
