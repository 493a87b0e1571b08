"""Budgets: the initial budget load (D3) and the actuals-vs-budget mart."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.operators import stats
from martforge.operators.conform import to_schema
from martforge.operators.maintenance import date_slice
from martforge.schemas import BUDGETS, widen
from martforge.session import write_staged

BUDGET_OUT = widen(BUDGETS)


def budget_init(sheet: DataFrame) -> DataFrame:
    """The budget sheet passed through in declared column order (D3, S3, U8)."""
    return to_schema(sheet, BUDGET_OUT)


def actuals_key_set(groups: DataFrame, start: _dt.date | str, *, excluded_producer: str | None,
                    group_types: Sequence[str]) -> DataFrame:
    """Groups the actuals mart covers (S5, P8, P10): opened in the window, of a
    finishing type, not of the excluded producer (a parameter, Q21)."""
    pred = date_slice("open_date", start) & F.col("group_type").isin(*group_types)
    if excluded_producer is not None:
        pred = pred & (F.col("producer") != F.lit(excluded_producer))
    return groups.filter(pred).select("group_num")


def closeout_candidates(groups: DataFrame, start: _dt.date | str, exclude_token: str) -> DataFrame:
    """Groups opened in the window whose code does not contain a token (D10: P8, P11, O1)."""
    from martforge.functions.text import not_contains_ci

    return (groups.filter(date_slice("open_date", start) & not_contains_ci("group_num", exclude_token))
            .select("group_num").orderBy("group_num"))


RATE_COLS = ["feed_grinding_rate", "feed_delivery_rate", "trucking_market_rate", "trucking_feeder_rate",
             "rent_cost_week", "overhead_cost_pig"]


def one_per_group(part: DataFrame) -> DataFrame:
    """One row per group, so that no join multiplies rows: of several rows of a
    group (a sheet or form loaded twice) the smallest in column order."""
    rest = [c for c in part.columns if c != "group_num"]
    return part.groupBy("group_num").agg(F.min(F.struct(*rest)).alias("__r")).select("group_num", "__r.*")


#: What the actuals read of their large sources.
ACTUALS_READS = {
    "closeouts": stats.CLOSEOUT_READS,
    "sales": ["group_num", "load_id", "yield_per", "lean_per", "avg_carcass_wt"],
    "ingredients": ["group_num", "order_id", "mill", "weight"],
    "movements": ["group_num", "event_category", "movement_type", "quantity"],
}


def staged_sources(sources: Mapping[str, DataFrame], keys: DataFrame, home_mills: Sequence[str]) -> dict[str, DataFrame]:
    """The sources of ``budget_actuals``, for several runs of it: of the large ones the
    columns that it reads, of the groups ``keys`` (and of deliveries, those from the home
    mills of the runs), written once to the shared folder.  A run then reads files and
    does not work out the facts again."""
    keys = write_staged(keys.distinct(), "actuals-keys")
    sources = {**sources, "ingredients": sources["ingredients"].filter(F.col("mill").isin(*home_mills))}
    return {**sources, **{
        name: write_staged(sources[name].join(keys, "group_num", "left_semi").select(*columns), f"actuals-{name}")
        for name, columns in ACTUALS_READS.items()}}


def budget_actuals(groups: DataFrame, closeouts: DataFrame, sales: DataFrame, budgets: DataFrame,
                   ingredients: DataFrame, movements: DataFrame, *, start: _dt.date | str,
                   excluded_producer: str | None, group_types: Sequence[str], home_mill: str,
                   corrected: bool = False) -> DataFrame:
    """The 44-column actuals row per group, in the declared budget column order.

    Each source is restricted to the key set by a semi-join and reduced to
    one row per ``group_num`` before any join, so the five left joins never
    multiply rows and all run on the same key (AQE keeps one partitioning or
    broadcasts the small sides).  The key set is worked out once, into the shared
    folder: Spark then knows its size, and if that is small no source is shuffled
    to meet it.  Both statistics of the sales come from one pass over them.  The reference's five separate joins to the
    budget rates become one.  Unmatched numeric measures become 0; text and
    dates stay NULL (quirks Q9, Q10, Q20).
    """
    keys = write_staged(
        actuals_key_set(groups, start, excluded_producer=excluded_producer, group_types=group_types), "actuals-keys")

    def only(df: DataFrame) -> DataFrame:
        return df.join(keys, "group_num", "left_semi")

    base = keys.withColumns({
        "budget_type": F.lit("actual"),
        "budget_id": F.concat(F.col("group_num"), F.lit("-actual")),
    })
    parts = [
        stats.closeout_metrics(only(closeouts), corrected=corrected),
        stats.sales_and_load_stats(only(sales)),
        only(budgets.filter(F.col("budget_type") == "budget")).select("group_num", *RATE_COLS),
        stats.avg_delivery_tons(only(ingredients), home_mill),
        stats.movement_load_avgs(only(movements)),
    ]
    df = base
    for p in parts:
        df = df.join(one_per_group(p), "group_num", "left")
    return to_schema(df, BUDGET_OUT).na.fill(0)
