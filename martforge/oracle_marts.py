"""Oracle SQL (DuckDB) for the statistics, the actuals mart and the queries built on them."""

from __future__ import annotations

import datetime as _dt

from martforge import params as P
from martforge.functions.calendar import lookback_start
from martforge.oracle import (GROUPS_BASE, LINES, ING_T, budgets_src_cte, cast_select, deaths_fact_cte,
                              lines_cte, movements_fact_cte, sales_fact_cte, sfx, sql_type)
from martforge.oracle_forms import cells_cte, closeouts_cte, anchors_cte, layout_cte, values_cte


def xr(num: str, den: str, digits: int, scale: int) -> str:
    """Exact half-even ``num / den`` at ``digits`` by integer arithmetic (NULL for 0 / NULL den)."""
    a = f"CAST(({num}) * {10 ** (digits + scale)} AS HUGEINT)"
    d = f"(CAST(({den}) AS HUGEINT) * {10 ** scale})"
    aa, dd = f"abs({a})", f"abs({d})"
    r = f"({aa} % {dd})"
    q0 = f"(({aa} - {r}) // {dd})"
    up = f"CASE WHEN 2 * {r} > {dd} OR (2 * {r} = {dd} AND {q0} % 2 = 1) THEN 1 ELSE 0 END"
    sign = f"CASE WHEN ({a} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
    unit = "1" if digits == 0 else f"CAST(0.{'0' * (digits - 1)}1 AS DECIMAL({digits + 1},{digits}))"
    return (f"CASE WHEN {d} IS NULL OR {d} = 0 OR {a} IS NULL THEN NULL "
            f"ELSE CAST({sign} * ({q0} + {up}) AS DECIMAL(38,0)) * {unit} END")


def _start(table: str, extra_days: int = 0) -> _dt.date:
    s = lookback_start(P.AS_OF, P.LOOKBACK_DAYS[table])
    return lookback_start(s, extra_days) if extra_days else s


def facts_with(closeout_where: str | None = None) -> str:
    """Every fact the actuals mart reads, from the whole tables."""
    forms = f"{layout_cte()},{cells_cte()},{anchors_cte()},{values_cte()},{closeouts_cte()}"
    return (f"WITH {LINES},{GROUPS_BASE},{forms},{movements_fact_cte()},{deaths_fact_cte()},"
            f"{sales_fact_cte()},{sfx(ING_T, '')},{budgets_src_cte()},"
            "\nmovements_all AS (SELECT * FROM movements_fact UNION ALL SELECT * FROM deaths_fact)")


def stats_ctes(keyset: str | None) -> str:
    """Per-group statistics; ``keyset`` restricts groups (a CTE name) or None for all."""
    w = f" AND group_num IN (SELECT group_num FROM {keyset})" if keyset else ""
    disc = ["discount_market_hog_out", "no_value_out", "condemned_market_hog_out"]
    trans = ["yard_dead_out", "dead_on_transport_out"]
    gilt = ["gilt_arrival_to_iso_out", "gilt_sale_external_out", "sow_arrival_out"]

    def s(parts, m):
        return " + ".join(f"{p}_{m}" for p in parts)

    mk = "event_category = 'Market Sale' AND movement_type = 'out'"
    fd = "event_category <> 'Inventory Adjustment' AND movement_type = 'in'"
    return f""",
co AS (
  SELECT group_num, group_type, producer, site, barn, start_date, close_date,
         {xr('avg_dof', '7', 1, 1)} AS wof_avg, {xr('total_location_days', '7', 1, 1)} AS wof_tot,
         number_pigs_started AS start_num, avg_wt_pigs_started AS start_avg_wt,
         standard_market_sale_out_number AS market_num, {s(gilt, 'number')} AS gilt_num,
         {s(disc, 'number')} AS discount_num, deaths_out_number AS death_num,
         {s(trans, 'number')} AS transport_death_num, transfer_feeder_pig_out_number AS transfer_num,
         {xr('standard_market_sale_out_total_wt', 'standard_market_sale_out_number', 1, 0)} AS market_avg_wt,
         {xr(s(gilt, 'total_wt'), s(gilt, 'number'), 1, 0)} AS gilt_avg_wt,
         {xr(s(disc, 'total_wt'), s(disc, 'number'), 1, 0)} AS discount_avg_wt,
         {xr('deaths_out_total_wt', 'deaths_out_number', 1, 0)} AS death_avg_wt,
         {xr(s(trans, 'total_wt'), s(trans, 'number'), 1, 0)} AS transport_death_avg_wt,
         {xr('transfer_feeder_pig_out_total_wt', 'transfer_feeder_pig_out_number', 1, 0)} AS transfer_avg_wt,
         {xr('standard_market_sale_out_receipts', 'standard_market_sale_out_number', 2, 4)} AS market_avg_price_cwt,
         {xr(s(gilt, 'receipts'), s(gilt, 'number'), 2, 4)} AS gilt_avg_price_pig,
         {xr(s(disc, 'total_wt'), s(disc, 'number'), 2, 0)} AS discount_avg_price_pig,
         {xr('transfer_feeder_pig_out_receipts', 'transfer_feeder_pig_out_number', 2, 4)} AS transfer_avg_price_pig,
         fcr_w_dead AS feed_conversion, totals_summary_pigs_in_pig AS pig_cost_pig
  FROM closeouts_wide WHERE TRUE{w}
),
ss AS (
  SELECT group_num, {xr('sum(yield_per)', 'count(yield_per)', 4, 4)} AS yield_per,
         {xr('sum(lean_per)', 'count(lean_per)', 4, 4)} AS lean_per,
         round_even(stddev_samp(CAST(avg_carcass_wt AS DOUBLE)), 4) AS market_std_dev_carcass_wt
  FROM sales_fact WHERE TRUE{w} GROUP BY group_num
),
ls AS (
  SELECT group_num, round_even(avg(sd), 4) AS load_avg_std_dev_carcass_wt
  FROM (SELECT load_id, group_num, stddev_samp(CAST(avg_carcass_wt AS DOUBLE)) AS sd
        FROM sales_fact WHERE TRUE{w} GROUP BY load_id, group_num) x
  GROUP BY group_num
),
rates AS (
  SELECT group_num, feed_grinding_rate, feed_delivery_rate, trucking_market_rate, trucking_feeder_rate,
         rent_cost_week, overhead_cost_pig
  FROM budgets_src WHERE budget_type = 'budget'{w}
),
tons AS (
  SELECT group_num, {xr('sum(w)', 'count(order_id) * 2000', 1, 2)} AS avg_feed_delivery_ton
  FROM (SELECT order_id, group_num, sum(weight) AS w FROM ingredients_fact
        WHERE mill = '{P.HOME_MILL}'{w} GROUP BY order_id, group_num) x
  GROUP BY group_num
),
mv AS (
  SELECT group_num,
         {xr(f'sum(CASE WHEN {mk} THEN quantity END)', f'count(CASE WHEN {mk} THEN quantity END)', 1, 0)}
           AS avg_trucking_market_pig,
         {xr(f'sum(CASE WHEN {fd} THEN quantity END)', f'count(CASE WHEN {fd} THEN quantity END)', 1, 0)}
           AS avg_trucking_feeder_pig
  FROM movements_all WHERE (({mk}) OR ({fd})){w} GROUP BY group_num
)"""


def keyset_cte(name: str, start: _dt.date) -> str:
    types = ", ".join(f"'{t}'" for t in P.ACTUALS_GROUP_TYPES)
    return f""",
{name} AS (
  SELECT group_num FROM src
  WHERE open_date >= DATE '{start}' AND group_type IN ({types}) AND producer <> '{P.EXCLUDED_PRODUCER}'
)"""


def actuals_cte(name: str, keyset: str, stats_suffix: str = "", tons: str = "tons") -> str:
    from martforge.plans.budgets import BUDGET_OUT

    given = {"budget_type": "'actual'", "budget_id": "k.group_num || '-actual'", "group_num": "k.group_num"}
    cols = []
    for f in BUDGET_OUT.fields:
        t = sql_type(f.dataType)
        e = given.get(f.name, f.name)
        if f.name not in given and t not in ("VARCHAR", "DATE"):
            e = f"coalesce(CAST({e} AS {t}), 0)"
        cols.append(f"CAST({e} AS {t}) AS {f.name}")
    body = ",\n         ".join(cols)
    return f""",
{name} AS (
  SELECT {body}
  FROM {keyset} k
  LEFT JOIN co USING (group_num) LEFT JOIN ss USING (group_num) LEFT JOIN ls USING (group_num)
  LEFT JOIN rates USING (group_num) LEFT JOIN {tons} USING (group_num) LEFT JOIN mv USING (group_num)
)"""


def _stat_sql(cte: str, cols: dict[str, str]) -> str:
    sel = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in cols.items())
    return facts_with() + stats_ctes(None) + f"\nSELECT group_num, {sel} FROM {cte}"


def budget_actuals_sql() -> str:
    from martforge.plans.budgets import BUDGET_OUT

    return (facts_with() + keyset_cte("keyset", _start("budget_actuals")) + stats_ctes("keyset")
            + actuals_cte("actuals", "keyset") + f"\nSELECT {cast_select(BUDGET_OUT)} FROM actuals")


def slice_replace_budgets_sql() -> str:
    """Old actuals (a wider window) are replaced by the new run's slice."""
    from martforge.plans.budgets import BUDGET_OUT
    from martforge.registry import PREVIOUS_RUN_EXTRA_DAYS

    start = _start("budget_actuals")
    old_start = _start("budget_actuals", PREVIOUS_RUN_EXTRA_DAYS)
    cols = ", ".join(f.name for f in BUDGET_OUT.fields)
    stats = stats_ctes("keyset")
    begin = stats.index("\ntons AS (")
    tons = stats[begin:stats.index("\n),", begin) + 2]
    before = tons.replace("\ntons AS (", ",\ntons_before AS (").replace(P.HOME_MILL, P.PREVIOUS_HOME_MILL)
    return (facts_with() + keyset_cte("keyset", old_start) + stats + before
            + actuals_cte("old_actuals", "keyset", tons="tons_before")
            + keyset_cte("keyset_new", start) + actuals_cte("new_actuals", "keyset_new")
            + f""",
btgt AS (SELECT {cast_select(BUDGET_OUT)} FROM budgets_src UNION ALL SELECT {cols} FROM old_actuals)
SELECT {cols} FROM btgt WHERE NOT coalesce(start_date >= DATE '{start}' AND budget_type = 'actual', false)
UNION ALL SELECT {cols} FROM new_actuals""")


def slice_replace_closeouts_sql() -> str:
    """Closeouts of an earlier form version, with the slice of groups opened in the window refreshed."""
    from martforge.plans.closeouts import CLOSEOUT_OUT

    start = _start("closeouts")
    old_forms = lines_cte("_o", "l.l_linestatus = 'F'")
    new = f"{layout_cte()},{cells_cte()},{anchors_cte()},{values_cte()},{closeouts_cte()}"
    old = _suffix_forms(f"{cells_cte()},{anchors_cte()},{values_cte()},{closeouts_cte()}", "_o")
    cols = ", ".join(f.name for f in CLOSEOUT_OUT.fields)
    return (f"WITH {LINES},{old_forms},{GROUPS_BASE},{new},{old}" + f"""
SELECT {cols} FROM closeouts_wide_o WHERE NOT coalesce(start_date >= DATE '{start}', false)
UNION ALL
SELECT {cols} FROM closeouts_wide
WHERE group_num IN (SELECT group_num FROM src WHERE open_date >= DATE '{start}')""")


_FORM_CTES = ["og", "lg", "fbase", "prio_in", "lout", "cells", "titles", "anchors", "sec", "lab", "hits", "vals",
              "totals", "totals_all", "flows", "per_stem", "rat", "ratios", "numeric_long", "fixed_long", "wn", "wf", "wn0",
              "closeouts_wide"] + [f"anc{k}" for k in range(1, 10)]


def _suffix_forms(text: str, s: str) -> str:
    """Rename the form CTEs (and their line source) with suffix ``s``."""
    import re

    for name in sorted(_FORM_CTES, key=len, reverse=True):
        text = re.sub(rf"\b{name}\b(?=\s+AS\s*\(|\s|\)|,|\.|$)", name + s, text)
    text = re.sub(r"\bFROM lines\b", f"FROM lines{s}", text)
    return text


def closeout_candidates_sql() -> str:
    start = _start("closeouts")
    tok = P.CANDIDATE_EXCLUDE_TOKEN.upper()
    return (f"WITH {GROUPS_BASE}\nSELECT group_num FROM src WHERE open_date >= DATE '{start}' "
            f"AND NOT contains(upper(group_num), '{tok}') ORDER BY group_num")


def typed_load_rejects_sql() -> str:
    from martforge.schemas import CLOSEOUTS, VARCHAR_LEN

    lens = VARCHAR_LEN["closeouts"]
    whens = []
    for f in CLOSEOUTS.fields:
        t = sql_type(f.dataType)
        if t == "VARCHAR":
            if f.name not in lens:
                continue
            bad = f"length({f.name}) > {lens[f.name]}"
            msg = f"{f.name}: over {lens[f.name]} chars"
        else:
            bad = f"({f.name} IS NOT NULL AND TRY_CAST({f.name} AS {t}) IS NULL)"
            msg = f"{f.name}: not {f.dataType.simpleString()}"
        whens.append(f"WHEN {bad} THEN '{msg}'")
    forms = f"{layout_cte()},{cells_cte()},{anchors_cte()},{values_cte()},{closeouts_cte()}"
    return (f"WITH {LINES},{GROUPS_BASE},{forms}\n"
            f"SELECT group_id, CASE {' '.join(whens)} END AS reason FROM closeouts_wide")


def oracle_marts() -> dict[str, str]:
    from martforge.plans.budgets import BUDGET_OUT

    types = {f.name: sql_type(f.dataType) for f in BUDGET_OUT.fields}
    metric_cols = [c for c in ("group_num", "group_type", "producer", "site", "barn", "start_date", "close_date",
                               "wof_avg", "wof_tot", "start_num", "start_avg_wt", "market_num", "gilt_num",
                               "discount_num", "death_num", "transport_death_num", "transfer_num",
                               "market_avg_wt", "gilt_avg_wt", "discount_avg_wt", "death_avg_wt",
                               "transport_death_avg_wt", "transfer_avg_wt", "market_avg_price_cwt",
                               "gilt_avg_price_pig", "discount_avg_price_pig", "transfer_avg_price_pig",
                               "feed_conversion", "pig_cost_pig")]
    metric_sel = ", ".join(f"CAST({c} AS {types[c]}) AS {c}" for c in metric_cols)
    return {
        "sales_stats": _stat_sql("ss", {"yield_per": "DECIMAL(18,4)", "lean_per": "DECIMAL(18,4)",
                                        "market_std_dev_carcass_wt": "DECIMAL(18,4)"}),
        "load_stddev_avg": _stat_sql("ls", {"load_avg_std_dev_carcass_wt": "DECIMAL(18,4)"}),
        "avg_delivery_tons": _stat_sql("tons", {"avg_feed_delivery_ton": "DECIMAL(18,1)"}),
        "movement_load_avgs": _stat_sql("mv", {"avg_trucking_market_pig": "DECIMAL(18,1)",
                                               "avg_trucking_feeder_pig": "DECIMAL(18,1)"}),
        "closeout_metrics": facts_with() + stats_ctes(None) + f"\nSELECT {metric_sel} FROM co",
        "budget_actuals": budget_actuals_sql(),
        "slice_replace_budgets": slice_replace_budgets_sql(),
        "slice_replace_closeouts": slice_replace_closeouts_sql(),
        "closeout_candidates": closeout_candidates_sql(),
        "typed_load_rejects": typed_load_rejects_sql(),
    }
