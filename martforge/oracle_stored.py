"""Oracle SQL (DuckDB) for queries over stored facts and report exports.

A committed slice has the rows of a slice replacement whose batch keeps to its slice;
what a text load refuses follows from the damage rules of the exports (FIXTURES.md),
said here over the raw tables.
"""

from __future__ import annotations

from martforge import params as P
from martforge.oracle import (
    DEATH_IN, GROUPS_BASE, ING_T, LINES, _sales_sql, _slice_replace_deaths, _slice_replace_ingredients, _slice_replace_movements,
    _slice_replace_sales, _start, _two_loads, budgets_src_cte, cast_select, deaths_fact_cte, movements_fact_cte, sales_fact_cte, sfx,
)

# Rows of the movement report whose record is damaged: text, overflow, no such day, cut.
BAD_QUANTITIES = "(13, 17, -19, 23)"


def _commit_movements() -> str:
    return _slice_replace_movements().replace(
        "SELECT * FROM movements_fact_n", f"SELECT * FROM movements_fact_n WHERE event_category NOT IN {DEATH_IN}")


def _budget_gate() -> str:
    from martforge.plans.budgets import BUDGET_OUT

    rest = ", ".join(f.name for f in BUDGET_OUT.fields if f.name not in ("budget_id", "rent_cost_week"))
    return f"""WITH {LINES},{GROUPS_BASE},{budgets_src_cte()},
sheet AS (SELECT *, CAST(substr(group_num, 2) AS BIGINT) AS n FROM budgets_src),
batch AS (
  SELECT n, budget_id, CAST(rent_cost_week AS DECIMAL(18,4)) AS rent_cost_week, {rest} FROM sheet
  UNION ALL
  SELECT n, CASE WHEN n % 11 <> 1 THEN budget_id END, CAST(rent_cost_week + CASE WHEN n % 6 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,4)), {rest}
  FROM sheet WHERE n % 3 = 0 OR n % 11 = 1
),
rows AS (SELECT n, budget_id, group_num, rent_cost_week, count(*) AS n_rows FROM batch GROUP BY ALL),
judged AS (
  SELECT *, CASE WHEN budget_id IS NULL THEN 'budget_id: NULL'
                 WHEN count(*) OVER (PARTITION BY budget_id) > 1
                      THEN 'budget_id: came ' || CAST(sum(n_rows) OVER (PARTITION BY budget_id) AS VARCHAR) || ' times with different values'
                 WHEN n % 10 = 0 THEN 'budget_id: stored with other values' END AS reason
  FROM rows
)
SELECT budget_id, group_num, rent_cost_week, n_rows, reason, reason IS NULL AND n % 5 <> 0 AS accepted FROM judged"""


def _mart_conflicts() -> str:
    return f"""WITH {LINES},{GROUPS_BASE},{budgets_src_cte()}
SELECT group_num, CAST(2 AS BIGINT) AS n_rows, CAST(2 AS BIGINT) AS n_variants FROM budgets_src
WHERE CAST(substr(group_num, 2) AS BIGINT) % 6 = 0"""


def _text_groups() -> str:
    return f"""WITH {GROUPS_BASE}
SELECT group_num, group_type, status, producer, site, barn, open_date, close_date FROM src
WHERE NOT (status = 'closed' AND site = 'Site 2') AND site <> 'Site 5'"""


def _text_movements() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    facts = movements_fact_cte().replace("WHERE group_num IS NOT NULL", f"WHERE group_num IS NOT NULL AND quantity NOT IN {BAD_QUANTITIES}")
    return f"WITH {LINES},{facts}\nSELECT {cast_select(MOVEMENT_OUT)} FROM movements_fact"


def _text_sales() -> str:
    return _sales_sql().replace("FROM carcass2)", "FROM carcass2 WHERE quantity NOT IN (29, 31))").replace(
        "FROM loads WHERE tattoo IS NOT NULL", "FROM loads WHERE tattoo % 37 <> 5")


def _text_rejects() -> str:
    cells = [
        ("groups", "src", "status = 'closed' AND site = 'Site 2'", "'close_date'", "'open'", "not date"),
        ("groups", "src", "site = 'Site 5'", "NULL", "NULL", "a record has 27 cells"),
        ("movements", "movements_raw", "quantity = 13", "'quantity'", "'13 head'", "not int"),
        ("movements", "movements_raw", "quantity = 17", "'weight'", "'99999999999'", "not int"),
        ("movements", "movements_raw", "quantity = -19", "'movement_date'", "'2001-02-30'", "not date"),
        ("movements", "movements_raw", "quantity = 23", "NULL", "NULL", "a record has 32 cells"),
        ("carcass", "carcass2", "quantity = 29", "'avg_live_wt'", "'n/a'", "not decimal(24,8)"),
        ("loads", "loads", "tattoo % 37 = 5", "'tattoo'", "'T' || CAST(tattoo AS VARCHAR)", "not int"),
    ]
    parts = "\nUNION ALL\n".join(
        f"SELECT '{r}' AS report, {f} AS field, {t} AS text, '{why}' AS reason FROM {src} WHERE {where}"
        for r, src, where, f, t, why in cells)
    return f"""WITH {LINES},{movements_fact_cte()},{sales_fact_cte()},{GROUPS_BASE}
SELECT report, field, text, reason, count(*) AS n_cells FROM ({parts}) GROUP BY ALL"""


def _report_lines() -> str:
    # Nine banner rows, of which four have text, and the header row.
    return f"""WITH {LINES},{movements_fact_cte()}
SELECT strftime(movement_date, '%Y-%m') AS month, count(*) + 5 AS n_lines, CAST(10 AS BIGINT) AS first_record,
       count(*) + 9 AS last_line, count(*) AS n_records
FROM movements_raw GROUP BY 1"""


def _damaged_forms() -> str:
    from martforge.oracle_forms import forms_with

    damage = """
cells AS (
  SELECT file_id, row_no, col_no,
         CASE WHEN col_no = 3 AND row_no BETWEEN 12 AND 16 AND value = '2' THEN '2 head'
              WHEN col_no = 8 AND row_no BETWEEN 22 AND 28 AND ends_with(value, '7') THEN '100000000000000' || value
              ELSE value END AS value
  FROM cells_given
)"""
    text = forms_with()
    begin = text.index("\ncells AS (")
    end = text.index("\n),\ntitles AS", begin) if "\n),\ntitles AS" in text[begin:] else text.index("\n),", begin + 5)
    given = text[begin:end + 2].replace("\ncells AS (", "\ncells_given AS (", 1)
    # The last match wins, also where it has no value.
    return (text[:begin] + given + "," + damage + text[end + 2:]).replace(
        "arg_max(num, label_col * 1000000 + row_no)", "arg_max({'v': num}, label_col * 1000000 + row_no).v")


def _form_cell_rejects() -> str:
    return _damaged_forms() + """
SELECT h.file_id, h.row_no, lab.value_col AS col_no, h.header_str, h.raw AS text,
       CASE WHEN TRY_CAST(trim(h.raw) AS DOUBLE) IS NOT NULL THEN 'does not fit a cell' ELSE 'not a number' END AS reason
FROM hits h JOIN lab ON lab.header_str = h.header_str AND lab.label_col = h.label_col
WHERE trim(h.raw) NOT IN ('', '-') AND TRY_CAST(trim(h.raw) AS DECIMAL(18,6)) IS NULL"""


def _form_pivot_given_layout() -> str:
    """Another layout: rows the other way round, two columns swapped, four digits, a header twice."""
    from martforge.oracle_forms import _q, form_pivot_sql, layout_cte
    from martforge.sources.layout import layout_rows

    rows = []
    for r in reversed(layout_rows()):
        r = list(r)
        if r[7] == 2 and r[2] == "out_receipts":
            r[10] = 5
        elif r[7] == 2 and r[2] == "out_total_wt":
            r[10] = 8
        if r[2] == "in_pig":
            r[6] = 4
        rows.append(r)
    rows.append(["Standard Market Sale", "standard_market_sale", "out_number", "standard_market_sale_out_number", False, "num", 0, 2, -1, 0, 5])
    values = ",\n    ".join("(" + ", ".join(_q(v) for v in [*r, n]) + ")" for n, r in enumerate(rows))
    given = f"""
layout AS (
  SELECT * FROM (VALUES
    {values}
  ) t(search_str, adjust_str, column_str, header_str, fixed, data_type, round_digits, category, row_no,
      col_no, value_col, order_no)
)"""
    text = form_pivot_sql().replace(layout_cte(), given)
    text = text.replace("value_col, header_str, adjust_str, column_str\n  FROM layout", "value_col, header_str, adjust_str, column_str, order_no\n  FROM layout")
    text = text.replace("lab.label_col, s.row_no,", "lab.label_col, lab.order_no, s.row_no,")
    return text.replace("label_col * 1000000 + row_no", "row_no * 100000 + order_no")


def _catalog_walk() -> str:
    return """WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_custkey % 6 AS m FROM customer),
n AS (SELECT k, m, unnest(range(1, m + 2)) AS i FROM c),
p AS (SELECT k, m, i, array_to_string(list_transform(range(1, i + 1), lambda x: 'n' || x), '/') AS path FROM n)
SELECT CAST(i AS INTEGER) AS depth, path, CASE WHEN i <= m THEN CAST(i AS VARCHAR) ELSE 'end ' || k END AS value FROM p
UNION ALL
SELECT CAST(i + 1 AS INTEGER), path || '/leaf', 'x' || k FROM p WHERE i <= m"""


def _decoded_requests() -> str:
    return """WITH codes AS (
  SELECT 'producer' AS field, n_name AS name, CAST(n_nationkey AS VARCHAR) AS code FROM nation
  UNION ALL SELECT 'region', r_name, 'R' || CAST(least(r_regionkey, 3) AS VARCHAR) FROM region
),
asked AS (
  SELECT c_custkey AS request, CASE WHEN c_custkey % 5 = 3 THEN 'region' ELSE 'producer' END AS field,
         CASE c_custkey % 5 WHEN 0 THEN n_name WHEN 1 THEN CAST(n_nationkey AS VARCHAR) WHEN 2 THEN 'old ' || n_name
              WHEN 3 THEN 'R' || CAST(n_regionkey AS VARCHAR) END AS given
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)
SELECT a.request, a.field, a.given,
       coalesce(max(n.name), CASE WHEN count(c.name) = 1 THEN max(c.name) END) AS name,
       coalesce(max(n.code), CASE WHEN count(c.name) = 1 THEN max(c.code) END) AS code,
       CASE WHEN count(n.name) > 0 OR count(c.name) = 1 THEN NULL
            WHEN count(c.name) > 1 THEN 'a code of several names' ELSE 'neither a name nor a code' END AS reason
FROM asked a LEFT JOIN codes n ON n.field = a.field AND n.name = a.given
LEFT JOIN codes c ON c.field = a.field AND c.code = a.given
GROUP BY a.request, a.field, a.given"""


def _slice_movements_applied() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    applied = "movement_date + 9 * CAST(split_part(movement_id, '-', 2) AS INTEGER)"
    facts = movements_fact_cte().replace(
        "WHERE group_num IS NOT NULL",
        f"WHERE group_num IS NOT NULL AND {applied} BETWEEN DATE '{P.SLICE_START}' AND DATE '{P.SLICE_END}'")
    return f"""WITH {LINES},{facts},{GROUPS_BASE}
SELECT {cast_select(MOVEMENT_OUT)} FROM movements_fact
WHERE group_num IN (SELECT group_num FROM gk JOIN nation ON producer = n_name WHERE n_nationkey = {P.SLICE_PRODUCER_CODE})"""


def _slice_feed_usage_by() -> str:
    from martforge.plans.ingredients import INGREDIENT_OUT

    mills = ", ".join(f"'{m}'" for m in P.SLICE_MILLS)
    return f"""WITH {LINES},{sfx(ING_T, '')},{GROUPS_BASE}
SELECT {cast_select(INGREDIENT_OUT)} FROM ingredients_fact
WHERE delivery_date BETWEEN DATE '{P.SLICE_START}' AND DATE '{P.SLICE_END}' AND mill IN ({mills})
  AND group_num IN (SELECT group_num FROM src WHERE site = '{P.SLICE_SITE}')"""


def _run_report() -> str:
    """Rows that come, are taken, refused and replaced, by step of two runs."""
    def fact(step: str, table: str, date: str, owns: str = "true", refuse: str = "false") -> str:
        return f"""
SELECT 1 AS run, '{step}' AS step, count(*) AS rows_in, count(*) FILTER (NOT ({refuse})) AS accepted,
       count(*) FILTER ({refuse}) AS rejected, 0 AS replaced FROM {table}_o
UNION ALL
SELECT 2, '{step}', count(*), count(*) FILTER (NOT ({refuse})), count(*) FILTER ({refuse}),
       (SELECT count(*) FROM {table}_o WHERE {date} >= {_start('sales')} AND {owns}) FROM {table}_n"""

    steps = "\nUNION ALL".join([
        fact("ingredients", "ingredients_fact", "delivery_date"),
        fact("movements", "movements_fact", "movement_date", f"event_category NOT IN {DEATH_IN}", f"event_category IN {DEATH_IN}"),
        fact("deaths", "deaths_fact", "movement_date"),
        fact("sales", "sales_fact", "kill_date"),
    ])
    n = "CAST(substr(group_num, 2) AS BIGINT)"
    return f"""WITH {_two_loads('sales')},{sfx(ING_T, '_o')},{sfx(ING_T, '_n')},{movements_fact_cte('_o')},{movements_fact_cte('_n')},
{deaths_fact_cte('_o')},{deaths_fact_cte('_n')},{sales_fact_cte('_o')},{sales_fact_cte('_n')},{GROUPS_BASE},{budgets_src_cte()}
SELECT CAST(run AS INTEGER) AS run, step, CAST(rows_in AS BIGINT) AS rows_in, CAST(accepted AS BIGINT) AS accepted,
       CAST(rejected AS BIGINT) AS rejected, CAST(replaced AS BIGINT) AS replaced
FROM ({steps}
UNION ALL SELECT 1, 'groups', count(*), count(*), 0, 0 FROM tgt
UNION ALL SELECT 2, 'groups', (SELECT count(*) FROM src), count(*) FILTER (action IN ('insert', 'update', 'keep')), 0,
          count(*) FILTER (action IN ('update', 'delete')) FROM diff
UNION ALL SELECT 1, 'budget_init', count(*), count(*), 0, 0 FROM budgets_src
UNION ALL SELECT 2, 'budget_init', count(*) + count(*) FILTER ({n} % 3 = 0 OR {n} % 11 = 1), 0,
          2 * count(*) FILTER ({n} % 6 = 0 AND {n} % 11 <> 1) + count(*) FILTER ({n} % 11 = 1), 0 FROM budgets_src) x"""


def oracle_stored() -> dict[str, str]:
    from martforge.oracle_marts import slice_replace_budgets_sql, slice_replace_closeouts_sql

    return {
        "run_report": _run_report(),
        "form_cell_rejects": _form_cell_rejects(),
        "form_extract_damaged": _damaged_forms() + "\nSELECT file_id, header_str, value FROM vals",
        "form_pivot_given_layout": _form_pivot_given_layout(),
        "catalog_walk": _catalog_walk(),
        "decoded_requests": _decoded_requests(),
        "slice_movements_applied": _slice_movements_applied(),
        "slice_feed_usage_by": _slice_feed_usage_by(),
        "commit_ingredients": _slice_replace_ingredients(),
        "commit_movements": _commit_movements(),
        "commit_deaths": _slice_replace_deaths(),
        "commit_sales": _slice_replace_sales(),
        "commit_budgets": slice_replace_budgets_sql(),
        "commit_closeouts": slice_replace_closeouts_sql(),
        "budget_gate": _budget_gate(),
        "mart_conflicts": _mart_conflicts(),
        "text_groups": _text_groups(),
        "text_movements": _text_movements(),
        "text_sales": _text_sales(),
        "text_rejects": _text_rejects(),
        "report_lines": _report_lines(),
    }
