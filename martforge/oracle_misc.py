"""Oracle SQL (DuckDB) for report scans, JSON sources, report slices, diets and
the scalar-function coverage queries."""

from __future__ import annotations

from martforge import params as P
from martforge.oracle import (GROUPS_BASE, ING_T, LINES, cal, cast_select, deaths_fact_cte, movements_fact_cte,
                              sales_fact_cte, sfx)
from martforge.oracle_forms import anchors_cte, cells_cte, closeouts_cte, layout_cte, values_cte


def _list(vals) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def report_scan_sql() -> str:
    from martforge.registry import REPORT_NAMES, REPORT_ORDINALS

    fields = ", ".join(f"string_split(line, ',')[{o + 1}] AS {n}" for o, n in zip(REPORT_ORDINALS, REPORT_NAMES))
    nf, nb = P.REPORT_FILES, P.REPORT_BANNER_ROWS
    return f"""WITH data AS (
  SELECT '/reports/orders_part' || CAST(o_orderkey % {nf} AS VARCHAR) || '.csv' AS file_path,
         CAST(o_orderkey // {nf} + {nb} AS INTEGER) AS line_no,
         concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                   CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
                   o_orderpriority) AS line
  FROM orders
  UNION ALL
  SELECT '/reports/customers_part' || CAST(c_custkey % {nf} AS VARCHAR) || '.csv',
         CAST(c_custkey // {nf} + {nb} AS INTEGER),
         concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)
  FROM customer
)
SELECT file_path, line_no, {fields}
FROM data WHERE contains(file_path, '{P.REPORT_TOKEN}') AND line_no >= {nb}"""


def json_dimension_sql() -> str:
    return """WITH docs AS (
  SELECT '{"' || c_name || '": {"value": '
         || CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE '"' || CAST(c_custkey AS VARCHAR) || '"' END
         || '}}' AS text
  FROM customer
),
k AS (SELECT text, unnest(json_keys(text)) AS name FROM docs)
SELECT name, json_extract_string(text, '$."' || name || '".value') AS value FROM k
UNION ALL SELECT 'All Sites', '0'"""


def catalog_flatten_sql() -> str:
    def val(n: str) -> str:
        return (f"CASE WHEN json_type({n}) = 'OBJECT' THEN json_extract_string({n}, '$.value') "
                f"ELSE json_extract_string({n}, '$') END")

    return f"""WITH docs AS (
  SELECT '{{"' || c_mktsegment || '": {{"value": ' || CAST(c_nationkey AS VARCHAR)
         || ', "option_type": "option", "options": {{"' || c_name || '": '
         || CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR)
                 WHEN c_custkey % 3 = 1 THEN '{{"value": "' || CAST(c_custkey AS VARCHAR) || '"}}'
                 ELSE '{{"value": "' || CAST(c_custkey AS VARCHAR) || '", "option_type": "button", "options": {{"'
                      || n_name || '": ' || CAST(n_regionkey AS VARCHAR) || '}}}}' END
         || '}}}}}}' AS text
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
l1 AS (
  SELECT k1, json_extract(text, '$."' || k1 || '"') AS n1
  FROM (SELECT text, unnest(json_keys(text)) AS k1 FROM docs) x
),
l2 AS (
  SELECT k1, k2, json_extract(n1, '$.options."' || k2 || '"') AS n2
  FROM (SELECT k1, n1, unnest(json_keys(json_extract(n1, '$.options'))) AS k2 FROM l1
        WHERE json_type(n1) = 'OBJECT' AND json_extract(n1, '$.options') IS NOT NULL) x
),
l3 AS (
  SELECT k1, k2, k3, json_extract(n2, '$.options."' || k3 || '"') AS n3
  FROM (SELECT k1, k2, n2, unnest(json_keys(json_extract(n2, '$.options'))) AS k3 FROM l2
        WHERE json_type(n2) = 'OBJECT' AND json_extract(n2, '$.options') IS NOT NULL) x
)
SELECT 1 AS depth, k1, CAST(NULL AS VARCHAR) AS k2, CAST(NULL AS VARCHAR) AS k3, {val('n1')} AS value FROM l1
UNION ALL SELECT 2, k1, k2, NULL, {val('n2')} FROM l2
UNION ALL SELECT 3, k1, k2, k3, {val('n3')} FROM l3"""


def _date_between(col: str) -> str:
    return f"{col} >= DATE '{P.SLICE_START}' AND {col} <= DATE '{P.SLICE_END}'"


def slices_sql() -> dict[str, str]:
    from martforge.plans.ingredients import INGREDIENT_OUT
    from martforge.plans.movements import MOVEMENT_OUT
    from martforge.plans.sales import SALES_OUT

    forms = f"{layout_cte()},{cells_cte()},{anchors_cte()},{values_cte()},{closeouts_cte()}"
    start = _closeout_start()
    tok = P.CANDIDATE_EXCLUDE_TOKEN.upper()
    return {
        "slice_group_detail": f"""WITH {LINES},{GROUPS_BASE},{forms}
SELECT group_id, group_num, start_date, close_date, totals_summary_pigs_in_number,
       totals_summary_pigs_out_number, standard_market_sale_out_receipts
FROM closeouts_wide
WHERE group_num IN (SELECT group_num FROM src WHERE open_date >= DATE '{start}'
                    AND NOT contains(upper(group_num), '{tok}'))""",
        "slice_group_list": f"""WITH {GROUPS_BASE}
SELECT * FROM src WHERE status = 'active' AND group_type = 'Finishing'""",
        "slice_all_named": f"""WITH {GROUPS_BASE}
SELECT * REPLACE ('All Saints Farm' AS site) FROM src WHERE site = '{P.SLICE_SITE}'""",
        "distinct_producers": f"""WITH {GROUPS_BASE}
SELECT DISTINCT producer FROM src""",
        "slice_mortality": f"""WITH {LINES},{GROUPS_BASE},{deaths_fact_cte()}
SELECT {cast_select(MOVEMENT_OUT)} FROM deaths_fact
WHERE {_date_between('movement_date')}
  AND group_num IN (SELECT group_num FROM src WHERE site = '{P.SLICE_SITE}')""",
        "slice_movements": f"""WITH {LINES},{GROUPS_BASE},{movements_fact_cte()}
SELECT {cast_select(MOVEMENT_OUT)} FROM movements_fact
WHERE {_date_between('movement_date')}
  AND group_num IN (SELECT group_num FROM src WHERE producer = '{P.SLICE_PRODUCER}')""",
        "slice_ingredients": f"""WITH {LINES},{GROUPS_BASE},{sfx(ING_T, '')}
SELECT {cast_select(INGREDIENT_OUT)} FROM ingredients_fact
WHERE {_date_between('delivery_date')} AND mill = '{P.HOME_MILL}'
  AND group_num IN (SELECT group_num FROM src WHERE group_type = 'Wean to Finish')""",
        "slice_feed_usage": f"""WITH {LINES},{sfx(ING_T, '')}
SELECT {cast_select(INGREDIENT_OUT)} FROM ingredients_fact
WHERE delivery_week >= '{P.SLICE_WEEKS[0]}' AND delivery_week <= '{P.SLICE_WEEKS[1]}'
  AND mill IN ({_list(P.SLICE_MILLS)})""",
        "slice_sales": f"""WITH {LINES},{sales_fact_cte()}
SELECT {cast_select(SALES_OUT)} FROM sales_fact
WHERE {_date_between('kill_date')} AND plant IN ({_list(P.SLICE_PLANTS)})""",
    }


def _closeout_start():
    from martforge.functions.calendar import lookback_start

    return lookback_start(P.AS_OF, P.LOOKBACK_DAYS["closeouts"])


def diets_sql() -> str:
    from martforge.plans.diets import DIET_OUT

    return f"""WITH {LINES},{sfx(ING_T, '')},
d AS (
  SELECT order_id, group_num, mill, delivery_date,
         CAST(year(delivery_date) AS VARCHAR) || ' ' || CAST(month(delivery_date) AS VARCHAR) AS delivery_month,
         CAST(year(delivery_date) - CASE WHEN weekofyear(delivery_date) = 53 AND month(delivery_date) = 1
                                         THEN 1 ELSE 0 END AS VARCHAR)
           || ' ' || CAST(weekofyear(delivery_date) AS VARCHAR) AS delivery_week,
         year(delivery_date) AS year, month(delivery_date) AS month, weekofyear(delivery_date) AS week,
         diet, CAST(q * 100 AS DECIMAL(18,4)) AS quantity, p * CAST(0.5 AS DECIMAL(2,1)) AS cost
  FROM ing_base
)
SELECT {cast_select(DIET_OUT)} FROM d"""


def calendar_sql() -> str:
    cols = cal("order_date", "order").replace("year(order_date) AS year", "CAST(year(order_date) AS SMALLINT) AS year")
    return f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT o_orderkey, order_date, {cols},
       CAST(isoyear(order_date) AS VARCHAR) || ' ' || lpad(CAST(weekofyear(order_date) AS VARCHAR), 2, '0')
         AS order_week_iso
FROM o"""


def text_sql() -> str:
    def zf(x: str, n: int) -> str:
        return f"CASE WHEN length({x}) >= {n} THEN {x} ELSE lpad({x}, {n}, '0') END"

    hdr = "CASE WHEN p_partkey % 2 = 0 THEN p_name || ' (lb)' ELSE p_name END"
    lab = "CASE WHEN p_partkey % 2 = 0 THEN 'Brand: ' || p_brand ELSE p_brand END"
    return f"""WITH p AS (SELECT *, {hdr} AS hdr, {lab} AS lab,
                  p_brand || '.' || CAST(p_size % 5 AS VARCHAR) AS cp FROM part)
SELECT p_partkey, {zf('CAST(p_partkey AS VARCHAR)', 4)} AS padded,
       CASE WHEN strpos(hdr, '(') > 1 THEN substr(hdr, 1, strpos(hdr, '(') - 2)
            WHEN strpos(hdr, '(') = 1 THEN '' ELSE hdr END AS header,
       regexp_replace(cp, '\\.[123]$', '') AS copy_name,
       CASE WHEN strpos(lab, ':') > 0 THEN substr(lab, strpos(lab, ':') + 2) ELSE lab END AS label_value,
       p_brand || '|' || CASE WHEN p_size > 25 THEN p_type END AS key,
       NOT contains(upper(p_name), 'GREEN') AS no_green
FROM p"""


def math_sql() -> str:
    q = "CAST(l_quantity AS INTEGER)"
    cell = (f"CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN '-' "
            f"WHEN l_linenumber = 3 THEN '-' || CAST({q} AS VARCHAR) ELSE CAST({q} AS VARCHAR) END")
    n = f"TRY_CAST(trim({cell}) AS DECIMAL(18,4))"
    return f"""SELECT l_orderkey, l_linenumber,
       DATE '1899-12-30' + CAST(floor(CAST(l_orderkey % 40000 + 20000 AS DOUBLE)) AS INTEGER) AS serial_date,
       CAST(round_even(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.005 AS DECIMAL(4,3)), 2) AS DECIMAL(18,2))
         AS price_rounded,
       abs({q} - 25) AS abs_dev,
       CAST(coalesce(round_even(l_extendedprice / NULLIF(l_discount, 0), 2), 0.0) AS DECIMAL(18,2))
         AS price_per_discount,
       TRY_CAST(l_returnflag AS INTEGER) AS flag_number,
       CAST(CASE WHEN trim({cell}) IN ('', '-') THEN 0 WHEN {n} < 0 THEN 0 ELSE {n} END AS DECIMAL(18,0))
         AS cell_value
FROM lineitem"""


def oracle_misc() -> dict[str, str]:
    return {
        "report_scan": report_scan_sql(),
        "json_dimension": json_dimension_sql(),
        "catalog_flatten": catalog_flatten_sql(),
        **slices_sql(),
        "diets": diets_sql(),
        "calendar_columns": calendar_sql(),
        "text_normalise": text_sql(),
        "metric_math": math_sql(),
    }
