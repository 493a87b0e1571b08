"""Oracle SQL (DuckDB) for the closeout-form queries.

Written independently of the Spark operators: the cell fixture, the ordered
title search (unrolled into one CTE per title), the labelled-cell lookup
(a self-join of the cell table), totals, ratios and the pivot (one
``max(CASE ...)`` per header).
"""

from __future__ import annotations

from martforge import schemas as S
from martforge.oracle import GROUPS_BASE, LINES, sql_type
from martforge.sources.layout import SECTION_LABELS, fixed_position, layout_rows
from martforge.sources.testdata import ANCHOR_ROWS, DECOY_ROW, LINE_LABEL, PRIORITY_LABEL

TOTAL = S.TOTAL_STEM


def _q(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def layout_cte() -> str:
    rows = ",\n    ".join("(" + ", ".join(_q(v) for v in r) + ")" for r in layout_rows())
    return f"""
layout AS (
  SELECT * FROM (VALUES
    {rows}
  ) t(search_str, adjust_str, column_str, header_str, fixed, data_type, round_digits, category, row_no,
      col_no, value_col)
)"""


def _d(x: str) -> str:
    scale = len(x.split(".")[1]) if "." in x else 0
    return f"CAST({x} AS DECIMAL({max(len(x), 3)},{scale}))"


def cells_cte() -> str:
    pos = {name: fixed_position(i) for i, (name, _) in enumerate(S.CLOSEOUT_FIXED)}
    serial = "date_diff('day', DATE '1899-12-30', {})"
    fixed = {
        "group_num": "'Group: ' || group_num",
        "business_unit": "'Unit: U' || CAST(c_custkey % 4 AS VARCHAR)",
        "producer": "'Producer: ' || producer",
        "start_date": f"CAST({serial.format('open_date')} AS VARCHAR)",
        "close_date": f"coalesce(CAST({serial.format('close_date')} AS VARCHAR), '')",
        "group_type": "group_type", "site": "site", "barn": "barn",
        "capacity": "CAST(n_orders * 25 AS VARCHAR)",
    }
    cells = [(r, 0, _q(t)) for r, t in zip(ANCHOR_ROWS, SECTION_LABELS)]
    cells.append((DECOY_ROW, 0, _q(SECTION_LABELS[7])))
    cells += [(pos[k][0], pos[k][1], v) for k, v in fixed.items()]
    nl, no = "n_lines", "n_orders"
    cells += [
        (17, 0, "'Totals Summary Pigs'"), (17, 3, no), (29, 0, "'Totals Summary Pigs'"), (29, 3, nl),
        (38, 0, "'Inventory Adjustment'"), (38, 3, "n_p"), (38, 5, "'-' || CAST(n_p * 10 AS VARCHAR)"),
        (38, 6, "'12.5'"),
        (44, 0, "'Fcr'"), (44, 3, f"{_d('2.5')} + {_d('0.01')} * ({nl} % 50)"),
        (44, 5, f"{_d('2.6')} + {_d('0.01')} * ({nl} % 50)"),
        (44, 6, "'Avg Dof'"), (44, 8, f"{_d('100.5')} + {nl} % 60"),
        (45, 0, "'Mortality'"), (45, 3, f"{_d('0.001')} * ({nl} % 97)"), (45, 5, f"{_d('0.001')} * ({nl} % 89)"),
        (45, 6, "'Total Location Days'"), (45, 8, f"120 + {nl} % 30"),
        (46, 0, "'Adg'"), (46, 3, f"{_d('1.5')} + {_d('0.01')} * ({nl} % 10)"),
        (46, 5, f"{_d('1.55')} + {_d('0.01')} * ({nl} % 10)"),
        (46, 6, "'Number Pigs Started'"), (46, 8, f"{no} * 20"),
        (47, 6, "'Avg Wt Pigs Started'"), (47, 8, f"{_d('12.5')} + {no} % 7"),
        (52, 0, "'Total Feed'"), (52, 3, f"ext * {_d('0.0001')}"), (52, 5, f"ext * {_d('0.0002')}"),
        (52, 8, f"{nl} * 1000"),
        (53, 0, "'Feed Ingredient'"), (53, 3, f"taxed * {_d('0.01')}"), (53, 10, "'Avg Kcal Lb'"), (53, 12, "'1.5'"),
        (58, 0, "'Standard Market Sale'"), (58, 8, "r1"), (59, 0, "'Total Income'"), (59, 8, "tot - ext"),
        (64, 0, "'Feed Delivery'"), (64, 8, f"{nl} * {_d('12.5')}"), (65, 0, "'Total Expenses'"), (65, 8, "taxed"),
    ]
    per_group = "\n  UNION ALL ".join(
        f"SELECT file_id, {r} AS row_no, {c} AS col_no, CAST({v} AS VARCHAR) AS value FROM fbase"
        for r, c, v in cells
    )
    plabel = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in PRIORITY_LABEL.items())
    llabel = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in LINE_LABEL.items())
    return f"""
og AS (
  SELECT o_custkey, count(*) AS n_orders, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS n_p,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS tot
  FROM orders GROUP BY o_custkey
),
lg AS (
  SELECT o_custkey, count(*) AS n_lines, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ext,
         sum(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS taxed,
         sum(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS r1
  FROM lines GROUP BY o_custkey
),
fbase AS (
  SELECT gk.*, og.n_orders, og.n_p, og.tot, lg.n_lines, lg.ext, lg.taxed, lg.r1, gk.group_num AS file_id
  FROM gk JOIN og ON gk.c_custkey = og.o_custkey JOIN lg ON gk.c_custkey = lg.o_custkey
),
prio_in AS (
  SELECT 'G' || CAST(o_custkey AS VARCHAR) AS file_id, p, count(*) AS cnt,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS rec
  FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS p FROM orders) x
  GROUP BY o_custkey, p
),
lout AS (
  SELECT group_num AS file_id, l_linenumber AS n, count(*) AS cnt, sum(CAST(l_quantity AS INTEGER)) AS q,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS rec
  FROM lines GROUP BY group_num, l_linenumber
),
cells AS (
  {per_group}
  UNION ALL SELECT file_id, p + 11, 0, CASE p {plabel} END FROM prio_in
  UNION ALL SELECT file_id, p + 11, 3, CASE WHEN p = 3 AND cnt = 1 THEN '-' ELSE CAST(cnt AS VARCHAR) END FROM prio_in
  UNION ALL SELECT file_id, p + 11, 5, CAST(cnt * 55 + p AS VARCHAR) FROM prio_in
  UNION ALL SELECT file_id, p + 11, 8, CASE WHEN p = 2 AND cnt = 2 THEN ''
                                           WHEN p = 1 AND cnt >= 3 THEN '-' || CAST(rec AS VARCHAR)
                                           ELSE CAST(rec AS VARCHAR) END FROM prio_in
  UNION ALL SELECT file_id, p + 11, 10, CAST(cnt * {_d('2.5')} AS VARCHAR) FROM prio_in
  UNION ALL SELECT file_id, n + 21, 0, CASE n {llabel} END FROM lout
  UNION ALL SELECT file_id, n + 21, 3, CASE WHEN n = 4 THEN '-' || CAST(cnt AS VARCHAR) ELSE CAST(cnt AS VARCHAR) END FROM lout
  UNION ALL SELECT file_id, n + 21, 5, CASE WHEN n = 3 AND cnt = 1 THEN '' ELSE CAST(q * 2 AS VARCHAR) END FROM lout
  UNION ALL SELECT file_id, n + 21, 8, CASE WHEN n = 3 THEN '-' ELSE CAST(rec AS VARCHAR) END FROM lout
)"""


def anchors_cte() -> str:
    labels = ", ".join(_q(x) for x in SECTION_LABELS)
    parts = [f"""
titles AS (SELECT file_id, row_no, value FROM cells WHERE col_no = 0 AND value IN ({labels})),
anc1 AS (
  SELECT file_id, min(CASE WHEN value = {_q(SECTION_LABELS[0])} THEN row_no END) AS a1
  FROM titles GROUP BY file_id
)"""]
    for k in range(2, len(SECTION_LABELS) + 1):
        parts.append(f"""
anc{k} AS (
  SELECT a.*, min(t.row_no) AS a{k}
  FROM anc{k - 1} a LEFT JOIN titles t
    ON t.file_id = a.file_id AND t.value = {_q(SECTION_LABELS[k - 1])} AND t.row_no >= coalesce(a.a{k - 1}, 0)
  GROUP BY ALL
)""")
    n = len(SECTION_LABELS)
    complete = " AND ".join(f"a{k} IS NOT NULL" for k in range(1, n + 1))
    parts.append(f"\nanchors AS (SELECT * FROM anc{n} WHERE {complete})")
    return ",".join(parts)


def _cell_number(x: str) -> str:
    t = f"trim({x})"
    n = f"TRY_CAST({t} AS DECIMAL(18,6))"
    return f"CASE WHEN {t} IN ('', '-') THEN CAST(0 AS DECIMAL(18,6)) WHEN {n} < 0 THEN CAST(0 AS DECIMAL(18,6)) ELSE {n} END"


def values_cte() -> str:
    n_sections = len(SECTION_LABELS) - 2
    sec = " ".join(
        f"WHEN c.row_no >= a.a{k + 1} + 2 AND c.row_no < a.a{k + 2} - 2 THEN {k}" for k in range(1, n_sections + 1)
    )
    measures = ", ".join(f"'{d}_{m}'" for d in ("in", "out") for m in ("number", "total_wt", "receipts"))
    return f"""
sec AS (
  SELECT c.*, CASE {sec} END AS section FROM cells c JOIN anchors a ON c.file_id = a.file_id
),
lab AS (
  SELECT category, col_no AS label_col, search_str, value_col, header_str, adjust_str, column_str
  FROM layout WHERE search_str IS NOT NULL AND category > 0
),
hits AS (
  SELECT s.file_id, lab.header_str, lab.category, lab.adjust_str, lab.column_str, lab.label_col, s.row_no,
         coalesce(v.value, '') AS raw
  FROM sec s
  JOIN lab ON s.col_no = lab.label_col AND s.section = lab.category AND s.value = lab.search_str
  LEFT JOIN cells v ON v.file_id = s.file_id AND v.row_no = s.row_no AND v.col_no = lab.value_col
  WHERE s.value <> '' AND s.section IS NOT NULL
),
vals AS (
  SELECT file_id, header_str, category, adjust_str, column_str,
         arg_max(num, label_col * 1000000 + row_no) AS value
  FROM (SELECT *, {_cell_number('raw')} AS num FROM hits) h
  GROUP BY file_id, header_str, category, adjust_str, column_str
),
totals AS (
  SELECT file_id, category, '{TOTAL}' AS adjust_str, column_str, '{TOTAL}_' || column_str AS header_str,
         sum(value) AS value
  FROM vals WHERE category IN (1, 2) AND column_str IN ({measures}) AND adjust_str <> '{TOTAL}'
  GROUP BY file_id, category, column_str
),
totals_all AS (
  SELECT a.file_id, m.category, m.column_str, '{TOTAL}_' || m.column_str AS header_str,
         coalesce(t.value, CAST(0 AS DECIMAL(18,6))) AS value
  FROM anchors a
  CROSS JOIN (VALUES (1, 'in_number'), (1, 'in_total_wt'), (1, 'in_receipts'),
                     (2, 'out_number'), (2, 'out_total_wt'), (2, 'out_receipts')) m(category, column_str)
  LEFT JOIN totals t ON t.file_id = a.file_id AND t.category = m.category AND t.column_str = m.column_str
),
flows AS (
  SELECT file_id, category, adjust_str, column_str, value FROM vals
  WHERE category IN (1, 2) AND adjust_str <> '{TOTAL}'
  UNION ALL SELECT file_id, category, adjust_str, column_str, value FROM totals
),
per_stem AS (
  SELECT file_id, category, adjust_str,
         max(CASE WHEN regexp_extract(column_str, '^(in|out)_(.*)$', 2) = 'number' THEN value END) AS number,
         max(CASE WHEN regexp_extract(column_str, '^(in|out)_(.*)$', 2) = 'total_wt' THEN value END) AS total_wt,
         max(CASE WHEN regexp_extract(column_str, '^(in|out)_(.*)$', 2) = 'receipts' THEN value END) AS receipts
  FROM flows GROUP BY file_id, category, adjust_str
),
rat AS (
  SELECT p.file_id, p.category, p.adjust_str, m.measure,
         CASE m.measure
           WHEN 'per' THEN CAST(p.number AS DOUBLE) / NULLIF(CAST(t.value AS DOUBLE), 0)
           WHEN 'pig' THEN CAST(p.receipts AS DOUBLE) / NULLIF(CAST(p.number AS DOUBLE), 0)
           WHEN 'lb' THEN CAST(p.receipts AS DOUBLE) / NULLIF(CAST(p.total_wt AS DOUBLE), 0)
           ELSE CAST(p.total_wt AS DOUBLE) / NULLIF(CAST(p.number AS DOUBLE), 0) END AS r
  FROM per_stem p
  LEFT JOIN totals t ON t.file_id = p.file_id AND t.category = p.category AND t.column_str LIKE '%\\_number' ESCAPE '\\'
  CROSS JOIN (VALUES ('per'), ('pig'), ('lb'), ('avg_wt')) m(measure)
),
ratios AS (
  SELECT rat.file_id, d.header_str, d.round_digits, rat.r
  FROM rat JOIN layout d
    ON d.search_str IS NULL AND d.category = rat.category AND d.adjust_str = rat.adjust_str
   AND d.column_str = CASE WHEN rat.category = 1 THEN 'in_' ELSE 'out_' END || rat.measure
),
numeric_long AS (
  SELECT v.file_id, v.header_str,
         CASE l.round_digits
           WHEN 1 THEN CAST(round_even(v.value, 1) AS DECIMAL(18,6))
           WHEN 2 THEN CAST(round_even(v.value, 2) AS DECIMAL(18,6))
           WHEN 4 THEN CAST(round_even(v.value, 4) AS DECIMAL(18,6))
           WHEN 6 THEN CAST(round_even(v.value, 6) AS DECIMAL(18,6))
           ELSE CAST(v.value AS DECIMAL(18,6)) END AS value
  FROM (
    SELECT file_id, header_str, value FROM vals x
    WHERE NOT (adjust_str = '{TOTAL}' AND category IN (1, 2) AND column_str IN ({measures}))
    UNION ALL SELECT file_id, header_str, value FROM totals_all
  ) v JOIN layout l ON l.header_str = v.header_str
  UNION ALL
  SELECT file_id, header_str,
         CAST(CASE round_digits WHEN 1 THEN round_even(r, 1) WHEN 2 THEN round_even(r, 2)
                   WHEN 4 THEN round_even(r, 4) WHEN 6 THEN round_even(r, 6) ELSE r END AS DECIMAL(18,6))
  FROM ratios
),
fixed_long AS (
  SELECT c.file_id, f.header_str,
         CASE WHEN c.value IS NULL OR c.value = '' THEN NULL
              WHEN f.data_type = 'date'
                THEN CAST(DATE '1899-12-30' + CAST(floor(TRY_CAST(c.value AS DOUBLE)) AS INTEGER) AS VARCHAR)
              WHEN f.data_type = 'split'
                THEN CASE WHEN strpos(c.value, ':') > 0 THEN substr(c.value, strpos(c.value, ':') + 2)
                          ELSE c.value END
              ELSE c.value END AS text
  FROM cells c JOIN layout f ON f.fixed AND c.row_no = f.row_no AND c.col_no = f.col_no
)"""


def forms_with() -> str:
    return f"WITH {LINES},{GROUPS_BASE},{layout_cte()},{cells_cte()},{anchors_cte()},{values_cte()}"


def closeouts_cte() -> str:
    """``closeouts_wide``: the typed 256-column closeout table (needs ``forms_with``)."""
    from martforge.plans.closeouts import CLOSEOUT_OUT, FIXED_HEADERS

    num_cols, fix_cols = [], []
    for f in CLOSEOUT_OUT.fields:
        t = sql_type(f.dataType)
        if f.name == "group_id":
            continue
        if f.name in FIXED_HEADERS:
            fix_cols.append(f"TRY_CAST(max(CASE WHEN header_str = '{f.name}' THEN text END) AS {t}) AS {f.name}")
        else:
            v = f"coalesce(max(CASE WHEN header_str = '{f.name}' THEN value END), CAST(0 AS DECIMAL(18,6)))"
            if t == "BIGINT":
                v = f"round_even({v}, 0)"
            num_cols.append(f"CAST({v} AS {t}) AS {f.name}")
    order = ", ".join(f.name for f in CLOSEOUT_OUT.fields if f.name != "group_id")
    zero = ", ".join(_zero_default(f) for f in CLOSEOUT_OUT.fields
                     if f.name != "group_id" and f.name not in FIXED_HEADERS)
    return f"""
wn AS (SELECT file_id, {', '.join(num_cols)} FROM numeric_long GROUP BY file_id),
wf AS (SELECT file_id, {', '.join(fix_cols)} FROM fixed_long GROUP BY file_id),
wn0 AS (SELECT a.file_id, {zero} FROM anchors a LEFT JOIN wn ON wn.file_id = a.file_id),
closeouts_wide AS (
  SELECT CAST(wn0.file_id AS VARCHAR) AS group_id, {order}
  FROM wn0 LEFT JOIN wf ON wf.file_id = wn0.file_id
)"""


def closeouts_sql() -> str:
    return forms_with() + "," + closeouts_cte() + "\nSELECT * FROM closeouts_wide"


def _zero_default(f) -> str:
    t = sql_type(f.dataType)
    return f"coalesce(wn.{f.name}, CAST(0 AS {t})) AS {f.name}"


def form_pivot_sql() -> str:
    from martforge.plans.closeouts import NUMERIC_HEADERS

    cols = ", ".join(
        f"coalesce(max(CASE WHEN n.header_str = '{h}' THEN n.value END), CAST(0 AS DECIMAL(18,6))) AS {h}"
        for h in NUMERIC_HEADERS
    )
    return forms_with() + f"""
SELECT a.file_id, {cols}
FROM anchors a LEFT JOIN numeric_long n ON n.file_id = a.file_id GROUP BY a.file_id"""


def form_sections_sql() -> str:
    n = len(SECTION_LABELS)
    unions = " UNION ALL ".join(f"SELECT file_id, {k - 1} AS section, a{k} AS anchor_row FROM anchors"
                                for k in range(1, n + 1))
    return forms_with() + f"\nSELECT file_id, CAST(section AS INTEGER) AS section, anchor_row FROM ({unions}) s"


def oracle_forms() -> dict[str, str]:
    return {
        "form_sections": form_sections_sql(),
        "form_extract": forms_with() + "\nSELECT file_id, header_str, value FROM vals",
        "form_totals": forms_with() + "\nSELECT file_id, header_str, CAST(value AS DECIMAL(18,6)) AS value FROM totals",
        "form_ratios": forms_with() + """
SELECT file_id, header_str,
       CAST(CASE round_digits WHEN 1 THEN round_even(r, 1) WHEN 2 THEN round_even(r, 2)
                 WHEN 4 THEN round_even(r, 4) WHEN 6 THEN round_even(r, 6) ELSE r END AS DECIMAL(18,6)) AS value
FROM ratios""",
        "form_pivot": form_pivot_sql(),
        "closeouts": closeouts_sql(),
    }
