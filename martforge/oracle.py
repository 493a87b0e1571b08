"""Independent SQL statements of every registered query (DuckDB dialect).

These are written from the raw tables (``lineitem``, ``orders``, ...) without
using the Spark code: they are the correctness oracle the driver runs beside
``queries()``.  Shared building blocks (the fixture shapes of FIXTURES.md) are
CTE fragments; the final SELECT of each query casts every column to the same
type the Spark query emits so values hash identically.
"""

from __future__ import annotations

from pyspark.sql import types as T

from martforge import params as P
from martforge.schemas import sql_type


def cast_select(schema: T.StructType, src: str = "") -> str:
    pre = f"{src}." if src else ""
    return ",\n  ".join(f"CAST({pre}{f.name} AS {sql_type(f.dataType)}) AS {f.name}" for f in schema.fields)


def cal(d: str, prefix: str) -> str:
    """Calendar columns of FIXTURES / F6-F9, legacy week label."""
    y, m, w = f"year({d})", f"month({d})", f"weekofyear({d})"
    mt = f"lpad(CAST({m} AS VARCHAR), 2, '0')"
    wt = f"lpad(CAST({w} AS VARCHAR), 2, '0')"
    return (
        f"CAST({y} AS VARCHAR) || ' ' || {mt} AS {prefix}_month, "
        f"CAST({y} - CASE WHEN {w} = 53 AND {m} = 1 THEN 1 ELSE 0 END AS VARCHAR) || ' ' || {wt} AS {prefix}_week, "
        f"{y} AS year, {mt} AS month, {wt} AS week"
    )


def lines_cte(s: str = "", where: str | None = None) -> str:
    """``lines$S`` = lineitem joined to orders, optionally restricted (raw columns)."""
    w = f"\n  WHERE {where}" if where else ""
    return f"""
lines{s} AS (
  SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice, o.o_orderdate,
         'G' || CAST(o.o_custkey AS VARCHAR) AS group_num,
         CAST(l.l_shipdate AS DATE) AS d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey{w}
)"""


LINES = lines_cte()


def sfx(template: str, s: str) -> str:
    """Instantiate a CTE template: every ``$S`` becomes the suffix ``s``."""
    return template.replace("$S", s)

MOVEMENTS_RAW_T = """
movements_raw$S AS (
  SELECT 'S' || CAST(l_suppkey % 10 AS VARCHAR) AS sow_unit,
         CASE WHEN l_returnflag <> 'R' THEN group_num END AS grp,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'V' || CAST(l_suppkey AS VARCHAR) END AS supplier,
         CASE WHEN l_returnflag = 'A' THEN
              CASE WHEN l_suppkey % 50 = 0 THEN '""" + P.SETUP_LONG_NAME + """'
                   ELSE 'C' || CAST(o_custkey % 100 AS VARCHAR) END END AS customer,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'P' || CAST(l_suppkey % 3 AS VARCHAR) END AS plant,
         CASE l_linenumber WHEN 1 THEN 'Market Sale' WHEN 2 THEN 'Inventory Adjustment'
              WHEN 3 THEN 'Death' WHEN 4 THEN 'Euthanize' ELSE 'Transfer' END AS event_category,
         'E' || CAST(l_linenumber AS VARCHAR) AS event_code,
         l_linestatus AS status_txt,
         CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS movement_id,
         d AS movement_date,
         CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END * CAST(l_quantity AS INTEGER) AS quantity,
         CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END * CAST(l_quantity AS INTEGER) * 250 AS weight,
         CASE WHEN l_returnflag = 'A' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2)) AS cost
  FROM lines$S
)"""


def movements_fact_cte(s: str = "", rename: bool = True) -> str:
    """``movements_fact$S`` from ``lines$S`` (movement report pipeline)."""
    ents = [("sow_unit", "CASE WHEN grp IS NULL THEN sow_unit END"), ("group", "grp"),
            ("supplier", "supplier"), ("customer", "customer"), ("plant", "plant")]
    unions = "\n  UNION ALL\n  ".join(
        f"SELECT '{t}' AS entity_type, {e} AS group_num, * FROM movements_raw{s}" for t, e in ents
    )
    gn = (f"CASE WHEN group_num = '{P.SETUP_LONG_NAME}' THEN '{P.SETUP_SHORT_NAME}' ELSE group_num END"
          if rename else "group_num")
    return sfx(MOVEMENTS_RAW_T, s) + f""",
mlong{s} AS (
  {unions}
),
movements_fact{s} AS (
  SELECT movement_id,
         CASE WHEN quantity < 0 THEN 'out' ELSE 'in' END AS movement_type,
         {gn} AS group_num,
         entity_type, event_category, event_code, event_category || ' ' || status_txt AS event_name,
         movement_date, {cal('movement_date', 'movement')},
         abs(quantity) AS quantity, abs(weight) AS weight, abs(cost) AS cost
  FROM mlong{s} WHERE group_num IS NOT NULL
)"""


def deaths_fact_cte(s: str = "") -> str:
    """``deaths_fact$S`` from ``lines$S`` (mortality list pipeline)."""
    return f"""
deaths_fact{s} AS (
  SELECT '' AS movement_id, 'out' AS movement_type, group_num, 'group' AS entity_type,
         CASE WHEN l_linenumber = 3 THEN 'Death' ELSE 'Euthanize' END AS event_category,
         '' AS event_code, 'Mortality ' || l_linestatus AS event_name,
         d AS movement_date, {cal('d', 'movement')},
         CAST(l_quantity AS INTEGER) AS quantity, CAST(l_quantity AS INTEGER) * 3 AS weight, 0 AS cost
  FROM lines{s} WHERE l_linenumber IN (3, 4)
)"""


def _movements_sql() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    return f"WITH {LINES},{movements_fact_cte()}\nSELECT {cast_select(MOVEMENT_OUT)} FROM movements_fact"


def _deaths_sql() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    return f"WITH {LINES},{deaths_fact_cte()}\nSELECT {cast_select(MOVEMENT_OUT)} FROM deaths_fact"


ING_T = """
ing_base$S AS (
  SELECT 'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         group_num, p_type AS diet, d AS delivery_date,
         CASE WHEN l_suppkey % 3 = 0 THEN '""" + P.HOME_MILL + """' ELSE s_name END AS mill,
         CAST(l_quantity AS DECIMAL(18,4)) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p,
         l_returnflag, l_linestatus
  FROM lines$S JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
),
qty_long$S AS (
  SELECT order_id, group_num, diet, delivery_date, mill, 'Corn' AS ingredient, CAST(q * 100 AS DECIMAL(18,4)) AS quantity FROM ing_base$S
  UNION ALL
  SELECT order_id, group_num, diet, delivery_date, mill, 'Soy', CAST(CASE WHEN l_returnflag <> 'N' THEN q * 40 END AS DECIMAL(18,4)) FROM ing_base$S
  UNION ALL
  SELECT order_id, group_num, diet, delivery_date, mill, 'Corn', CAST(CASE WHEN l_linestatus <> 'F' THEN q * 10 END AS DECIMAL(18,4)) FROM ing_base$S
),
cost_long$S AS (
  SELECT order_id, group_num, diet, delivery_date, mill, 'Corn' AS ingredient, CAST(p * 0.5 AS DECIMAL(18,4)) AS cost FROM ing_base$S
  UNION ALL
  SELECT order_id, group_num, diet, delivery_date, mill, 'Soy', CAST(CASE WHEN l_returnflag <> 'N' THEN p * 0.25 END AS DECIMAL(18,4)) FROM ing_base$S
  UNION ALL
  SELECT order_id, group_num, diet, delivery_date, mill, 'Corn', CAST(CASE WHEN l_linestatus <> 'F' THEN p * 0.125 END AS DECIMAL(18,4)) FROM ing_base$S
),
qty_sum$S AS (
  SELECT order_id, group_num, delivery_date, mill, diet, ingredient, sum(quantity) AS quantity
  FROM qty_long$S
  WHERE order_id IS NOT NULL AND group_num IS NOT NULL AND diet IS NOT NULL
    AND delivery_date IS NOT NULL AND mill IS NOT NULL AND quantity IS NOT NULL
  GROUP BY order_id, group_num, delivery_date, mill, diet, ingredient
),
cost_sum$S AS (
  SELECT order_id, group_num, delivery_date, mill, diet, ingredient, sum(cost) AS cost
  FROM cost_long$S
  WHERE order_id IS NOT NULL AND group_num IS NOT NULL AND diet IS NOT NULL
    AND delivery_date IS NOT NULL AND mill IS NOT NULL AND cost IS NOT NULL
  GROUP BY order_id, group_num, delivery_date, mill, diet, ingredient
),
ingredients_fact$S AS (
  SELECT q.order_id, q.group_num, q.mill, q.delivery_date, """ + cal('q.delivery_date', 'delivery') + """,
         q.diet, q.ingredient, round_even(q.quantity, 2) AS weight, round_even(c.cost, 2) AS cost
  FROM qty_sum$S q JOIN cost_sum$S c
    ON q.order_id = c.order_id AND q.group_num = c.group_num AND q.delivery_date = c.delivery_date
   AND q.mill = c.mill AND q.diet = c.diet AND q.ingredient = c.ingredient
)"""


def _ingredients_sql() -> str:
    from martforge.plans.ingredients import INGREDIENT_OUT

    return f"WITH {LINES},{sfx(ING_T, '')}\nSELECT {cast_select(INGREDIENT_OUT)} FROM ingredients_fact"


def _ingredient_unpivot_sql() -> str:
    return f"""WITH {LINES},{sfx(ING_T, '')}
SELECT order_id, group_num, diet, delivery_date, mill, ingredient, quantity FROM qty_long
WHERE order_id IS NOT NULL AND group_num IS NOT NULL AND diet IS NOT NULL
  AND delivery_date IS NOT NULL AND mill IS NOT NULL AND quantity IS NOT NULL"""


def _ingredient_group_sum_sql() -> str:
    return f"WITH {LINES},{sfx(ING_T, '')}\nSELECT CAST(quantity AS DECIMAL(28,4)) AS quantity, order_id, group_num, delivery_date, mill, diet, ingredient FROM qty_sum"


SALES_T = """
carcass$S AS (
  SELECT 'P' || CAST(l_suppkey % 3 AS VARCHAR) AS plant, CAST(l_suppkey AS INTEGER) AS tattoo, d AS kill_date,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_quantity AS DECIMAL(10,2)) * CAST(1.15 AS DECIMAL(3,2)) + 200 + CAST(k AS DECIMAL(4,0)) AS avg_live_wt,
         180 + CAST(l_quantity AS DECIMAL(10,2)) + CAST(k AS DECIMAL(4,0)) * (l_linenumber + 1)
             + CAST(l_discount AS DECIMAL(4,2)) * 10 AS avg_carcass_wt,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.001 AS DECIMAL(4,3)) AS cwt,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2)) AS head,
         CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax, k
  FROM lines$S CROSS JOIN (VALUES (0), (1), (2)) ks(k)
),
carcass2$S AS (
  SELECT plant, tattoo, kill_date, quantity, avg_live_wt, avg_carcass_wt,
         cwt AS base_price_cwt, cwt * (1 - disc) AS value_cwt, cwt * tax AS vob_cwt,
         head AS base_price, head * (1 - disc) AS value, head * tax AS vob,
         CAST(0.5 AS DECIMAL(2,1)) + disc AS back_fat, 2 + tax AS loin_depth,
         CAST(0.5 AS DECIMAL(2,1)) + disc + CAST(k AS DECIMAL(4,0)) * CAST(0.01 AS DECIMAL(3,2)) AS lean,
         CAST(0.7 AS DECIMAL(2,1)) + tax AS yld
  FROM carcass$S
),
loads$S AS (
  SELECT DISTINCT group_num, d AS kill_date, 'P' || CAST(l_suppkey % 3 AS VARCHAR) AS plant,
         CAST(l_suppkey AS INTEGER) AS tattoo
  FROM lines$S
)"""


def _zfill(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) >= {n} THEN {x} ELSE lpad({x}, {n}, '0') END"


def sales_fact_cte(s: str = "") -> str:
    """``sales_fact$S`` from ``lines$S`` (carcass detail joined to unambiguous loads)."""
    t = "CAST(CAST(tattoo AS BIGINT) AS VARCHAR)"
    return sfx(SALES_T, s) + f""",
uk{s} AS (
  SELECT {_zfill('t', 4)} AS tattoo, kill_date, min(group_num) AS group_num
  FROM (SELECT {t} AS t, kill_date, group_num FROM loads{s} WHERE tattoo IS NOT NULL) x
  GROUP BY 1, 2 HAVING count(*) = 1
),
sales_fact{s} AS (
  SELECT uk.group_num, uk.group_num || '-' || uk.tattoo AS load_id, c.plant, uk.tattoo, c.kill_date,
         {cal('c.kill_date', 'kill')}, c.quantity,
         round_even(avg_live_wt, 1) AS avg_live_wt, round_even(avg_carcass_wt, 0) AS avg_carcass_wt,
         round_even(base_price_cwt, 2) AS base_price_cwt, round_even(vob_cwt, 2) AS vob_cwt,
         round_even(value_cwt, 2) AS value_cwt, round_even(base_price, 2) AS base_price,
         round_even(vob, 2) AS vob, round_even(value, 2) AS value,
         back_fat, loin_depth, yld AS yield_per, lean * 100 AS lean_per
  FROM (SELECT *, {_zfill(t, 4)} AS ttxt FROM carcass2{s}) c
  JOIN uk{s} uk ON c.ttxt = uk.tattoo AND c.kill_date = uk.kill_date
)"""


def _sales_sql() -> str:
    from martforge.plans.sales import SALES_OUT

    return f"WITH {LINES},{sales_fact_cte()}\nSELECT {cast_select(SALES_OUT)} FROM sales_fact"


def _unique_key_join_sql() -> str:
    return f"""WITH {LINES},{sfx(SALES_T, '')},
uk AS (SELECT tattoo, kill_date, min(group_num) AS group_num FROM loads GROUP BY 1, 2 HAVING count(*) = 1)
SELECT c.tattoo, c.kill_date, c.plant, CAST(c.avg_carcass_wt AS DECIMAL(18,2)) AS avg_carcass_wt, uk.group_num
FROM carcass c JOIN uk ON c.tattoo = uk.tattoo AND c.kill_date = uk.kill_date"""


GROUPS_BASE = """
ord AS (
  SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS open_date, max(CAST(o_orderdate AS DATE)) AS last_date
  FROM orders GROUP BY o_custkey
),
gk AS (
  SELECT c_custkey, 'G' || CAST(c_custkey AS VARCHAR) AS group_num,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Finishing' WHEN 'MACHINERY' THEN 'Wean to Finish'
              WHEN 'HOUSEHOLD' THEN 'Nursery' ELSE 'GDU' END AS group_type,
         CASE c_custkey % 3 WHEN 0 THEN 'closed' WHEN 1 THEN 'active' ELSE 'scheduled' END AS status,
         n_name AS producer, 'Site ' || CAST(c_custkey % 7 AS VARCHAR) AS site, c_name AS barn, open_date,
         CASE WHEN c_custkey % 3 = 0 THEN last_date END AS close_date
  FROM customer JOIN ord ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
),
src AS (SELECT group_num, group_type, status, producer, site, barn, open_date, close_date FROM gk),
tgt AS (
  SELECT group_num, group_type, CASE WHEN c_custkey % 7 = 0 THEN 'inactive' ELSE status END AS status,
         producer, site, barn, open_date, close_date
  FROM gk WHERE c_custkey % 10 <> 0
  UNION ALL
  SELECT 'X' || CAST(c_custkey AS VARCHAR), group_type, status, producer, site, barn, open_date, close_date
  FROM gk WHERE c_custkey % 50 = 0
),
s1 AS (
  SELECT group_num, count(*) AS ns, any_value(group_type) AS group_type, any_value(status) AS status,
         any_value(producer) AS producer, any_value(site) AS site, any_value(barn) AS barn,
         any_value(open_date) AS open_date, any_value(close_date) AS close_date
  FROM src GROUP BY group_num
),
diff AS (
  SELECT coalesce(s1.group_num, t.group_num) AS group_num,
         CASE WHEN s1.ns > 1 THEN 'reject'
              WHEN t.group_num IS NULL THEN 'insert'
              WHEN s1.group_num IS NULL THEN 'delete'
              WHEN s1.status IS DISTINCT FROM t.status OR s1.open_date IS DISTINCT FROM t.open_date
                OR s1.close_date IS DISTINCT FROM t.close_date THEN 'update'
              ELSE 'keep' END AS action,
         t.group_num IS NOT NULL AS in_target,
         s1.group_type AS s_group_type, s1.status AS s_status, s1.producer AS s_producer, s1.site AS s_site,
         s1.barn AS s_barn, s1.open_date AS s_open_date, s1.close_date AS s_close_date,
         t.group_type AS t_group_type, t.status AS t_status, t.producer AS t_producer, t.site AS t_site,
         t.barn AS t_barn, t.open_date AS t_open_date, t.close_date AS t_close_date
  FROM s1 FULL OUTER JOIN tgt t ON s1.group_num = t.group_num
),
synced AS (
  SELECT group_num,
         CASE WHEN action = 'insert' THEN s_group_type ELSE t_group_type END AS group_type,
         CASE WHEN action IN ('insert', 'update') THEN s_status ELSE t_status END AS status,
         CASE WHEN action = 'insert' THEN s_producer ELSE t_producer END AS producer,
         CASE WHEN action = 'insert' THEN s_site ELSE t_site END AS site,
         CASE WHEN action = 'insert' THEN s_barn ELSE t_barn END AS barn,
         CASE WHEN action IN ('insert', 'update') THEN s_open_date ELSE t_open_date END AS open_date,
         CASE WHEN action IN ('insert', 'update') THEN s_close_date ELSE t_close_date END AS close_date
  FROM diff
  WHERE action IN ('insert', 'update', 'keep') OR (action = 'reject' AND in_target)
)"""


def _start(table: str) -> str:
    from martforge.functions.calendar import lookback_start

    return f"DATE '{lookback_start(P.AS_OF, P.LOOKBACK_DAYS[table])}'"


OLD_LOAD = "l.l_linestatus = 'F'"


def _window(table: str) -> str:
    return f"CAST(l.l_shipdate AS DATE) >= {_start(table)}"


def _two_loads(table: str) -> str:
    return f"{lines_cte('_o', OLD_LOAD)},{lines_cte('_n', _window(table))}"


def _slice_replace_ingredients() -> str:
    from martforge.plans.ingredients import INGREDIENT_OUT

    st = _start("ingredients")
    return f"""WITH {_two_loads('ingredients')},{sfx(ING_T, '_o')},{sfx(ING_T, '_n')},
r AS (
  SELECT * FROM ingredients_fact_o WHERE NOT coalesce(delivery_date >= {st}, false)
  UNION ALL SELECT * FROM ingredients_fact_n
)
SELECT {cast_select(INGREDIENT_OUT)} FROM r"""


DEATH_IN = "('Death', 'Euthanize')"


def _slice_replace_movements() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    st = _start("movements")
    return f"""WITH {_two_loads('movements')},{movements_fact_cte('_o')},{movements_fact_cte('_n')},
r AS (
  SELECT * FROM movements_fact_o
  WHERE NOT coalesce(movement_date >= {st} AND event_category NOT IN {DEATH_IN}, false)
  UNION ALL SELECT * FROM movements_fact_n
)
SELECT {cast_select(MOVEMENT_OUT)} FROM r"""


def _slice_replace_deaths() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    st = _start("deaths")
    cols = ", ".join(f.name for f in MOVEMENT_OUT.fields)
    return f"""WITH {_two_loads('deaths')},{movements_fact_cte('_o')},{deaths_fact_cte('_o')},{deaths_fact_cte('_n')},
tgt AS (SELECT {cols} FROM movements_fact_o UNION ALL SELECT {cols} FROM deaths_fact_o),
r AS (
  SELECT {cols} FROM tgt
  WHERE NOT coalesce(movement_date >= {st} AND event_category IN {DEATH_IN}, false)
  UNION ALL SELECT {cols} FROM deaths_fact_n
)
SELECT {cast_select(MOVEMENT_OUT)} FROM r"""


def _slice_replace_sales() -> str:
    from martforge.plans.sales import SALES_OUT

    st = _start("sales")
    return f"""WITH {_two_loads('sales')},{sales_fact_cte('_o')},{sales_fact_cte('_n')},
r AS (
  SELECT * FROM sales_fact_o WHERE NOT coalesce(kill_date >= {st}, false)
  UNION ALL SELECT * FROM sales_fact_n
)
SELECT {cast_select(SALES_OUT)} FROM r"""


def budgets_src_cte() -> str:
    """``budgets_src``: one budget row per group with all declared columns."""
    from martforge.schemas import BUDGETS

    given = {
        "budget_id": "gk.group_num || '-budget'", "group_num": "gk.group_num", "budget_type": "'budget'",
        "group_type": "group_type", "producer": "producer", "site": "site", "barn": "barn",
        "start_date": "open_date", "close_date": "close_date",
    }
    rates = ["feed_grinding_rate", "feed_delivery_rate", "trucking_market_rate",
             "trucking_feeder_rate", "rent_cost_week", "overhead_cost_pig"]
    for i, r in enumerate(rates, start=1):
        given[r] = f"CAST(c2.c_acctbal AS DECIMAL(10,4)) * CAST(0.0{i} AS DECIMAL(3,2))"
    cols = ",\n         ".join(
        f"CAST({given.get(f.name, 'NULL')} AS {sql_type(f.dataType)}) AS {f.name}" for f in BUDGETS.fields
    )
    return f"""
budgets_src AS (
  SELECT {cols}
  FROM gk JOIN customer c2 ON gk.c_custkey = c2.c_custkey
)"""


def _actual_keys_cte() -> str:
    types = ", ".join(f"'{t}'" for t in P.ACTUALS_GROUP_TYPES)
    return f"""
keyset AS (
  SELECT group_num FROM src
  WHERE open_date >= {_start('budget_actuals')} AND group_type IN ({types})
    AND producer <> '{P.EXCLUDED_PRODUCER}'
)"""


def _fk_orphans() -> str:
    return f"""WITH {LINES},{movements_fact_cte()},{sales_fact_cte()},{sfx(ING_T, '')},{GROUPS_BASE}
SELECT 'movements' AS fact, group_num, count(*) AS n_rows FROM movements_fact
WHERE entity_type = 'group' AND group_num NOT IN (SELECT group_num FROM tgt) GROUP BY group_num
UNION ALL
SELECT 'sales', group_num, count(*) FROM sales_fact
WHERE group_num NOT IN (SELECT group_num FROM tgt) GROUP BY group_num
UNION ALL
SELECT 'ingredients', group_num, count(*) FROM ingredients_fact
WHERE group_num NOT IN (SELECT group_num FROM tgt) GROUP BY group_num"""


def _tsv_export() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    parts = ", ".join(f"coalesce(CAST({f.name} AS VARCHAR), '')" for f in MOVEMENT_OUT.fields)
    return f"""WITH {LINES},{movements_fact_cte()},
typed AS (SELECT {cast_select(MOVEMENT_OUT)} FROM movements_fact)
SELECT concat_ws(chr(9), {parts}) AS line FROM typed"""


def _typed_load_movements() -> str:
    from martforge.plans.movements import MOVEMENT_OUT
    from martforge.schemas import MOVEMENTS, VARCHAR_LEN

    lens = VARCHAR_LEN["movements"]
    whens = []
    for f in MOVEMENTS.fields:
        if f.name not in {x.name for x in MOVEMENT_OUT.fields}:
            continue
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
    return f"""WITH {LINES},{movements_fact_cte(rename=False)},
typed AS (SELECT {cast_select(MOVEMENT_OUT)} FROM movements_fact)
SELECT movement_id, entity_type, group_num, CASE {' '.join(whens)} END AS reason FROM typed"""


def oracle_sql() -> dict[str, str]:
    line_key_dups = """WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
                   l_extendedprice FROM lineitem)"""
    return {
        "movements": _movements_sql(),
        "deaths": _deaths_sql(),
        "ingredient_unpivot": _ingredient_unpivot_sql(),
        "ingredient_group_sum": _ingredient_group_sum_sql(),
        "ingredients": _ingredients_sql(),
        "sales": _sales_sql(),
        "unique_key_join": _unique_key_join_sql(),
        "dim_diff": f"WITH {GROUPS_BASE}\nSELECT group_num, action FROM diff",
        "dim_sync": f"WITH {GROUPS_BASE}\nSELECT * FROM synced",
        "anti_join_groups": f"""WITH {GROUPS_BASE}
SELECT group_num, 'source_only' AS side FROM src WHERE group_num NOT IN (SELECT group_num FROM tgt)
UNION ALL
SELECT group_num, 'target_only' FROM tgt WHERE group_num NOT IN (SELECT group_num FROM src)""",
        "duplicate_keys": line_key_dups + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_dup
FROM li""",
        "duplicate_later": line_key_dups + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                          ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) > 1 AS is_later
FROM li""",
        "slice_replace_ingredients": _slice_replace_ingredients(),
        "slice_replace_movements": _slice_replace_movements(),
        "slice_replace_deaths": _slice_replace_deaths(),
        "slice_replace_sales": _slice_replace_sales(),
        "budget_init": f"WITH {GROUPS_BASE},{budgets_src_cte()}\nSELECT {_budget_cast()} FROM budgets_src",
        "pk_violations": f"""WITH {LINES},{sfx(ING_T, '')}
SELECT order_id, ingredient, count(*) AS n_rows FROM ingredients_fact
GROUP BY order_id, ingredient HAVING count(*) > 1""",
        "fk_orphans": _fk_orphans(),
        "semi_join_groups": f"""WITH {LINES},{movements_fact_cte()},{GROUPS_BASE},{_actual_keys_cte()}
SELECT {_movement_cast()} FROM movements_fact WHERE group_num IN (SELECT group_num FROM keyset)""",
        "tsv_export": _tsv_export(),
        "typed_load_movements": _typed_load_movements(),
        **_forms(),
    }


def _forms() -> dict[str, str]:
    from martforge.oracle_forms import oracle_forms
    from martforge.oracle_marts import oracle_marts
    from martforge.oracle_misc import oracle_misc
    from martforge.oracle_stored import oracle_stored

    return {**oracle_forms(), **oracle_marts(), **oracle_misc(), **oracle_stored()}


def _budget_cast() -> str:
    from martforge.plans.budgets import BUDGET_OUT

    return cast_select(BUDGET_OUT)


def _movement_cast() -> str:
    from martforge.plans.movements import MOVEMENT_OUT

    return cast_select(MOVEMENT_OUT)
