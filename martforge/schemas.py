"""Target table schemas (the seven declared tables) and the closeout header rule.

Type mapping: VARCHAR(n) -> string (length checked by ``quality``), BIGINT ->
long, INTEGER -> int, SMALLINT and TINYINT (0..255) -> short, DATE -> date,
DECIMAL(p,s) -> decimal(p,s), MONEY -> decimal(19,4), SMALLMONEY ->
decimal(10,4).  Pipelines emit the *widened* variant of a schema (``widen``)
so that arithmetic never fails on overflow; ``quality.typed_load`` narrows to
the exact target and routes overflowing rows to a reject table.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DateType()
SMALL = T.ShortType()
INT = T.IntegerType()
BIG = T.LongType()
MONEY = T.DecimalType(19, 4)
SMALLMONEY = T.DecimalType(10, 4)


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def struct(cols: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared VARCHAR lengths, checked by quality.length_violations.
VARCHAR_LEN: dict[str, dict[str, int]] = {}


def _v(table: str, name: str, n: int) -> tuple[str, T.DataType]:
    VARCHAR_LEN.setdefault(table, {})[name] = n
    return (name, S)


DIETS = struct([
    ("id", BIG), _v("diets", "order_id", 25), _v("diets", "group_num", 25), _v("diets", "mill", 50),
    ("delivery_date", D), _v("diets", "delivery_month", 7), _v("diets", "delivery_week", 7),
    ("year", SMALL), ("month", SMALL), ("week", SMALL), _v("diets", "diet", 50),
    ("quantity", dec(9, 2)), ("cost", MONEY),
])

INGREDIENTS = struct([
    ("id", BIG), _v("ingredients", "order_id", 25), _v("ingredients", "group_num", 25),
    _v("ingredients", "mill", 50), ("delivery_date", D), _v("ingredients", "delivery_month", 7),
    _v("ingredients", "delivery_week", 7), ("year", SMALL), _v("ingredients", "month", 2),
    _v("ingredients", "week", 2), _v("ingredients", "diet", 50), _v("ingredients", "ingredient", 50),
    ("weight", dec(8, 2)), ("cost", MONEY),
])

GROUPS = struct([
    _v("groups", "group_num", 25), _v("groups", "group_type", 25), _v("groups", "status", 25),
    _v("groups", "producer", 50), _v("groups", "site", 50), _v("groups", "barn", 50),
    ("open_date", D), ("close_date", D),
])

MOVEMENTS = struct([
    ("id", BIG), _v("movements", "movement_id", 10), _v("movements", "movement_type", 3),
    _v("movements", "group_num", 25), _v("movements", "entity_type", 20),
    _v("movements", "event_category", 50), _v("movements", "event_code", 10),
    _v("movements", "event_name", 50), ("movement_date", D), _v("movements", "movement_month", 7),
    _v("movements", "movement_week", 7), ("year", SMALL), _v("movements", "month", 2),
    _v("movements", "week", 2), ("quantity", SMALL), ("weight", INT), ("cost", MONEY),
])

SALES = struct([
    ("id", BIG), _v("sales", "group_num", 25), _v("sales", "load_id", 30), _v("sales", "plant", 100),
    _v("sales", "tattoo", 4), ("kill_date", D), _v("sales", "kill_month", 7), _v("sales", "kill_week", 7),
    ("year", SMALL), _v("sales", "month", 2), _v("sales", "week", 2), ("quantity", SMALL),
    ("avg_live_wt", dec(4, 1)), ("avg_carcass_wt", SMALL), ("base_price_cwt", SMALLMONEY),
    ("vob_cwt", SMALLMONEY), ("value_cwt", SMALLMONEY), ("base_price", SMALLMONEY),
    ("vob", SMALLMONEY), ("value", SMALLMONEY), ("back_fat", dec(7, 4)), ("loin_depth", dec(7, 4)),
    ("yield_per", dec(7, 4)), ("lean_per", dec(7, 4)),
])

BUDGETS = struct([
    _v("budgets", "budget_id", 50), _v("budgets", "group_num", 25), _v("budgets", "budget_type", 25),
    _v("budgets", "group_type", 25), _v("budgets", "producer", 50), _v("budgets", "site", 50),
    _v("budgets", "barn", 50), ("start_date", D), ("close_date", D),
    ("wof_avg", dec(4, 1)), ("wof_tot", dec(4, 1)), ("start_num", SMALL), ("start_avg_wt", dec(4, 1)),
    ("market_num", SMALL), ("gilt_num", SMALL), ("discount_num", SMALL), ("death_num", SMALL),
    ("transport_death_num", SMALL), ("transfer_num", SMALL),
    ("market_avg_wt", dec(4, 1)), ("gilt_avg_wt", dec(4, 1)), ("discount_avg_wt", dec(4, 1)),
    ("death_avg_wt", dec(4, 1)), ("transport_death_avg_wt", dec(4, 1)), ("transfer_avg_wt", dec(4, 1)),
    ("market_avg_price_cwt", SMALLMONEY), ("gilt_avg_price_pig", SMALLMONEY),
    ("discount_avg_price_pig", SMALLMONEY), ("transfer_avg_price_pig", SMALLMONEY),
    ("feed_conversion", dec(6, 4)), ("yield_per", dec(7, 4)), ("lean_per", dec(7, 4)),
    ("market_std_dev_carcass_wt", dec(7, 4)), ("load_avg_std_dev_carcass_wt", dec(7, 4)),
    ("feed_grinding_rate", SMALLMONEY), ("feed_delivery_rate", SMALLMONEY),
    ("avg_feed_delivery_ton", dec(4, 1)), ("trucking_market_rate", SMALLMONEY),
    ("avg_trucking_market_pig", dec(4, 1)), ("trucking_feeder_rate", SMALLMONEY),
    ("avg_trucking_feeder_pig", dec(6, 1)), ("rent_cost_week", SMALLMONEY),
    ("pig_cost_pig", SMALLMONEY), ("overhead_cost_pig", SMALLMONEY),
])

# ---------------------------------------------------------------------------
# Closeouts: 256 columns built from category x measure rules.
# The category stems, measure suffixes and metric names below
# must equal the declared table's column names, in the declared order.
# ---------------------------------------------------------------------------
CLOSEOUT_FIXED = [
    ("group_num", S), ("business_unit", S), ("producer", S), ("start_date", D), ("group_type", S),
    ("capacity", SMALL), ("close_date", D), ("site", S), ("state_premise_id", S), ("sq_ft_pig", dec(4, 2)),
    ("barn", S), ("first_pigs_sold", D), ("pin", S), ("sex", S), ("antibiotic", S), ("genetics", S),
    ("flow", S), ("last_pigs_sold", D), ("room", S), ("current_inventory", SMALL),
    ("marketing_contract_type", S), ("health_plan", S), ("health_status", S), ("supervisor", S),
]
IN_STEMS = ["gilt_arrival_to_iso", "purchase_wean_pigs", "totals_summary_pigs", "transfer_feeder_pig"]
OUT_STEMS = [
    "condemned_market_hog", "dead_on_transport", "deaths", "discount_market_hog", "gilt_arrival_to_iso",
    "gilt_sale_external", "no_value", "standard_market_sale", "sow_arrival", "totals_summary_pigs",
    "transfer_feeder_pig", "yard_dead",
]
TOTAL_STEM = "totals_summary_pigs"
FLOW_MEASURES = [
    ("number", SMALL), ("per", dec(7, 6)), ("total_wt", INT), ("avg_wt", dec(4, 1)),
    ("receipts", MONEY), ("pig", SMALLMONEY), ("lb", SMALLMONEY),
]
AGE_MEASURE = ("avg_age_in", dec(4, 1))
ADJUSTMENT = [
    ("inventory_adjustment_number", SMALL), ("inventory_adjustment_per", dec(7, 6)),
    ("inventory_adjustment_total_wt", INT), ("inventory_adjustment_avg_wt", dec(4, 1)),
]
PERFORMANCE_PAIRS = [
    ("adfi", dec(5, 4)), ("adg", dec(5, 4)), ("avg_dead_wt", dec(4, 1)), ("avg_market_weight", dec(4, 1)),
    ("avg_out_wt", dec(4, 1)), ("avg_sales_weight", dec(4, 1)), ("fcr", dec(6, 4)), ("feed_pig_sold", dec(6, 1)),
    ("feed_cost_lb_gain_produced", dec(5, 4)), ("feed_cost_lb_gain_sold", dec(5, 4)),
    ("lb_feed_head", dec(8, 1)), ("mortality", dec(7, 6)), ("net_wt_produced", dec(8, 1)),
    ("net_wt_sold", dec(8, 1)), ("number_of_deaths", SMALL), ("number_pigs_produced", SMALL),
    ("number_pigs_sold", SMALL), ("pig_days", dec(8, 1)), ("total_dead_wt", dec(8, 1)),
    ("total_feed", dec(8, 1)), ("total_wt_produced", dec(8, 1)), ("total_wt_sold", dec(8, 1)),
]
# The declared table spells this one w_dead column with a double underscore.
PAIR_NAME_EXCEPTIONS = {("pig_days", "w_dead"): "pig_days__w_dead"}
SPACE_TIME = [
    ("space_utilization", dec(7, 6)), ("avg_in_wt", dec(4, 1)), ("avg_wt_pigs_started", dec(4, 1)),
    ("empty_days_at_close", dec(4, 1)), ("empty_days_at_start", dec(4, 1)), ("fill_days", dec(4, 1)),
    ("lb_location_yr_sold", dec(8, 1)), ("lb_location_yr_produced", dec(8, 1)),
    ("lb_pig_space_sold", dec(4, 1)), ("lb_pig_space_produced", dec(4, 1)),
    ("lb_pig_space_yr_sold", dec(8, 1)), ("lb_pig_space_yr_produced", dec(8, 1)),
    ("lb_sq_ft_sold", dec(4, 1)), ("lb_sq_ft_produced", dec(4, 1)), ("lb_sq_ft_yr_sold", dec(8, 1)),
    ("lb_sq_ft_yr_produced", dec(8, 1)), ("number_loads_to_fill", dec(4, 1)), ("number_pigs_in", SMALL),
    ("number_pigs_started", SMALL), ("theoretical_pig_days", dec(8, 1)), ("total_actual_pig_days", dec(8, 1)),
    ("total_days_on_feed", dec(4, 1)), ("total_in_wt", dec(8, 1)), ("total_location_days", dec(4, 1)),
    ("total_start_wt", dec(8, 1)), ("turns_year", dec(4, 2)), ("actual_sq_ft_pig", dec(4, 1)),
    ("actual_sq_ft_pig_days", dec(4, 1)), ("avg_dof", dec(4, 1)),
]
FEED_STEMS = ["feed_ingredient", "feed_meds", "gmd", "total_feed"]
FEED_MEASURES = [("cwt_net_wt_produced", SMALLMONEY), ("ton_total_feed", SMALLMONEY), ("qty", dec(8, 1))]
ENERGY = [("avg_kcal_lb", dec(4, 1)), ("energy_conversion", dec(4, 1)), ("kcal_pigs_prod", dec(4, 1)),
          ("total_calories", dec(4, 1))]
PROFIT = ["discount_market_hog", "gilt_arrival_to_iso_profit", "gilt_sale_external",
          "inventory_adjustment_profit", "sow_arrival", "standard_market_sale", "total_income"]
EXPENSES = ["building_rent", "feed_deliveries", "feed_delivery", "feed_grinding",
            "gilt_arrival_to_iso_expense", "inventory_adjustment_expense", "lab_services", "medication",
            "overhead", "profit_loss", "purchase_wean_pigs", "total_expenses", "transfer_feeder_pig",
            "trucking_market", "trucking_wean", "vet_services"]


def pair_name(stem: str, variant: str) -> str:
    return PAIR_NAME_EXCEPTIONS.get((stem, variant), f"{stem}_{variant}")


def flow_columns(direction: str) -> list[tuple[str, str, str, T.DataType]]:
    """(header, stem, measure, type) of the in/out flow block in declared order."""
    stems = IN_STEMS if direction == "in" else OUT_STEMS
    out = []
    for stem in stems:
        for m, t in FLOW_MEASURES:
            out.append((f"{stem}_{direction}_{m}", stem, m, t))
        if direction == "in" and stem != TOTAL_STEM:
            out.append((f"{stem}_in_{AGE_MEASURE[0]}", stem, AGE_MEASURE[0], AGE_MEASURE[1]))
    return out


def closeout_columns() -> list[tuple[str, T.DataType]]:
    cols: list[tuple[str, T.DataType]] = [("group_id", S)]
    cols += CLOSEOUT_FIXED
    cols += [(h, t) for h, _, _, t in flow_columns("in")]
    cols += [(h, t) for h, _, _, t in flow_columns("out")]
    cols += ADJUSTMENT
    for stem, t in PERFORMANCE_PAIRS:
        cols += [(pair_name(stem, "w_dead"), t), (pair_name(stem, "wo_dead"), t)]
    cols += SPACE_TIME
    for m, t in FEED_MEASURES:
        cols += [(f"{m}_{s}", t) for s in FEED_STEMS]
    cols += ENERGY
    cols += [(p, MONEY) for p in PROFIT]
    cols += [(e, MONEY) for e in EXPENSES]
    return cols


CLOSEOUTS = struct(closeout_columns())
# Declared lengths of the closeout text columns: 50, except the two keys of 25.
for _n, _t in CLOSEOUT_FIXED:
    if isinstance(_t, T.StringType):
        VARCHAR_LEN.setdefault("closeouts", {})[_n] = 25 if _n in ("group_num", "group_type") else 50
VARCHAR_LEN.setdefault("closeouts", {})["group_id"] = 50

TABLES = {
    "diets": DIETS, "ingredients": INGREDIENTS, "groups": GROUPS, "movements": MOVEMENTS,
    "sales": SALES, "budgets": BUDGETS, "closeouts": CLOSEOUTS,
}
PRIMARY_KEYS = {
    "diets": ["id"], "ingredients": ["id"], "groups": ["group_num"], "movements": ["id"],
    "sales": ["id"], "budgets": ["budget_id"], "closeouts": ["group_id"],
}


def widen_type(t: T.DataType) -> T.DataType:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(t, T.DecimalType):
        return T.DecimalType(max(t.precision, 18), t.scale)
    return t


def widen(schema: T.StructType, drop: tuple[str, ...] = ("id",)) -> T.StructType:
    """Schema a pipeline emits: no server identity column, no narrow numerics."""
    return T.StructType([
        T.StructField(f.name, widen_type(f.dataType), True) for f in schema.fields if f.name not in drop
    ])


def sql_type(t: T.DataType) -> str:
    """Type name valid in both Spark SQL and DuckDB."""
    if isinstance(t, T.StringType):
        return "VARCHAR"
    if isinstance(t, T.DateType):
        return "DATE"
    if isinstance(t, T.LongType):
        return "BIGINT"
    if isinstance(t, T.IntegerType):
        return "INTEGER"
    if isinstance(t, T.ShortType):
        return "SMALLINT"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    if isinstance(t, T.DoubleType):
        return "DOUBLE"
    if isinstance(t, T.BooleanType):
        return "BOOLEAN"
    raise TypeError(t)
