"""Diet ingredient facts (D1) from the quantity and cost report sheets.

Plan shape: measures of one name are added within a row, both sheets are put under
each other and summed by the five id columns in one aggregation, and only its results
become a row an ingredient.  So a sheet row is shuffled once, not once a measure, and
nothing is sorted or joined.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.calendar import calendar_columns
from martforge.functions.mathx import half_even
from martforge.functions.text import header_without_copy_suffix, header_without_unit
from martforge.operators.conform import to_schema
from martforge.operators.reshape import measure_columns, quoted, unpivot_measures
from martforge.schemas import INGREDIENTS, widen

INGREDIENT_OUT = widen(INGREDIENTS)
# Sheet header -> column name of the five id columns.
ID_RENAME = {"Order ID": "order_id", "Group": "group_num", "Diet": "diet",
             "Delivery Date": "delivery_date", "Mill": "mill"}
SUM_KEYS = ["order_id", "group_num", "delivery_date", "mill", "diet", "ingredient"]
SHORT_KEY = ["order_id", "ingredient"]


def ingredient_long(wide: DataFrame, value_col: str, normalise, *, n_ids: int = 5,
                    value_type: str = "decimal(18,4)") -> DataFrame:
    """Unpivot one sheet (S2, R1, R3, P7) and sum repeated names (A1)."""
    ids = wide.columns[:n_ids]
    measures = measure_columns(wide, n_ids)
    long = unpivot_measures(wide, ids, measures, "ingredient", value_col,
                            value_type=value_type, normalise=normalise)
    long = long.withColumnsRenamed(ID_RENAME)
    return long.groupBy(*SUM_KEYS).agg(F.sum(value_col).alias(value_col))


def ingredient_group_sum(qty_wide: DataFrame) -> DataFrame:
    """The quantity sheet alone: unpivot, clean headers, group-sum (A1)."""
    return ingredient_long(qty_wide, "quantity", header_without_unit)


def _sheet(wide: DataFrame, normalise, n_ids: int = 5) -> dict[str, F.Column]:
    """Names of a sheet's measures with what a row has of each (NULL: nothing)."""
    named: dict[str, list[F.Column]] = {}
    for h in measure_columns(wide, n_ids):
        named.setdefault(normalise(h), []).append(quoted(h).cast("decimal(18,4)"))
    zero = F.lit(0).cast("decimal(18,4)")
    out = {}
    for name, parts in named.items():
        total = parts[0]
        if len(parts) > 1:
            some = reduce(or_, [p.isNotNull() for p in parts])
            total = F.when(some, reduce(add, [F.coalesce(p, zero) for p in parts]))
        out[name] = total
    return out


def ingredient_sums(qty_wide: DataFrame, cost_wide: DataFrame, copy_suffix: str, n_ids: int = 5) -> DataFrame:
    """``(<ids>, ingredient, quantity, cost)`` of what both sheets have (S2, R1, R3, P7, A1):
    the join of both ``ingredient_long`` on all six keys, as one aggregation."""
    qty = _sheet(qty_wide, header_without_unit, n_ids)
    cost = _sheet(cost_wide, lambda h: header_without_copy_suffix(h, copy_suffix), n_ids)
    names = [n for n in qty if n in cost]
    ids = SUM_KEYS[:-1]

    def under(wide: DataFrame, have: dict[str, F.Column], side: str) -> DataFrame:
        kept = wide.select(*[quoted(c).alias(ID_RENAME.get(c, c)) for c in wide.columns[:n_ids]],
                           *[have[n].alias(f"{side}{i}") for i, n in enumerate(names)])
        return kept.na.drop("any", subset=ids)

    both = under(qty_wide, qty, "q").unionByName(under(cost_wide, cost, "c"), allowMissingColumns=True)
    total = "decimal(28,4)"
    sums = both.groupBy(*ids).agg(*[F.sum(f"{s}{i}").cast(total).alias(f"{s}{i}") for i in range(len(names)) for s in "qc"])
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("ingredient"), F.col(f"q{i}").alias("quantity"), F.col(f"c{i}").alias("cost"))
                              for i, n in enumerate(names)]))
    return sums.select(*ids, rows).filter(F.col("quantity").isNotNull() & F.col("cost").isNotNull())


def ingredients(qty_wide: DataFrame, cost_wide: DataFrame, *, full_key: bool = True,
                iso_week: bool = False, copy_suffix: str = r"\.[123]$") -> DataFrame:
    """Quantity and cost sheets -> ingredient facts.

    ``full_key=True`` (default) matches quantity and cost on all six keys, so
    a row pairs with at most one row.  ``full_key=False`` reproduces the
    legacy match on ``(order_id, ingredient)`` only (quirk Q4), which pairs
    every quantity row of an order with every cost row of the same ingredient
    when an order spans several groups, mills, diets or dates.
    ``copy_suffix`` is the pattern of the copy suffix stripped from repeated
    cost headers (Q7; the legacy one strips ``.1 .2 .3`` only).
    """
    if full_key:
        df = ingredient_sums(qty_wide, cost_wide, copy_suffix)
    else:
        qty = ingredient_long(qty_wide, "quantity", header_without_unit)
        cost = ingredient_long(cost_wide, "cost", lambda h: header_without_copy_suffix(h, copy_suffix))
        df = qty.join(cost.select(*SHORT_KEY, "cost"), SHORT_KEY, "inner")
    df = df.withColumns({
        "weight": half_even("quantity", 2),
        "cost": half_even("cost", 2),
    }).withColumns(calendar_columns("delivery_date", "delivery", iso=iso_week))
    return to_schema(df, INGREDIENT_OUT)
