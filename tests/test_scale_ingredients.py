"""Ingredient sheets at size: one aggregation over both, with the rows of the join."""

import datetime as dt
from decimal import Decimal

from martforge.plans import ingredients as ing


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_sheets_are_summed_in_one_aggregation(spark):
    ids = "`Order ID` string, Group string, Diet string, `Delivery Date` date, Mill string"
    day = dt.date(2024, 5, 1)
    one, two, none = ("L1", "G1", "D", day, "M"), ("L2", "G1", "D", day, "M"), ("L3", None, "D", day, "M")
    qty = spark.createDataFrame([(*one, 1.0, None, 2.0), (*one, 4.0, None, None), (*two, None, 5.0, None), (*none, 1.0, 1.0, 1.0)],
                                ids + ", `Corn (lb)` double, `Soy (lb)` double, `Corn (bu)` double")
    cost = spark.createDataFrame([(*one, 3.0, 9.0, 0.5), (*two, 1.0, None, None), (*none, 1.0, 1.0, 1.0)],
                                 ids + ", Corn double, Soy double, `Corn.1` double")
    out = ing.ingredients(qty, cost)
    # Corn of L1 only: its soy has no quantity, and L2 has soy without a cost and corn without a quantity.
    assert [(r.order_id, r.ingredient, r.weight, r.cost) for r in out.collect()] == [("L1", "Corn", Decimal("7.00"), Decimal("3.50"))]
    assert "Join" not in physical(out)
