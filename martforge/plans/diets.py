"""Diet deliveries (D9): the one-row-per-delivery variant of the ingredient
sheet, with unpadded numeric calendar columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martforge.functions.calendar import calendar_columns
from martforge.operators.conform import to_schema
from martforge.schemas import DIETS, widen

DIET_OUT = widen(DIETS)
DIET_NAMES = ["group_num", "delivery_date", "diet", "quantity", "mill", "order_id", "cost"]


def diets(sheet: DataFrame) -> DataFrame:
    """Sheet columns (already selected by ordinal) -> diet facts."""
    df = sheet.toDF(*DIET_NAMES)
    df = df.withColumns(calendar_columns("delivery_date", "delivery", padded=False))
    return to_schema(df, DIET_OUT)
