"""Movement facts: the movement report (D6) and the mortality list.

Both pipelines are single-stage narrow plans (scan -> project -> unpivot ->
filter): no shuffle, whole-stage codegen end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.calendar import calendar_columns
from martforge.operators.conform import to_schema
from martforge.operators.reshape import unpivot_entities
from martforge.schemas import MOVEMENTS, widen

MOVEMENT_OUT = widen(MOVEMENTS)
# Fixed values (must equal the source reports and target table): the entity
# columns of the movement report, in report order; the event categories that
# belong to the mortality list (the movement report owns every other one).
ENTITY_COLS = ["sow_unit", "group", "supplier", "customer", "plant"]
DEATH_CATEGORIES = ("Death", "Euthanize")
EVENT_IDS = ["event_category", "event_code", "event_name", "movement_id", "movement_date",
             "quantity", "weight", "cost"]


def movements(raw: DataFrame, *, rename: dict[str, str] | None = None, iso_week: bool = False) -> DataFrame:
    """Movement report rows -> movement facts.

    * the sow unit is only the counter-party when no group is given (P4);
    * the five entity columns unpivot to ``(entity_type, group_num)`` and
      rows without an entity are dropped (R2, P6);
    * ``movement_type`` is ``out`` for a negative quantity, else ``in``
      (a NULL quantity counts as ``in``, Q23);
    * entity names listed in ``rename`` are replaced (P5);
    * quantity, weight and cost become absolute values (F13).
    """
    df = raw.withColumn("sow_unit", F.when(F.col("group").isNull(), F.col("sow_unit")))
    long = unpivot_entities(df, EVENT_IDS, ENTITY_COLS, "entity_type", "group_num")
    q = F.col("quantity")
    long = long.withColumn("movement_type", F.when(q < 0, F.lit("out")).otherwise(F.lit("in")))
    if rename:
        long = long.replace(rename, subset=["group_num"])
    long = long.withColumns({
        "quantity": F.abs(q),
        "weight": F.abs(F.col("weight")),
        "cost": F.abs(F.col("cost")),
    })
    long = long.withColumns(calendar_columns("movement_date", "movement", iso=iso_week))
    return to_schema(long, MOVEMENT_OUT)


def deaths(raw: DataFrame, *, iso_week: bool = False) -> DataFrame:
    """Mortality list rows -> movement facts with constant columns."""
    df = raw.withColumns({
        "movement_type": F.lit("out"),
        "entity_type": F.lit("group"),
        "event_code": F.lit(""),
        "cost": F.lit(0),
        "movement_id": F.lit(""),
    })
    df = df.withColumns(calendar_columns("movement_date", "movement", iso=iso_week))
    return to_schema(df, MOVEMENT_OUT)
