"""Carcass sales facts (D7): carcass detail joined to its load header.

A carcass row finds its group through the load header on (tattoo, kill date).
Header keys that occur more than once are ambiguous and dropped (J3) instead
of fanning out.  Plan: one aggregation of the header by key (partial
aggregation absorbs hot keys) and one equi-join; AQE splits a skewed key.
Carcass figures are rounded to their stored types before the join, so that its
shuffle and sort carry 64-bit values, not products of up to 38 digits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions.calendar import calendar_columns
from martforge.functions.mathx import half_even
from martforge.functions.text import concat_key, int_text, zfill
from martforge.operators.conform import to_schema
from martforge.operators.dedup import unique_keys
from martforge.schemas import SALES, widen

SALES_OUT = widen(SALES)
LOAD_KEY = ["tattoo", "kill_date"]
# Column -> digits of half-even rounding (F12); 0 keeps integers.
ROUNDING = {"avg_carcass_wt": 0, "avg_live_wt": 1, "base_price_cwt": 2, "vob_cwt": 2,
            "value_cwt": 2, "base_price": 2, "vob": 2, "value": 2}


def tattoo_text(c) -> F.Column:
    """Integer tattoo -> 4-digit text that never truncates."""
    return zfill(int_text(c), 4)


#: Of the carcass row: bits of the figures that their stored type cannot hold.
OVER = "__over"


def may_overflow(have: T.DataType, want: T.DataType) -> bool:
    """Whether a rounded figure of type ``have`` can be too large for ``want``."""
    if not isinstance(have, T.DecimalType):
        return have != want
    whole = 18 if isinstance(want, T.LongType) else want.precision - want.scale
    return have.precision - have.scale + 1 > whole


def stored_figures(carcass: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The carcass rows with their figures as they are stored, and the expressions that
    give the figures after the join: one that does not fit is an error (or NULL without
    ANSI) only there, so that a row without a load is none."""
    c = carcass.withColumns({k: half_even(k, d) for k, d in ROUNDING.items()})
    types, small, over, out = {f.name: f.dataType for f in c.schema.fields}, {}, F.lit(0), {}
    for i, k in enumerate(ROUNDING):
        want = SALES_OUT[k].dataType
        small[k], out[k] = F.col(k).try_cast(want), F.col(k)
        if may_overflow(types[k], want):
            lost = F.col(k).isNotNull() & F.col(k).try_cast(want).isNull()
            over = over.bitwiseOR(F.when(lost, F.lit(1 << i)).otherwise(F.lit(0)))
            too_large = F.lit(Decimal(10) ** 37).cast("decimal(38,0)").cast(want)
            out[k] = F.when(F.col(OVER).bitwiseAND(F.lit(1 << i)) != 0, too_large).otherwise(F.col(k))
    return c.withColumns({**small, OVER: over}), out


def sales(carcass: DataFrame, loads: DataFrame, *, iso_week: bool = False, groups: DataFrame | None = None) -> DataFrame:
    """The carcass rows of each load; with ``groups`` (their ``group_num``) only of the loads
    of these, told from all loads."""
    c, figures = stored_figures(carcass.withColumn("tattoo", F.col("tattoo").cast("bigint")))
    h = (loads.filter(F.col("tattoo").isNotNull())
         .withColumn("tattoo", F.col("tattoo").cast("bigint"))
         .select("group_num", *LOAD_KEY))
    # Keys are compared as numbers, of which each has one text.  What a load alone
    # decides is worked out once a load, not once a carcass.
    one = unique_keys(h, LOAD_KEY, ["group_num"]).withColumn("tattoo_text", tattoo_text("tattoo"))
    if groups is not None:
        one = one.join(groups, "group_num", "left_semi")
    one = one.withColumn("load_id", concat_key("group_num", "tattoo_text", sep="-"))
    one = one.withColumns(calendar_columns("kill_date", "kill", iso=iso_week))
    df = c.drop(*[x for x in one.columns if x not in LOAD_KEY]).join(one, LOAD_KEY, "inner")
    df = df.withColumns(figures).withColumns({"lean_per": F.col("lean") * 100, "yield_per": F.col("yield"), "tattoo": F.col("tattoo_text")})
    return to_schema(df, SALES_OUT)
