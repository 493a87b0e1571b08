"""Reshape operators.

All are narrow transformations (no shuffle) except ``pivot_fixed``, which is one
hash aggregation on the row key with a fixed value list (no extra job to
discover pivot values).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column reference for a header that may contain dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def measure_columns(df: DataFrame, first_ordinal: int) -> list[str]:
    """Variable-width scan (S2): every column from ``first_ordinal`` on, decided at plan time."""
    return df.columns[first_ordinal:]


def unpivot_measures(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    name_col: str,
    value_col: str,
    *,
    value_type: str = "decimal(18,4)",
    normalise: Callable[[str], str] | None = None,
    drop_null_rows: bool = True,
) -> DataFrame:
    """Wide measures to long rows (R1), header clean-up (R3), null drop.

    Each measure column becomes ``(ids..., name_col, value_col)``.  Measures are
    cast to one common type first (``unpivot`` needs it).  ``normalise`` maps
    each header to the emitted name at plan time (e.g. strip a unit or a copy
    suffix); two headers that normalise to the same name become repeated rows
    that a later group-sum collapses.  ``drop_null_rows`` drops a row when **any**
    column is NULL, as the reference's ``dropna()`` does.
    """
    rename = normalise or (lambda h: h)
    values = [quoted(m).cast(value_type).alias(rename(m)) for m in measures]
    long = df.unpivot([quoted(c) for c in ids], values, name_col, value_col)
    if drop_null_rows:
        long = long.na.drop("any")
    return long


def unpivot_entities(
    df: DataFrame, ids: Sequence[str], entity_cols: Sequence[str], type_col: str, key_col: str
) -> DataFrame:
    """Entity columns to ``(type_col, key_col)`` rows, keeping only non-NULL keys."""
    long = df.unpivot(list(ids), list(entity_cols), type_col, key_col)
    return long.filter(F.col(key_col).isNotNull())


def pivot_fixed(
    df: DataFrame, row_key: Sequence[str] | str, header_col: str, value_col: str, headers: Sequence[str]
) -> DataFrame:
    """Long ``(row_key, header, value)`` to one wide row per key.

    ``headers`` is the fixed output column list; values not in it are dropped
    and missing ones are NULL.  Passing the list avoids Spark's extra job to
    discover distinct pivot values.
    """
    keys = [row_key] if isinstance(row_key, str) else list(row_key)
    return df.groupBy(*keys).pivot(header_col, list(headers)).agg(F.first(value_col, ignorenulls=True))
