"""Duplicate handling (W1-W3, J3) without window functions.

A window ``PARTITION BY key`` sends every row of a key to one task, so a key
holding a third of the data would run in one task.  Here duplicate counts come
from a hash aggregation, which combines partial counts map-side (a hot key
costs one row per map task), and are joined back on the key; AQE splits a
skewed join partition when one key dominates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mark_duplicate_keys(df: DataFrame, keys: Sequence[str], flag: str = "is_dup") -> DataFrame:
    """Flag **every** row whose key occurs more than once (W1, ``keep=False``).

    Keys are compared null-safely (a NULL key part equals another NULL), as a
    spreadsheet duplicate check does.
    """
    counts = _renamed(key_counts(df, keys, "__n"), keys)
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return df.join(counts, cond, "left").select(*df.columns, (F.col("__n") > 1).alias(flag))


def mark_later_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], flag: str = "is_later"
) -> DataFrame:
    """Flag the 2nd and later rows of each key (W2, ``keep='first'``).

    "First" is the smallest ``order_by`` tuple; rows equal in it are ordered by
    their other columns, and of wholly equal rows one is first.  Equal rows are
    counted together, so a key or a row repeated very often stays spread.
    """
    rest = [c for c in df.columns if c not in order_by]
    order = F.struct(*order_by, *rest)
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    first = _renamed(df.groupBy(*keys).agg(F.min(order).alias("__first")), keys)
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    marked = rows.join(first, cond, "left").withColumn("__is_first", order.eqNullSafe(F.col("__first")))
    return marked.select(
        *df.columns,
        F.explode(F.transform(F.sequence(F.lit(1).cast("long"), F.col("__n")), lambda i: ~(F.col("__is_first") & (i == 1)))).alias(flag),
    )


def distinct_first(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column."""
    return df.select(column).dropDuplicates([column])


def unique_keys(df: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Keys that occur exactly once, with their ``carry`` columns (J3 build side)."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.first(c).alias(c) for c in carry]
    return df.groupBy(*keys).agg(*aggs).filter(F.col("__n") == 1).drop("__n")


def unique_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Inner join that ignores ambiguous keys of ``right``.

    A key that occurs more than once on ``right`` cannot tell which row a
    ``left`` row belongs to; such keys are dropped instead of fanning out.
    """
    return left.join(unique_keys(right, keys, carry), list(keys), "inner")
