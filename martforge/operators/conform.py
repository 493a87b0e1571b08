"""Positional/declared column order (P1, P2) and casts to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_schema(df: DataFrame, schema: T.StructType, *, safe: bool = False) -> DataFrame:
    """Select ``schema``'s columns in declared order, cast to declared types.

    Columns absent from ``df`` become typed NULLs.  ``safe=True`` uses
    ``try_cast`` (overflow / bad text -> NULL) instead of an ANSI cast.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            c = c.try_cast(f.dataType) if safe else c.cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def rename_by_ordinal(df: DataFrame, names: list[str]) -> DataFrame:
    """Relabel columns by position."""
    return df.toDF(*names)
