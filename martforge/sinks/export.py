"""Headerless tab-separated export in declared column order (K1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _escaped(c: str) -> Column:
    """Text of a value; backslash, tab, line feed and carriage return as ``\\\\``, ``\\t``, ``\\n``, ``\\r``."""
    out = F.coalesce(F.col(c).cast("string"), F.lit(""))
    for raw, told in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        out = F.replace(out, F.lit(raw), F.lit(told))
    return out


def tsv_line(columns: Sequence[str]) -> Column:
    """One export record: NULL as empty text, columns joined by a tab."""
    return F.concat_ws("\t", *[_escaped(c) for c in columns])


def tsv_lines(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The records ``write_tsv`` writes, as a one-column DataFrame ``line``."""
    return df.select(tsv_line(list(order or df.columns)).alias("line"))


def write_tsv(df: DataFrame, path: str, order: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Distributed write of ``tsv_lines``: one part file per task, no header."""
    tsv_lines(df, order).write.mode(mode).text(path)
