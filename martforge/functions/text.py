"""Text helpers (F1-F5, F18).  All are plain Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(s: str | Column, width: int) -> Column:
    """Left-pad with zeros to ``width`` but never truncate (quirk Q2).

    Bare ``lpad`` cuts longer strings (``lpad('12345', 4, '0') = '1234'``).
    """
    s = _c(s)
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def concat_key(*cols: str | Column, sep: str = "") -> Column:
    """NULL-propagating concatenation (F1); unlike ``concat_ws`` a NULL part gives NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i and sep:
            parts.append(F.lit(sep))
        parts.append(_c(c))
    return F.concat(*parts)


def strip_unit(name: str | Column) -> Column:
    """``'Corn (lb)' -> 'Corn'``: text before the character preceding ``'('``.

    Without a ``'('`` the name is returned unchanged (quirk Q6; the legacy
    slice would drop its last two characters).
    """
    n = _c(name)
    pos = F.instr(n, "(")
    return F.when(pos > 1, n.substr(F.lit(1), pos - 2)).when(pos == 1, F.lit("")).otherwise(n)


def header_without_unit(name: str) -> str:
    """Plan-time header clean-up: ``'Corn (lb)' -> 'Corn'``.

    Headers are schema metadata known when the plan is built, so the rule
    runs once per header in the driver, not once per row.  Same rule as
    ``strip_unit``.
    """
    pos = name.find("(")
    if pos < 0:
        return name
    return name[: max(pos - 1, 0)]


def header_without_copy_suffix(name: str, pattern: str = r"\.[123]$") -> str:
    """Plan-time header clean-up: ``'Corn.1' -> 'Corn'``."""
    return re.sub(pattern, "", name)


def strip_copy_suffix(name: str | Column, pattern: str = r"\.[123]$") -> Column:
    """Drop the ``.1 .2 .3`` suffix a spreadsheet adds to repeated headers (Q7).

    Pass ``pattern=r"\\.\\d+$"`` to strip any numeric suffix.
    """
    return F.regexp_replace(_c(name), pattern, "")


def after_colon(value: str | Column) -> Column:
    """Text after ``": "`` (F18): ``'Group: G12' -> 'G12'``.

    Without a ``':'`` the text is returned unchanged (quirk Q6).
    """
    v = _c(value)
    pos = F.instr(v, ":")
    return F.when(pos > 0, v.substr(pos + 2, F.lit(1 << 30))).otherwise(v)


def int_text(c: str | Column) -> Column:
    """Numeric to integer text (F5): ``12.0 -> '12'``."""
    return _c(c).cast("bigint").cast("string")


def not_contains_ci(c: str | Column, token: str) -> Column:
    """Case-insensitive "does not contain" (P11).  NULL text is not selected."""
    return ~F.upper(_c(c)).contains(token.upper())
