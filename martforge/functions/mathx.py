"""Numeric helpers (F11-F17).  Plain Column expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spreadsheet day 0 in the 1900 date system, and the cell texts
# that mean "no value" in a report.
SERIAL_EPOCH = "1899-12-30"
BLANK_CELLS = ("", "-")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def serial_to_date(n: str | Column) -> Column:
    """Spreadsheet serial day number to DATE (F11): 42370 -> 2016-01-01."""
    days = F.floor(_c(n).try_cast("double")).cast("int")
    return F.date_add(F.to_date(F.lit(SERIAL_EPOCH)), days)


def half_even(c: str | Column, digits: int) -> Column:
    """Round half to even (F12, quirk Q1); ``digits == 0`` keeps integers integral."""
    return F.bround(_c(c), digits)


def half_even_float(c: str | Column, digits: int) -> Column:
    """Half-even rounding of a floating value at its scaled binary value.

    ``rint(x * 10^d) / 10^d``: the same result as the spreadsheet-era float
    rounding of the reference and as DuckDB's ``round_even`` on doubles.  Use
    ``half_even`` for DECIMAL values (exact).
    """
    scale = float(10 ** digits)
    return F.rint(_c(c).cast("double") * F.lit(scale)) / F.lit(scale)


def ratio(num: str | Column, den: str | Column) -> Column:
    """Division that yields NULL for a zero or NULL denominator."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def cell_number(value: str | Column, *, clip_negative: bool = True, dtype: str = "decimal(18,4)") -> Column:
    """Parse a report cell.

    Blank and dash cells give 0.  Negative values give 0 when
    ``clip_negative`` (the legacy behaviour, Q8).  Non-numeric text is NULL.
    """
    v = F.trim(_c(value).cast("string"))
    n = v.try_cast(dtype)
    out = F.when(v.isin(*BLANK_CELLS), F.lit(0).cast(dtype))
    if clip_negative:
        out = out.when(n < 0, F.lit(0).cast(dtype))
    return out.otherwise(n)


def fill_zero(df, columns=None):
    """Fill numeric NULLs with 0 only (Q20: text columns stay NULL)."""
    return df.na.fill(0, subset=columns) if columns else df.na.fill(0)
