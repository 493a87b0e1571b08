"""Calendar columns derived from one date column.

Facts carry ``year``, zero-padded ``month`` / ``week`` text, and two labels:
``<prefix>_month`` = ``"YYYY MM"`` and ``<prefix>_week`` = ``"YYYY WW"``.

Week numbers are ISO-8601 (``weekofyear``).  The legacy week label subtracts
one from the calendar year only when week 53 falls in January; week 52 in
January and week 01 in December keep the calendar year (quirk Q3).  With
``iso=True`` the label uses the ISO week-based year instead.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.text import zfill


def calendar_columns(date_col: str | Column, prefix: str, *, padded: bool = True, iso: bool = False) -> dict[str, Column]:
    """Columns ``year, month, week, <prefix>_month, <prefix>_week`` for ``withColumns``.

    ``padded=False`` gives the unpadded numeric variant (``month``/``week`` as
    small integers and labels such as ``"2016 1"``) used by the diets table.
    """
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    y = F.year(d)
    m = F.month(d)
    w = F.weekofyear(d)
    if iso:
        label_year = F.date_part(F.lit("YEAROFWEEK"), d)
    else:
        label_year = F.when((w == 53) & (m == 1), y - 1).otherwise(y)
    if padded:
        m_txt = zfill(m.cast("string"), 2)
        w_txt = zfill(w.cast("string"), 2)
        month_out, week_out = m_txt, w_txt
    else:
        m_txt = m.cast("string")
        w_txt = w.cast("string")
        month_out, week_out = m.cast("smallint"), w.cast("smallint")
    return {
        f"{prefix}_month": F.concat(y.cast("string"), F.lit(" "), m_txt),
        f"{prefix}_week": F.concat(label_year.cast("string"), F.lit(" "), w_txt),
        "year": y.cast("smallint"),
        "month": month_out,
        "week": week_out,
    }


def lookback_start(as_of: _dt.date | str, days: int) -> _dt.date:
    """``as_of - days`` (U1).  ``as_of`` is always a parameter, never ``today()``."""
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return as_of - _dt.timedelta(days=int(days))


def lookback_starts(as_of: _dt.date | str, lookback: dict[str, int]) -> dict[str, _dt.date]:
    """Start date per table from a ``{table: days}`` map."""
    return {k: lookback_start(as_of, v) for k, v in lookback.items()}
