"""Parameterised report slices (G1-G7): the filters of the report requests,
applied to our own facts.

Every parameter is optional.  ``None`` or the sentinel ``ALL`` (the "All ..."
member of a report form, id 0 in a JSON dimension) means "no filter"; any text is
compared as it is, whatever it begins with.  Filters
on dimension attributes (producer, site, group type) become a ``left_semi``
join with the filtered dimension, so facts are never widened.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _All:
    """The type of ``ALL``."""

    def __repr__(self) -> str:
        return "ALL"


ALL = _All()


def is_all(value: str | _All | None) -> bool:
    return value is None or value is ALL


def report_slice(
    facts: DataFrame,
    *,
    date_col: str | None = None,
    start: _dt.date | str | None = None,
    end: _dt.date | str | None = None,
    equals: Mapping[str, str | _All | None] | None = None,
    in_lists: Mapping[str, Sequence[str]] | None = None,
    groups: DataFrame | None = None,
    group_attrs: Mapping[str, str | _All | None] | None = None,
    key: str = "group_num",
) -> DataFrame:
    """Conjunctive optional filters on a fact table.

    ``equals`` / ``in_lists`` filter fact columns; ``group_attrs`` filter the
    group dimension (``groups``) and keep facts of matching groups.  Date
    bounds are inclusive and literal, so they reach the Parquet scan.
    """
    out = facts
    if date_col is not None and (start is not None or end is not None):
        c = F.col(date_col)
        if start is not None:
            out = out.filter(c >= F.lit(str(start)).cast("date"))
        if end is not None:
            out = out.filter(c <= F.lit(str(end)).cast("date"))
    for col, v in (equals or {}).items():
        if not is_all(v):
            out = out.filter(F.col(col) == F.lit(v))
    for col, vs in (in_lists or {}).items():
        out = out.filter(F.col(col).isin(*vs))
    attrs = {k: v for k, v in (group_attrs or {}).items() if not is_all(v)}
    if attrs:
        g = groups
        for col, v in attrs.items():
            g = g.filter(F.col(col) == F.lit(v))
        out = out.join(g.select(key), key, "left_semi")
    return out


def week_range(week_col: str, start_week: str, end_week: str) -> Column:
    """Production-week bounds on ``'YYYY WW'`` labels (text order equals week order)."""
    return (F.col(week_col) >= F.lit(start_week)) & (F.col(week_col) <= F.lit(end_week))


#: What a report may be requested by (fixed values: the request's names), and where the
#: attribute is: a column of the fact, or an attribute of its group.
REPORT_BY = {
    "producer": ("group", "producer"),
    "site": ("group", "site"),
    "group_type": ("group", "group_type"),
    "status": ("group", "status"),
    "feed_mill": ("fact", "mill"),
    "packer": ("fact", "plant"),
    "event_code": ("fact", "event_code"),
    "event_category": ("fact", "event_category"),
}
#: Which date of a movement a request means, and how it gives its bounds (fixed values).
DATE_TYPES = {"event_date": "movement_date", "applied_date": "applied_date"}
SELECTED_DATES = ("start_end_date", "start_end_week")


def named(codes: DataFrame, field: str, given: Sequence[str]) -> DataFrame:
    """Names that a field's values mean: each may be a name or a code.

    ``codes`` is the decode dictionary ``(field, name, code)``; a value that is a name
    means itself, even if it is also another name's code."""
    f = codes.filter(F.col("field") == field)
    names = f.filter(F.col("name").isin(*given)).select("name", F.col("name").alias("given"))
    coded = f.filter(F.col("code").isin(*given)).select("name", F.col("code").alias("given"))
    return names.unionByName(coded.join(names.select("given"), "given", "left_anti").select("name", "given")).distinct()


def decoded(requests: DataFrame, codes: DataFrame, *, field: str = "field", given: str = "given") -> DataFrame:
    """``requests`` with ``name``, ``code`` and ``reason``: what each (field, given) means.

    Names are looked up first, then codes; what is neither has a reason and goes to the
    rejects.  The dictionary may be of any size: both look-ups are joins on (field, value)
    with one row on the dictionary's side (a code that several names share is refused)."""
    by_name = codes.groupBy(F.col("field").alias("__nf"), F.col("name").alias("__name")).agg(F.min("code").alias("code_of_name"))
    by_code = codes.groupBy(F.col("field").alias("__cf"), F.col("code").alias("__code")).agg(
        F.min("name").alias("name_of_code"), F.count(F.lit(1)).alias("n_names"))
    out = requests.join(by_name, (F.col(field) == F.col("__nf")) & (F.col(given) == F.col("__name")), "left").join(
        by_code, (F.col(field) == F.col("__cf")) & (F.col(given) == F.col("__code")), "left")
    one = F.col("n_names") == 1
    return out.select(
        *[F.col(c) for c in requests.columns],
        F.coalesce("__name", F.when(one, F.col("name_of_code"))).alias("name"),
        F.when(F.col("__name").isNotNull(), F.col("code_of_name")).otherwise(F.when(one, F.col("__code"))).alias("code"),
        F.when(F.col("__name").isNull() & F.col("n_names").isNull(), F.lit("neither a name nor a code"))
        .when(F.col("__name").isNull() & ~one, F.lit("a code of several names")).alias("reason"),
    )


def report_slice_by(facts: DataFrame, report_by: str, values: Sequence[str] | _All, *, groups: DataFrame,
                    codes: DataFrame | None = None, key: str = "group_num") -> DataFrame:
    """Facts of one dimension's values (G3, G4, G6, G7), given as names or codes.

    Without ``codes`` values are names.  A value that the dictionary does not have
    selects nothing; ``decoded`` reports it."""
    if values is ALL:
        return facts
    where, column = REPORT_BY[report_by]
    if codes is None:
        wanted = lambda df: df.filter(F.col(column).isin(*values))
    else:
        names = named(codes, report_by, values).select(F.col("name").alias("__wanted"))
        wanted = lambda df: df.join(names, F.col(column) == F.col("__wanted"), "left_semi")
    if where == "fact":
        return wanted(facts)
    return facts.join(wanted(groups).select(key), key, "left_semi")


def date_window(df: DataFrame, start: _dt.date | str, end: _dt.date | str, *, date_col: str,
                selected_dates: str = "start_end_date", week_col: str | None = None) -> DataFrame:
    """Bounds given as dates or as production weeks."""
    if selected_dates not in SELECTED_DATES:
        raise ValueError(f"selected_dates is one of {SELECTED_DATES}")
    if selected_dates == "start_end_week":
        return df.filter(week_range(week_col, str(start), str(end)))
    return report_slice(df, date_col=date_col, start=start, end=end)
