"""Report exports of the test tables as text files, in the shape of the real ones.

Every report is written from its whole adapter table (``testdata``): banner rows, a
header row, then records with the wanted cells at their ordinals and other cells
between them, one file per month.  Lines are dealt to months before they become records
of text, and nothing is sorted: the rows above come when a task meets a file for the first time.  Some records are damaged on purpose by rules over
their own values (FIXTURES.md), so that loads have something to refuse.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Set

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.session import ensure_checkpoint_dir
from martforge.sources import testdata as td
from martforge.sources.definitions import DEFINITIONS, ReportDef

SIDE_BY_SIDE = "spark.sql.maxConcurrentOutputFileWriters"
#: Unused cells: the first two hold a separator and quotes, the others are blank.
FILLERS = ('"Smith, J."', '"said ""ok"""')


def _cell(text: Column, plain: bool = False) -> Column:
    """A cell as text; quoted if it holds a separator or quotes, which ``plain`` ones (figures and dates) do not."""
    if plain:
        return F.coalesce(text, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.contains(",") | text.contains('"'), quoted).otherwise(text), F.lit(""))


def record_line(definition: ReportDef, cells: dict[str, Column], plain: Set[str] = frozenset()) -> Column:
    at = {o: _cell(cells[n], n in plain) for o, n, _ in definition.fields}
    fillers = iter(FILLERS)
    return F.concat_ws(",", *[at[i] if i in at else F.lit(next(fillers, "")) for i in range(definition.width)])


def _damaged(name: str, raw: DataFrame) -> dict[str, Column]:
    """The cells of a report as text, some of them damaged."""
    c = {f: F.col(f).cast("string") for _, f, _ in DEFINITIONS[name].fields}
    if name == "movements":
        c["quantity"] = F.when(F.col("quantity") == 13, F.lit("13 head")).otherwise(c["quantity"])
        c["weight"] = F.when(F.col("quantity") == 17, F.lit("99999999999")).otherwise(c["weight"])
        c["movement_date"] = F.when(F.col("quantity") == -19, F.lit("2001-02-30")).otherwise(c["movement_date"])
    elif name == "groups":
        c["close_date"] = F.when((F.col("status") == "closed") & (F.col("site") == "Site 2"), F.lit("open")).otherwise(c["close_date"])
    elif name == "carcass":
        c["avg_live_wt"] = F.when(F.col("quantity") == 29, F.lit("n/a")).otherwise(c["avg_live_wt"])
        c["tattoo"] = F.when(F.col("quantity") == 31, F.lit(" ")).otherwise(c["tattoo"])
    elif name == "loads":
        c["tattoo"] = F.when(F.col("tattoo") % 37 == 5, F.concat(F.lit("T"), F.col("tattoo").cast("string"))).otherwise(c["tattoo"])
    return c


def _cut(name: str) -> Column:
    """Records that lost their last cells."""
    if name == "groups":
        return F.col("site") == "Site 5"
    if name == "movements":
        return F.col("quantity") == 23
    return F.lit(False)


#: Reports with a row or more a line, whose date is that of the line.
OF_LINES = {"movements": td.movements_raw, "carcass": td.carcass, "deaths": td.deaths_raw}
DATES = {"movements": "movement_date", "groups": "open_date", "carcass": "kill_date", "loads": "kill_date", "deaths": "movement_date"}
#: Files that a task writes side by side; of more, Spark sorts the rest.
OPEN_FILES = 64


def report_records(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``(file, line)`` of the records of a report; those of a file are in one task."""
    month = lambda date: F.date_format(date, "yyyy-MM")
    if name in OF_LINES:
        placed = td.joined_lines(spark, sf_dir).repartition(month(F.col("l_shipdate").cast("date")))
        raw = OF_LINES[name](spark, sf_dir, joined=placed)
    else:
        raw = {"groups": td.groups, "loads": td.loads}[name](spark, sf_dir)
        raw = raw.repartition(month(DATES[name]))
    plain = {f.name for f in raw.schema.fields if not isinstance(f.dataType, T.StringType)}
    line = record_line(DEFINITIONS[name], _damaged(name, raw), plain)
    line = F.when(_cut(name), F.regexp_replace(line, r"(,[^,]*){3}$", "")).otherwise(line)
    return raw.select(F.concat(F.lit(f"{name}_"), month(DATES[name])).alias("file"), line.alias("line"))


def with_top(records: DataFrame, top: list[str]) -> DataFrame:
    """The records, and before the first of a file that a task meets the lines ``top``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = set()
        for batch in batches:
            for file in set(batch.column(0).unique().to_pylist()) - begun:
                begun.add(file)
                rows = [[file] * len(top), top]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, batch.schema)], schema=batch.schema)
            yield batch

    return records.mapInArrow(run, "file string, line string")


def write_reports(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Write the exports of ``names`` to the shared folder; returns the folder.  Files
    lie in ``file=<name>_<month>/``, compressed: cells that nobody wants repeat in every record."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/exports-{uuid.uuid4().hex}"
    before = spark.conf.get(SIDE_BY_SIDE)
    spark.conf.set(SIDE_BY_SIDE, str(OPEN_FILES))
    try:
        for name in names:
            d = DEFINITIONS[name]
            header = ",".join(dict((o, n) for o, n, _ in d.fields).get(i, f"col {i}") for i in range(d.width))
            top = [f"{name} report, row {i}" if i % 2 else "" for i in range(d.banner_rows)] + [header]
            (with_top(report_records(spark, sf_dir, name), top)
             .write.mode("append").partitionBy("file").option("compression", "gzip").text(root))
    finally:
        spark.conf.set(SIDE_BY_SIDE, before)
    return root


def files_of(root: str, definition: ReportDef) -> str:
    """Where the files of a report lie, as a glob."""
    return f"{root}/file={definition.token}_*"
