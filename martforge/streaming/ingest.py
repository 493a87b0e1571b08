"""Incremental pick-up of report exports with Structured Streaming.

The reference polls its download folder until a report file whose name
contains a token appears, then parses and loads it.  Here a file stream over
the landing folder does the watching: each new file is read once (the
stream's checkpoint remembers which files were processed), and every
micro-batch is handed to a loader that parses the files and replaces the
fact slice they cover.  ``trigger(availableNow=True)`` processes whatever
has landed and stops, which suits a scheduled run; a processing-time trigger
keeps it running.

A report may land as several part files (``orders_part0.csv``, ``orders_part1.csv``):
whichever batch a part comes with, the slice is rebuilt from all landed parts of
that report, so they have to stay in the landing folder until the last has come.
Another name is another report: a new export replaces the slice of an older one.

The stream checkpoint lives under the cluster's shared
``spark.checkpoint.dir`` unless a location is given.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martforge.session import ensure_checkpoint_dir
from martforge.sinks.tables import MonthTable, Slice

Loader = Callable[[DataFrame, int], None]

#: What makes a file name that of a part; the name without it is the report's.
PART = r"[_.-]part[-_]?\d+(?=(\.[^/]*)?$)"


def report_line_stream(spark: SparkSession, landing: str, *, name_token: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(file_path, value)``: one row per newly landed file, read whole."""
    r = spark.readStream.format("text").option("wholetext", "true")
    if name_token:
        r = r.option("pathGlobFilter", f"*{name_token}*")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing).select(F.col("_metadata.file_path").alias("file_path"), "value")


def to_lines(files: DataFrame) -> DataFrame:
    """``(file_path, line_no, line)`` of a batch of whole files (same shape as the batch reader)."""
    return files.select("file_path", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line")).filter(
        F.col("line") != "")


def with_landed_parts(lines: DataFrame) -> DataFrame:
    """``lines`` of a batch, and of all landed parts of the reports it has parts of.

    Only the batch's file names reach the driver.  A part that lands meanwhile
    is read now and, with the same result, again with its own batch."""
    paths = [r.file_path for r in lines.select("file_path").distinct().collect()]
    parts = [p for p in paths if re.search(PART, p)]
    if not parts:
        return lines
    reports = sorted({re.sub(PART, "", p) for p in parts})
    folders = sorted({unquote(p.rsplit("/", 1)[0]) for p in parts})
    path = F.col("_metadata.file_path")
    landed = (lines.sparkSession.read.format("text").option("wholetext", "true").load(folders)
              .filter(path.rlike(PART) & F.regexp_replace(path, PART, "").isin(*reports))
              .select(path.alias("file_path"), "value"))
    return lines.filter(~F.col("file_path").rlike(PART)).unionByName(to_lines(landed).select(*lines.columns))


def start_ingest(spark: SparkSession, landing: str, loader: Loader, *, name: str,
                 name_token: str | None = None, checkpoint: str | None = None,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; ``loader(lines, batch_id)`` runs once per micro-batch."""
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{name}"
    stream = report_line_stream(spark, landing, name_token=name_token)
    w = (stream.writeStream.queryName(f"ingest_{name}").option("checkpointLocation", ckpt)
         .foreachBatch(lambda batch, batch_id: loader(to_lines(batch), batch_id)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def slice_loader(store: MonthTable, parse: Callable[[DataFrame], DataFrame], pipeline: Callable[[DataFrame], DataFrame],
                 slice_of_batch: Callable[[DataFrame], Slice]) -> Loader:
    """Loader that parses a batch with all landed parts of its reports, runs a
    pipeline and replaces the slice it covers.

    ``slice_of_batch(facts)`` returns the slice of the batch, e.g. from the lookback
    start on; rows outside of it are not loaded.  A batch without lines changes nothing.
    """

    def load(lines: DataFrame, batch_id: int) -> None:
        if lines.isEmpty():
            return
        facts = pipeline(parse(with_landed_parts(lines)))
        part = slice_of_batch(facts)
        store.replace_slice(facts.filter(store.holds(part)), part)

    return load
