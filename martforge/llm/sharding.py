"""Operator 8: sharding by proportional stratified interleaving.

Rows of each stratum (``source``) are put in a seeded random order and ranked;
row ``r`` of a stratum of ``n`` gets the fractional rank ``(2r + 1) / 2n``.
Sorting the whole table by fractional rank interleaves the strata in
proportion, so any contiguous cut has the mixture of the table.  The order is
cut into shards whose row counts differ by one at most (law ``rows``).

Both orders are range-partitioned sorts of slim rows (no text moves) followed
by per-partition offsets, so a stratum with a third of all rows is spread over
many tasks and no window runs over a whole stratum or table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.llm.common import table, write_shared

#: Size of a row besides its text, in bytes (fixed value, given by the contract).
ROW_OVERHEAD = 16

_POS_BITS = (1 << 33) - 1


def ranked(df: DataFrame, order: list[str], group: str | None, out: str, label: str) -> DataFrame:
    """Add ``out``: the exact 0-based rank of each row in ``order`` (per ``group``
    if given, which then has to lead ``order``).

    A range-partitioned sort is written once; a row's rank is its position in
    its partition plus the rows of its group in earlier partitions.
    """
    taken = [c for c in ("_part", "_pos") if c in df.columns]
    if taken:
        raise ValueError(f"reserved columns: {taken}")
    laid = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_BITS)))
    )
    laid = write_shared(laid, label)
    keys = ["_part"] + ([group] if group else [])
    runs = laid.groupBy(*keys).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per partition and group: the window is over partitions, not rows.
    before = Window.partitionBy(*([group] if group else [])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    same = F.col("l._part") == F.col("r._part")
    if group:
        same = same & F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}"))
    return (
        laid.alias("l")
        .join(runs.alias("r"), same)
        .select(
            *[F.col(f"l.{c}") for c in df.columns],
            (F.col("l._pos") - F.col("r._first") + F.col("r._before")).alias(out),
        )
    )


def interleaved_shards(
    df: DataFrame,
    n_shards: int,
    stratum: str = "source",
    tie_break: list[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """Return the rows of ``df`` with ``shard`` (int) and ``slot`` (long).

    ``tie_break`` columns (default: all) seed the shuffle and settle the order;
    rows equal in all of them are interchangeable.  A null stratum is a stratum
    of its own.  An empty table gives an empty result.  Shards differ by one
    row at most; ``slot`` runs without gaps from 0 in every shard.  Columns
    named like the results (``shard``, ``slot``) are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 at least")
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    ties = tie_break or keep
    rows = df.select(*keep).withColumn("_mix", F.xxhash64(F.lit(seed), *[F.col(c) for c in ties]))
    per = rows.groupBy(F.col(stratum).alias("_s")).agg(F.count(F.lit(1)).alias("_size"))
    by_source = ranked(rows, [stratum, "_mix", *ties], stratum, "_rank", "by-stratum")
    # One count per stratum, from a partial aggregation; the join's hot side is
    # split by AQE or met by a broadcast of the measured counts.
    placed = by_source.join(per, F.col(stratum).eqNullSafe(F.col("_s"))).withColumn(
        "_frac", (2 * F.col("_rank") + 1) / (2 * F.col("_size"))
    )
    total = rows.agg(F.count(F.lit(1))).first()[0]
    order = ["_frac", "_mix", *([] if stratum in ties else [stratum]), *ties]
    out = ranked(placed.drop("_s", "_size", "_rank"), list(dict.fromkeys(order)), None, "_global", "by-fraction")
    return cut(out, n_shards, total).select(*keep, "shard", "slot")


def cut(df: DataFrame, n_shards: int, total: int) -> DataFrame:
    """Cut the global order ``_global`` of ``total`` rows into ``n_shards`` runs;
    the first ``total % n_shards`` shards hold one row more."""
    base, more = divmod(total, n_shards)
    g: Column = F.col("_global")
    wide = F.lit(more * (base + 1)).cast("long")
    in_wide = g < wide
    shard = F.when(in_wide, F.expr(f"_global div {base + 1}")).otherwise(
        F.lit(more) + F.expr(f"(_global - {more * (base + 1)}) div {max(base, 1)}")
    )
    slot = F.when(in_wide, g % F.lit(base + 1)).otherwise((g - wide) % F.lit(max(base, 1)))
    return df.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))


def write_shards(df: DataFrame, path: str) -> None:
    """Write sharded rows to ``path/shard=K/``, in slot order inside a shard."""
    (
        df.repartition("shard")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .mode("errorifexists")
        .parquet(path)
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 39 under the law ``rows``."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    docs = write_shared(docs, "op8-rows")
    out = interleaved_shards(docs, 40, "source", ["doc_id", "text_crc32", "size"], seed=8)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
