"""Operator 5: token counts of whole texts by counting each distinct pre-token once.

A text's pieces never cross from a character to a following space mark or to a
following line feed (no piece of the model does, which is checked when the
model is loaded), so the text falls into pre-tokens whose counts add up:

1. every distinct pre-token with its frequency (combined per task, then grouped);
2. the model counts the pieces of each distinct pre-token once;
3. the per-document pre-token frequencies are joined to these counts and summed.

The most frequent pre-tokens are joined through a broadcast of a fixed number of
entries inside the tasks; all others, whatever their number, by a shuffled join.
No list of ids is ever built for a document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import importable, table, write_shared

#: The mark that the model's normaliser puts for a space (fixed value).
MARK = "▁"
#: A pre-token: a run of marks or one line feed, and what follows up to the next.
PRE_TOKEN = re.compile("▁+[^▁\n]*|\n[^▁\n]*")
#: Entries of the broadcast of frequent pre-tokens, and their longest length: at
#: most some 30 MB on an executor.
HOT_ENTRIES = 300_000
HOT_CHARS = 32
#: Distinct pre-tokens that a task gathers before it hands them on.
GATHER = 400_000


def pre_tokens(text: str | None) -> list[str]:
    """The pre-tokens of a text; joined they give the text as the model sees it."""
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


@lru_cache(maxsize=2)
def model(path: str):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(m.get_piece_size()):
        piece = m.id_to_piece(i)
        if "\n" in piece or MARK in piece.lstrip(MARK):
            raise ValueError(f"{path}: piece {piece!r} crosses a pre-token boundary")
    if m.normalize("a  bÅ① ") != MARK + "a" + MARK * 2 + "bÅ①" + MARK:
        raise ValueError(f"{path}: its normaliser changes more than spaces")
    return m


def count_pieces(path: str, units: list[str]) -> list[int]:
    """Pieces of each pre-token.  The model puts a mark before any text: it
    stands for the first mark of a pre-token, or is taken off again."""
    m = model(path)
    bodies = [u if u[0] == "\n" else u[1:] for u in units]
    return [
        n - 1 if u[0] == "\n" else n or 1
        for u, n in zip(units, map(len, m.encode(bodies, num_threads=1)))
    ]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, n): the pre-tokens of a task's texts."""
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["unit", "n"]
        )

    for batch in batches:
        for text in batch.column(0):
            seen.update(pre_tokens(text.as_py()))
            if len(seen) >= GATHER:
                yield out()
                seen.clear()
    if seen:
        yield out()


def piece_counts(texts: DataFrame, model_path: str) -> DataFrame:
    """(unit, n, pieces) of every distinct pre-token of the column ``text``."""
    importable(texts.sparkSession)
    distinct = (
        texts.select("text").mapInArrow(_frequencies, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = count_pieces(model_path, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], ["unit", "n", "pieces"])

    return distinct.mapInArrow(count, "unit string, n long, pieces long")


def frequent(counts: DataFrame, entries: int) -> dict[str, int]:
    """Pieces of the most frequent pre-tokens, ``entries`` at most.

    A histogram of the logarithm of the frequency gives the least frequency with
    which they are few enough, so that no more rows than that are collected.
    """
    short = counts.where(F.length("unit") <= HOT_CHARS).withColumn("level", F.floor(8 * F.log2(F.col("n").cast("double"))))
    least, held = None, 0
    for r in sorted(short.groupBy("level").count().collect(), reverse=True):
        held += r["count"]
        if held > entries:
            break
        least = r.level
    if least is None:
        return {}
    return {r.unit: r.pieces for r in short.where(F.col("level") >= least).select("unit", "pieces").collect()}


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    hot_entries: int = HOT_ENTRIES,
) -> DataFrame:
    """Return (id, n_bytes, n_tokens) for every row of ``docs``.

    A null text is empty: 0 bytes, 0 tokens.  Null and repeated ids, repeated
    texts and any further columns do not matter: rows are told apart by their
    place, and only the two columns are read.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    importable(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    counts = write_shared(piece_counts(texts, model_path), "piece-counts")
    hot = spark.sparkContext.broadcast(frequent(counts, hot_entries))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per row of the table one row with the pieces of its frequent
        pre-tokens, and a row for each of the others with its frequency."""
        known = hot.value
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[list] = [[], [], [], [], []]
                for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                    text = text.as_py()
                    done, rest = 0, {}
                    for unit, n in Counter(pre_tokens(text)).items():
                        pieces = known.get(unit)
                        if pieces is None:
                            rest[unit] = n
                        else:
                            done += n * pieces
                    # No pre-token holds both of these: the row meets no count.
                    line = [uid, key, len(text.encode()) if text else 0, f"\n{MARK}{uid}", done]
                    for column, value in zip(rows, line):
                        column.append(value)
                    rows[0] += [uid] * len(rest)
                    rows[1] += [None] * len(rest)
                    rows[2] += [None] * len(rest)
                    rows[3] += rest
                    rows[4] += rest.values()
                    uid += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(rows, _SPLIT)], ["uid", "id", "n_bytes", "unit", "n"]
                )

    parts = texts.mapInArrow(split, "uid long, id long, n_bytes long, unit string, n long")
    joined = parts.join(counts.select("unit", "pieces"), "unit", "left")
    return (
        joined.groupBy("uid")
        .agg(
            F.max("id").alias("id"),
            F.max("n_bytes").alias("n_bytes"),
            F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"),
        )
        .select(F.col("id").alias(id_column), "n_bytes", "n_tokens")
    )


_SPLIT = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text of ``documents``; over the limit above 4096."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    out = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > 4096)
