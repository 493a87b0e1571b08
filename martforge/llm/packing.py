"""Operator 2: vector bin packing of documents into training sequences.

An item has a demand vector: tokens, one segment, loss-bearing tokens.  A
sequence has a limit in each.  The dot-product heuristic fills one sequence at
a time with the item that fits and has the largest dot product of its demand
(as shares of the limits) with what is left of the sequence.

Whole multiples of the token limit are sequences of their own; only a
document's rest is an item.  Each task packs the documents it reads, in blocks,
so nothing is shuffled and memory is bounded by a block; sequences of a block
that are not full enough are opened again with the next block.  A gap that no
item fits is filled by cutting an item.  The last, unfinished sequence of a
task is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martforge.llm.common import importable, table
from martforge.llm.vocab import byte_bpe

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Limits:
    """Of a sequence.  ``loss``: tokens that bear loss; in a segment all but the
    first do, as nothing precedes it."""

    tokens: int = 1024
    segments: int = 128
    loss: int = 1023


@dataclass(frozen=True)
class Piece:
    """Tokens ``start`` to ``start + length`` of a document."""

    doc: object
    doc_tokens: int
    start: int
    ids: bytes

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.doc_tokens, self.start, self.ids[: 4 * n]),
            Piece(self.doc, self.doc_tokens, self.start + n, self.ids[4 * n :]),
        )


class Pool:
    """Items by length (items of one length have one demand vector)."""

    def __init__(self, limits: Limits) -> None:
        self.limits = limits
        self.items: dict[int, list[Piece]] = defaultdict(list)
        lengths = np.arange(limits.tokens + 1)
        self.demand = np.stack([lengths, np.ones_like(lengths), np.maximum(lengths - 1, 0)], axis=1).astype(float)
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self.share = self.demand / self.capacity
        self.count = np.zeros(limits.tokens + 1, dtype=np.int64)

    def add(self, piece: Piece) -> None:
        self.items[piece.length].append(piece)
        self.count[piece.length] += 1

    def take(self, length: int) -> Piece:
        self.count[length] -= 1
        return self.items[length].pop()

    def __len__(self) -> int:
        return int(self.count.sum())

    def best(self, left: np.ndarray) -> int:
        """Length of the fitting item with the largest dot product; 0: none fits."""
        top = int(min(left[0], left[2] + 1))
        if left[1] < 1 or top < 1:
            return 0
        there = np.flatnonzero(self.count[: top + 1])
        if not len(there):
            return 0
        return int(there[np.argmax(self.share[there] @ (left / self.capacity))])

    def fill(self, min_gap: int) -> list[Piece]:
        """One sequence."""
        left, out = self.capacity.copy(), []
        while length := self.best(left):
            out.append(self.take(length))
            left -= self.demand[length]
        gap = int(min(left[0], left[2] + 1))
        if gap >= min_gap and left[1] >= 1 and len(self):
            head, rest = self.take(int(np.flatnonzero(self.count)[-1])).cut(gap)
            out.append(head)
            self.add(rest)
        return out


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Cut the last sequence into sequences whose lengths are powers of two."""
    left, pieces = sum(p.length for p in pieces), pieces[::-1]
    while left:
        need = 1 << (left.bit_length() - 1)
        left -= need
        out = []
        while need:
            piece = pieces.pop()
            if piece.length > need:
                piece, rest = piece.cut(need)
                pieces.append(rest)
            out.append(piece)
            need -= piece.length
        yield out


def sequences(
    docs: Iterator[tuple[object, bytes]], limits: Limits, block: int, min_gap: int
) -> Iterator[list[Piece]]:
    """Sequences of (id, token ids) documents; bounded by ``block`` open items."""
    pool, whole = Pool(limits), min(limits.tokens, limits.loss + 1)
    for doc, ids in docs:
        n = len(ids) // 4
        full = n - n % whole
        for start in range(0, full, whole):
            yield [Piece(doc, n, start, ids[4 * start : 4 * (start + whole)])]
        if n > full:
            pool.add(Piece(doc, n, full, ids[4 * full :]))
        if len(pool) >= block:
            weak: list[Piece] = []
            while len(pool):
                out = pool.fill(min_gap)
                if not len(pool) and sum(p.length for p in out) < whole - min_gap:
                    weak = out
                else:
                    yield out
            for piece in weak:
                pool.add(piece)
    while len(pool):
        out = pool.fill(min_gap)
        if not len(pool) and sum(p.length for p in out) < limits.tokens:
            yield from powers_of_two(out)
        else:
            yield out


def pack_documents(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    limits: Limits = Limits(),
    block: int = 4096,
    min_gap: int = 24,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are not read) and return a row
    per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ids with ``with_ids``).

    A document is its ids and ``end_id``; a null or empty text is ``end_id``
    alone.  Null and repeated doc_ids are packed row by row.  An empty table
    gives no rows.  Files are read from ``json_path`` (and ``ranks_path``, the
    same vocabulary as ranks) on every worker.
    """
    importable(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    schema = T.StructType([*SCHEMA.fields, *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(json_path, ranks_path)
        number = TaskContext.get().partitionId() << 33

        def rows() -> Iterator[tuple[object, bytes]]:
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield doc, encoder.ids(text.as_py()) + end

        out: list[tuple] = []
        for pieces in sequences(rows(), limits, block, min_gap):
            offset = 0
            for p in pieces:
                row = (p.doc, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, number, offset)
                out.append((*row, p.ids) if with_ids else row)
                offset += p.length
            number += 1
            if len(out) >= 20_000:
                yield _batch(out, names, with_ids)
                out = []
        if out:
            yield _batch(out, names, with_ids)

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64()] * len(SCHEMA.names) + [pa.binary()] * with_ids
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def vocabulary() -> tuple[str, str]:
    """Places of the public byte-level vocabulary: json file and rank file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), *vocabulary())
