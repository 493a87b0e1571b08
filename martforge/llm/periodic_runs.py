"""Operator 13: periodic runs of words, found with an enhanced suffix array.

A run is a maximal stretch of words with a smallest period ``q`` that it holds
twice or more.  The suffixes of the texts of a block are sorted by prefix
doubling, with word numbers that no two texts share, so that no suffix is
compared beyond its own text.  From the sorted suffixes come the lengths of the
common prefixes of neighbours (LCP), and for each LCP entry the interval of
suffixes that share that depth, cut in two at the entry.  The suffixes of the
smaller side are tested against the other one: if ``i + depth`` or
``i - depth`` lies there (one look-up of the inverse suffix array), a square
begins that no rotation to the right continues.  Such squares are rotated to the
left as far as they go, which gives a run's first and last word; squares that
end up with the same words are one run, and its period is their smallest.

No tree is built, and every step is numpy over a block of texts: the smaller
sides hold at most ``n log n`` suffixes.  Texts are worked on in the tasks that
read them; nothing is shuffled, and a lost executor costs its own tasks only.
A single text has to fit a Python worker (some 150 bytes a word).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import importable, table

#: Shortest run, in words (fixed value of the contract).
MIN_LENGTH = 12
#: Words of a block of texts, and suffixes tested at once; both only bound memory.
BLOCK_WORDS = 1 << 17
TESTED = 1 << 20

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
_ARROW_RUNS = pa.list_(pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]))


class SuffixArray:
    """Sorted suffixes of a sequence of numbers, with their inverse and LCP."""

    def __init__(self, numbers: np.ndarray):
        n = self.n = len(numbers)
        self.order = np.argsort(numbers, kind="stable")
        #: By level ``l``: numbers that are equal where 2**l words are; the end has one of its own.
        self.levels: list[np.ndarray] = []
        heads = np.flatnonzero(np.diff(numbers[self.order], prepend=-1))
        rank = np.empty(n, np.int64)
        rank[self.order] = np.repeat(heads, np.diff(heads, append=n))
        open_ = self._shared(heads, np.arange(n), n)
        step = 1
        while len(open_):
            self.levels.append(np.append(rank, -1).astype(np.int32 if n < 2**31 else np.int64))
            suffix = self.order[open_]
            after = suffix + step
            key = rank[suffix] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            by = np.argsort(key, kind="stable")
            suffix, key = suffix[by], key[by]
            self.order[open_] = suffix
            heads = np.flatnonzero(np.diff(key, prepend=-1))
            rank[suffix] = np.repeat(open_[heads], np.diff(heads, append=len(open_)))
            open_ = self._shared(heads, open_, len(open_))
            step *= 2
        #: Place of each suffix; the end is nowhere.
        self.place = np.append(rank, -1)
        self.lcp = self._neighbours()

    @staticmethod
    def _shared(heads: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        """Places in groups of more than one."""
        sizes = np.diff(heads, append=n)
        return places[np.repeat(sizes > 1, sizes)]

    def _neighbours(self) -> np.ndarray:
        """``lcp[k]``: common words of the suffixes at ``k - 1`` and ``k``; 0 at both ends."""
        lcp = np.zeros(self.n + 1, np.int64)
        if self.levels:
            first = self.levels[0][self.order]
            at = np.flatnonzero(first[1:] == first[:-1]) + 1
            lcp[at] = self.common(self.order[at - 1], self.order[at])
        return lcp

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``."""
        long = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.levels))):
            ranks = self.levels[level]
            long += (ranks[a + long] == ranks[b + long]).astype(np.int64) << level
        return long

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common stretch that ends just before ``a`` and ``b`` (``a < b``)."""
        long = np.zeros(len(a), np.int64)
        for level in reversed(range(len(self.levels))):
            ranks, step = self.levels[level], 1 << level
            from_a, from_b = a - long - step, b - long - step
            same = (from_a >= 0) & (ranks[np.maximum(from_a, 0)] == ranks[np.maximum(from_b, 0)])
            long += same.astype(np.int64) << level
        return long

    def halves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each entry with a common prefix: the entry, and the bounds ``[low, high)``
        of the places around it whose suffixes share that prefix.

        Of entries of one interval with the same depth the first takes the others
        in its right side, so each pair of suffixes is parted at one entry."""
        lcp, n = self.lcp, self.n
        at = np.flatnonzero(lcp)
        if not len(at):
            return at, at, at
        gaps = np.diff(np.flatnonzero(lcp == 0))
        least = [lcp]
        while (1 << len(least)) <= gaps.max():
            step, last = 1 << (len(least) - 1), least[-1]
            wide = np.zeros_like(last)
            wide[: n + 1 - step] = np.minimum(last[: n + 1 - step], last[step:])
            least.append(wide)
        depth, left, right = lcp[at], np.zeros_like(at), np.zeros_like(at)
        for level in reversed(range(len(least))):
            step, m = 1 << level, least[level]
            left += (m[np.maximum(at - left - step, 0)] > depth) * step
            right += (m[np.minimum(at + 1 + right, n)] >= depth) * step
        return at, at - left - 1, at + 1 + right


def branching_squares(sa: SuffixArray) -> tuple[np.ndarray, np.ndarray]:
    """``(i, d)`` of each square of two times ``d`` words from ``i`` that cannot be
    rotated to the right."""
    at, low, high = sa.halves()
    if not len(at):
        return at, at
    left = at - low <= high - at
    begin, end = np.where(left, low, at), np.where(left, at, high)
    other_low, other_high = np.where(left, at, low), np.where(left, high, at)
    depth, until = sa.lcp[at], np.cumsum(end - begin)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    while done < len(at):
        before = until[done - 1] if done else 0
        to = max(done + 1, int(np.searchsorted(until, before + TESTED, side="right")))
        sizes = end[done:to] - begin[done:to]
        entry = np.repeat(np.arange(done, to), sizes)
        within = np.arange(len(entry)) - np.repeat(until[done:to] - sizes - before, sizes)
        i, d = sa.order[begin[entry] + within], depth[entry]
        for first, other in ((i, i + d), (i - d, i - d)):
            place = sa.place[np.maximum(other, 0)]
            hit = (other >= 0) & (place >= other_low[entry]) & (place < other_high[entry])
            found.append((first[hit], d[hit]))
        done = to
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(numbers: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows ``(start, end, period)`` of the runs of at least ``min_length``, by start and period."""
    if len(numbers) < 2:
        return np.zeros((0, 3), np.int64)
    sa = SuffixArray(numbers)
    i, d = branching_squares(sa)
    end = i + 2 * d
    start = i - sa.common_before(i, i + d)
    long = end - start >= min_length
    start, end, d = start[long], end[long], d[long]
    by = np.lexsort((d, end, start))
    start, end, d = start[by], end[by], d[by]
    new = np.ones(len(d), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    runs = np.stack([start[new], end[new], d[new]], axis=1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def block_runs(texts: Sequence[list[bytes]], min_length: int = MIN_LENGTH) -> Iterator[tuple[list[dict], list[bytes]]]:
    """For each text, given as words: its runs, and the words that no run repeats."""
    sizes = np.array([len(words) for words in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64, int(bounds[-1]))
    ids += np.repeat(np.arange(len(texts)) * len(number), sizes)  # of each text its own
    runs = runs_of(ids, min_length)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    repeated = np.cumsum(change) > 0
    of = np.searchsorted(runs[:, 0], bounds)
    for k, words in enumerate(texts):
        own = runs[of[k] : of[k + 1]]
        if not len(own):
            yield [], words
            continue
        rows = [{"start": int(s - bounds[k]), "length": int(e - s), "period": int(q)} for s, e, q in own]
        gone = repeated[bounds[k] : bounds[k + 1]]
        yield rows, [w for w, out in zip(words, gone) if not out]


def find_runs(
    docs: DataFrame,
    text_column: str = "text",
    min_length: int = MIN_LENGTH,
    prepare: Callable[[list[bytes], int | None], list[bytes]] | None = None,
    id_column: str = "doc_id",
) -> DataFrame:
    """``docs`` with ``runs`` (start, length and period of each run, by start, then
    period) and ``collapsed`` (the text without the words that a run repeats, joined
    by one space) in place of columns of these names.

    Words are stretches without ASCII white space; ``prepare(words, id)`` may change
    them first.  A null or empty text has no runs and collapses to the empty text;
    every row, repeated ones too, is judged by itself; an empty table gives no rows.
    """
    importable(docs.sparkSession)
    kept = docs.drop(*[c for c in ("runs", "collapsed") if c not in (text_column, id_column)])
    if len(kept.columns) != len(set(kept.columns)) or {"runs", "collapsed"} & {text_column, id_column}:
        raise ValueError("column names must differ, and the text may not be called runs or collapsed")
    at, name = kept.columns.index(text_column), kept.columns.index(id_column)
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = [], []
            block, size = [], 0

            def flush() -> None:
                for found, words in block_runs(block, min_length):
                    runs.append(found)
                    collapsed.append(b" ".join(words).decode("utf-8", "replace"))
                block.clear()

            texts = batch.column(at).cast(pa.binary())
            for text, key in zip(texts, batch.column(name)):
                words = (text.as_py() or b"").split()  # at ASCII white space alone
                if prepare is not None:
                    words = prepare(words, key.as_py())
                if block and size + len(words) > BLOCK_WORDS:
                    flush()
                    size = 0
                block.append(words)
                size += len(words)
            flush()
            added = [pa.array(runs, _ARROW_RUNS), pa.array(collapsed, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return kept.mapInArrow(search, schema)


def plant_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's words: in one of ten documents, by id, the words from some place
    on repeat a stretch; a document without an id stays as it is."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(docs, prepare=plant_period).drop("text")
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = found.withColumn("best", F.array_max(ranked))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.l) div (-best.p)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
