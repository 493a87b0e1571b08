"""Operator 3: benchmark decontamination by latent semantic retrieval.

1. Words of all documents are hashed to ``BUCKETS`` terms; their frequencies
   are counted over all texts (one pass, combined per task).
2. A randomised SVD of TF-IDF passages gives a latent space.  It is fitted on every
   passage of every document and of the benchmark: passages are added up with random
   signs into a bounded number of rows, whose products are on average those of all
   passages.  The products with these rows run as Spark jobs, and only
   the small orthogonalisations (``BUCKETS`` x ``RANK``, by chunks of rows) on the driver.
   Coordinates are divided by the singular values, so that what all texts of a
   language share does not make every pair similar.
3. Overlapping windows over the whole of every document are projected and
   compared with the benchmark's query vectors, in blocks of queries of a fixed
   size; nothing is shuffled.
4. Texts that share enough words with an item are candidates whatever their
   cosine: a match has so many of the item's words that some of its rarest ones
   must be near each other.  So the least cosine loses no match.
5. A candidate counts if a longest common subsequence holds enough of the item's
   words, or fewer of them and the item's answer: then it is a paraphrase.  An item
   of fewer than ``MIN_ITEM_WORDS`` words counts where all its words stand in a row.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import importable, table, write_shared

#: Terms, latent dimensions, extra dimensions of the range finder, iterations.
BUCKETS = 1 << 15
RANK = 96
EXTRA = 16
POWER = 2
#: Rows that the passages of the documents, and of the benchmark, are added up into
#: (and one more a task), rows of a task, and rows that are multiplied together.
SKETCH_ROWS = 16_384
BENCHMARK_ROWS = 8_192
TASK_ROWS = 4_096
BLOCK_ROWS = 64
#: Rows of a product that are added up together (230 kB a task at most).
SUM_ROWS = 512
#: Words of a block; short windows have 2 blocks, long ones 4.
BLOCK = 8
PASSAGE = 4 * BLOCK
SHORT_ITEM = 24
QUERY_WORDS = 56
#: Query vectors that are broadcast at a time (some 3 MB).
QUERY_BLOCK = 8_192
#: Least cosine of a candidate, shares of an item's words, words of an answer,
#: and words from which on an item may be paraphrased (shorter ones are found word by word).
MIN_COSINE = 0.40
MIN_LCS = 0.8
MIN_LCS_WITH_ANSWER = 0.6
ANSWER_WORDS = 6
MIN_ITEM_WORDS = 8
#: Share of a match's words that have to be among an item's rarest, and shared
#: words, or words around candidates, that are looked at together (some 30 MB).
RARE_SHARE = 0.35
SHARED_WORDS = 1 << 19

_DROP = {ord(c): None for c in ".,;:!?\"'()[]{}#*$%&|<>«»“”‘’¿¡…"}
_ANSWER = re.compile(r"(?:^|\s)(?:answer|a|solution)\s*:\s*(.+)\Z", re.IGNORECASE | re.DOTALL)
#: Bytes that do not count in a word, and factors of a polynomial hash.
_KEEP = np.ones(256, dtype=np.int32)
_KEEP[[c for c in _DROP if c < 128]] = 0
_KEEP_NOT = [chr(c).encode() for c in _DROP if c >= 128]
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, dtype=np.uint64), dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def plain_words(words: list[str]) -> list[str]:
    """Words without punctuation."""
    return " ".join(words).translate(_DROP).split()


def words_of(text: str | None) -> list[str]:
    return plain_words((text or "").lower().split())


def split_words(texts: pa.Array) -> pa.Array:
    """The lower-case words of each text, with their punctuation."""
    return pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))


def hash_words(words: pa.StringArray) -> np.ndarray:
    """Term of each word: a hash of its bytes without punctuation, computed over
    all words at once; ``BUCKETS`` for a word of punctuation alone."""
    if not len(words):
        return np.zeros(0, dtype=np.int32)
    wide = pa.types.is_large_string(words.type)
    at = np.frombuffer(words.buffers()[1], np.int64 if wide else np.int32)[words.offset : words.offset + len(words) + 1]
    raw = words.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, np.uint8)
    starts, lengths = at[:-1] - at[0], np.diff(at)
    keep = _KEEP[data]
    for lead in {c[0] for c in _KEEP_NOT}:
        at_lead = np.flatnonzero(data == lead)
        for c in (c for c in _KEEP_NOT if c[0] == lead) if len(at_lead) else ():
            found = at_lead[np.all([data[at_lead + i] == c[i] for i in range(1, len(c))], axis=0)]
            for i in range(len(c)):
                keep[found + i] = 0
    before = np.concatenate([[0], np.cumsum(keep, dtype=np.int32)])
    place = before[:-1] - np.repeat(before[starts], lengths)
    parts = (data + np.uint64(1)) * _POWERS[place & 4095] * keep.astype(np.uint64)
    sums = np.add.reduceat(np.append(parts, np.uint64(0)), starts)
    terms = ((sums * _MIX) >> np.uint64(40)).astype(np.int32) % BUCKETS
    terms[before[starts + lengths] == before[starts]] = BUCKETS
    return terms


def terms_of(words: list[str]) -> np.ndarray:
    return hash_words(pa.array(words, pa.string()))


def batch_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all texts in a row, and where each text's begin (and the end)."""
    lists = split_words(texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return hash_words(lists.flatten()), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def in_passages(terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The terms in rows of ``PASSAGE``: a text begins a row and is filled up with ``BUCKETS``."""
    n = np.diff(starts)
    first = np.concatenate([[0], np.cumsum(-(-n // PASSAGE))])
    laid = np.full(int(first[-1]) * PASSAGE, BUCKETS, dtype=np.int32)
    laid[np.arange(len(terms)) + np.repeat(first[:-1] * PASSAGE - starts[:-1], n)] = terms
    return laid.reshape(-1, PASSAGE)


def weigh(passages: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, weight) of the distinct terms of each passage (a row): TF-IDF, each
    passage of length 1."""
    ordered = np.sort(passages, axis=1)
    new = np.ones(ordered.shape, bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    at = np.flatnonzero(new)
    ids, n = ordered.ravel()[at], np.diff(np.append(at, ordered.size))
    real = ids < BUCKETS
    ids, n, passage = ids[real], n[real], at[real] // ordered.shape[1]
    w = n * idf[ids]
    length = np.sqrt(np.bincount(passage, w * w, minlength=len(passages)))
    return passage, ids, w / np.maximum(length, 1e-12)[passage]


_CORPUS = "kind string, bucket long, n long, key long, terms binary"
_CORPUS_NAMES = ["kind", "bucket", "n", "key", "terms"]


def _passages(terms: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """A row of all passages of some texts; ``n`` is their number."""
    laid = in_passages(terms, starts)
    raw = laid.astype("<u2").tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array(["p"]), pa.nulls(1, pa.int64()), pa.array([len(laid)]), pa.array([zlib.crc32(raw)]), pa.array([raw], pa.binary())], _CORPUS_NAMES)


def corpus_terms(docs: DataFrame) -> DataFrame:
    """One pass over ``docs`` (id, text): rows (kind, bucket, n) of term frequencies,
    and (kind, n, key, terms) of all passages of some texts."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for _, texts in _slices(batch.column(1)):
                terms, starts = batch_terms(texts)
                frequency += np.bincount(terms, minlength=BUCKETS + 1)
                if len(terms):
                    yield _passages(terms, starts)
        at = np.flatnonzero(frequency[:BUCKETS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(["t"] * len(at), pa.string()), pa.array(at), pa.array(frequency[at]), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary())],
            _CORPUS_NAMES,
        )

    return docs.mapInArrow(run, _CORPUS)


def signed_sums(rows: Iterator[tuple[int, bytes]], idf: np.ndarray, together: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, weights) of sums of ``together`` passages, each with a random sign, over the
    root of their number; ``rows`` are (key, passages).  Products of two passages cancel on
    average, so products of the sums are those of the passages."""
    total, held = np.zeros(BUCKETS), 0

    def ended() -> tuple[np.ndarray, np.ndarray]:
        ids = np.flatnonzero(total)
        return ids, (total[ids] / math.sqrt(together)).astype(np.float32)

    for key, raw in rows:
        passages = np.frombuffer(raw, "<u2").reshape(-1, PASSAGE).astype(np.int32)
        sign = np.random.default_rng(key).choice([-1.0, 1.0], len(passages))
        for i in range(0, len(passages), 4096):
            passage, ids, w = weigh(passages[i : i + 4096], idf)
            w = w * sign[i + passage]
            low, end = 0, min(len(passages) - i, 4096)
            while low < end:
                high = min(end, low + together - held)
                a, b = np.searchsorted(passage, [low, high])
                np.add.at(total, ids[a:b], w[a:b])
                held += high - low
                low = high
                if held == together:
                    yield ended()
                    total[:] = 0
                    held = 0
    if held:
        yield ended()


def sketch(corpus: DataFrame, idf: np.ndarray, most: int) -> DataFrame:
    """(terms, weights): all passages of ``corpus``, added up into ``most`` rows, and one
    more a task."""
    passages = corpus.where("kind = 'p'").select("key", "terms", "n")
    together = -(-(passages.agg(F.sum("n")).first()[0] or 0) // most)
    shared = corpus.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, t) for batch in batches for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for ids, w in signed_sums(rows, shared.value, together):
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids.astype("<u2").tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], ["terms", "weights"])

    return passages.mapInArrow(run, "terms binary, weights binary")


def inverse_frequencies(corpus: DataFrame) -> np.ndarray:
    """Logarithm of the inverse frequency of each term in all texts: at most
    ``BUCKETS`` sums reach the driver."""
    frequency = np.zeros(BUCKETS)
    for r in corpus.where("kind = 't'").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        frequency[r.bucket] = r.n
    return (np.log((1 + frequency.sum()) / (1 + frequency))).astype(np.float32)


def filled_rows(total: np.ndarray, chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of each chunk of a matrix that are not all zero, after their places in it."""
    for i in range(0, len(total), chunk):
        places = np.flatnonzero(total[i : i + chunk].any(axis=1)).astype("<i4")
        yield places, total[i + places]


def _products(spark: SparkSession, sample: DataFrame, idf: np.ndarray, q: np.ndarray, gram: bool) -> list[np.ndarray]:
    """Over all rows of ``sample``: A^T (A q) in chunks of rows, or (A q)^T (A q) with ``gram``.

    Partial sums of the tasks are added by chunks of rows in Spark.  A task gives
    only the rows that it has terms of, so what is shuffled is bounded by
    the sample, into however many tasks it is dealt."""
    shared = spark.sparkContext.broadcast(q)
    width, chunk = q.shape[1], q.shape[1] if gram else SUM_ROWS
    kinds = "chunk int, places binary, part binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        total = np.zeros((width if gram else BUCKETS, width), dtype=np.float32)
        rows = ((np.frombuffer(t, "<u2"), np.frombuffer(w, np.float32)) for batch in batches for t, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for block in itertools.batched(rows, BLOCK_ROWS):
            has = np.zeros(BUCKETS, bool)
            for ids, _ in block:
                has[ids] = True
            terms, place = np.flatnonzero(has), np.cumsum(has) - 1
            a = np.zeros((len(block), len(terms)), np.float32)
            for row, (ids, w) in zip(a, block):
                row[place[ids]] = w
            y = a @ q[terms]
            if gram:
                total += y.T @ y
            else:
                total[terms] += a.T @ y
        for i, (places, part) in enumerate(filled_rows(total, chunk)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([places.tobytes()], pa.binary()), pa.array([part.tobytes()], pa.binary())],
                ["chunk", "places", "part"],
            )

    def add(key: tuple, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((chunk, width), dtype=np.float32)
        for frame in rows:
            for places, part in zip(frame["places"], frame["part"]):
                total[np.frombuffer(places, "<i4")] += np.frombuffer(part, np.float32).reshape(-1, width)
        yield pd.DataFrame({"chunk": [key[0]], "part": [total.tobytes()]})

    summed = sample.select("terms", "weights").mapInArrow(run, kinds).groupBy("chunk").applyInPandas(add, "chunk int, part binary")
    rows = sorted(summed.collect(), key=lambda r: r.chunk)
    shared.destroy()  # its files on driver and executors are large
    return [np.frombuffer(r.part, np.float32).reshape(-1, width) for r in rows]


def orthonormal(chunks: list[np.ndarray], out: np.ndarray) -> None:
    """Write to ``out`` an orthonormal basis of what the columns of ``chunks`` span; columns
    beyond their rank are zero.  Beside the chunks and ``out`` only squares of the width are
    held: a QR of the whole matrix would need several copies of it."""
    for source in (chunks, [out]):  # the second time settles what the first one rounds off
        gram = sum(c[i : i + SUM_ROWS].T.astype(np.float64) @ c[i : i + SUM_ROWS] for c in source for i in range(0, len(c), SUM_ROWS))
        values, vectors = np.linalg.eigh(gram)
        usable = values > 1e-12 * max(float(values[-1]), 1e-30)
        turn = vectors * np.where(usable, 1 / np.sqrt(np.where(usable, values, 1)), 0)
        at = 0
        for c in source:
            for i in range(0, len(c), SUM_ROWS):
                part = c[i : i + SUM_ROWS]
                out[at : at + len(part)] = part @ turn
                at += len(part)


def latent_space(spark: SparkSession, sample: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 3) -> np.ndarray:
    """(BUCKETS + 1) x rank: what a term adds to a window's coordinates; the last
    row, of no term, is zero.  Randomised SVD of the sample's passages."""
    width, random = rank + EXTRA, np.random.default_rng(seed)
    q = np.empty((BUCKETS, width), np.float32)
    for i in range(0, BUCKETS, SUM_ROWS):
        q[i : i + SUM_ROWS] = random.standard_normal((SUM_ROWS, width))
    for _ in range(POWER):
        orthonormal(_products(spark, sample, idf, q, gram=False), q)
    values, vectors = np.linalg.eigh(_products(spark, sample, idf, q, gram=True)[0].astype(np.float64))
    top = np.argsort(values)[::-1][:rank]
    scale = np.sqrt(np.maximum(values[top], 1e-9))
    usable = values[top] > 1e-6 * max(float(values[top][0]), 1e-12)
    turn = vectors[:, top] * np.where(usable, 1 / scale, 0)
    space = np.zeros((BUCKETS + 1, rank), np.float32)
    for i in range(0, BUCKETS, SUM_ROWS):
        space[i : i + SUM_ROWS] = (q[i : i + SUM_ROWS] @ turn).astype(np.float32) * idf[i : i + SUM_ROWS, None]
    return space


@dataclass(frozen=True)
class Item:
    """A benchmark item: its words and those of its answer."""

    item_id: int
    words: tuple[str, ...]
    answer: tuple[str, ...]

    def masks(self) -> dict[int, int]:
        """Term -> the places of its words in the item, as bits."""
        out: dict[int, int] = {}
        for i, t in enumerate(terms_of(list(self.words)).tolist()):
            out[t] = out.get(t, 0) | 1 << i
        return out


def make_item(item_id: int, text: str | None) -> Item:
    """The answer is what follows ``Answer:``, else the last words of the item."""
    words = words_of(text)
    told = _ANSWER.search(text or "")
    answer = words_of(told[1]) if told else []
    return Item(item_id, tuple(words), tuple(answer or words[-ANSWER_WORDS:]))


def common_words(masks: dict, n: int, region: list) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    full = (1 << n) - 1
    row = full
    for w in region:
        hit = row & masks.get(w, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return n - row.bit_count()


def has_run(region: list[str], run: tuple[str, ...]) -> bool:
    n = len(run)
    return any(region[i] == run[0] and tuple(region[i : i + n]) == run for i in range(len(region) - n + 1))


def query_vectors(items: list[Item], space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, item of each, whether it is compared with short windows)."""
    vectors, of, short = [], [], []
    for k, item in enumerate(items):
        terms = terms_of(list(item.words))
        last = max(len(terms) - QUERY_WORDS, 0)
        for at in sorted({*range(0, last, QUERY_WORDS // 2), last}):
            part = terms[at : at + QUERY_WORDS]
            vectors.append(space[part].sum(axis=0))
            of.append(k)
            short.append(len(part) <= SHORT_ITEM)
    return _unit(np.array(vectors, dtype=np.float32).reshape(-1, space.shape[1])), np.array(of, int), np.array(short, bool)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-9)[:, None]


class Search:
    """Finds items in documents, many documents at a time."""

    def __init__(self, items: list[Item], space: np.ndarray, idf: np.ndarray) -> None:
        self.items, self.space = [i for i in items if len(i.words) >= MIN_ITEM_WORDS], space
        self._list_short([i for i in items if 0 < len(i.words) < MIN_ITEM_WORDS])
        items = self.items
        self.masks = [i.masks() for i in items]
        self._index(idf)
        self._list_terms()
        vectors, of, short = query_vectors(items, space)
        self.sides = [
            (step, vectors[which].T.copy(), of[which]) for step, which in ((1, short), (2, ~short)) if which.any()
        ]

    def _index(self, idf: np.ndarray) -> None:
        """Items by their rarest terms.

        A match has ``least`` of an item's n words, so of any n - least + m of
        them it has m: the rarest are listed, and m near each other are asked."""
        pairs = []
        self.rare = np.empty(len(self.items), dtype=np.int64)
        for k, item in enumerate(self.items):
            n = len(item.words)
            least = math.ceil(MIN_LCS_WITH_ANSWER * n)
            self.rare[k] = m = max(1, int(RARE_SHARE * least))
            terms = terms_of(list(item.words))
            rarest = terms[np.argsort(-idf[terms], kind="stable")[: n - least + m]]
            pairs += [(t, k) for t in set(rarest.tolist())]
        listed = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.listed = listed[:, 1]
        self.list_at = np.searchsorted(listed[:, 0], np.arange(BUCKETS + 2))
        self.lengths = np.array([len(i.words) for i in self.items], dtype=np.int64)

    def _list_short(self, items: list[Item]) -> None:
        """Items that are sought word by word: by their length, by a number of their terms."""
        self.short: dict[int, dict[int, list[Item]]] = {}
        for item in items:
            number = int(self._numbers(terms_of(list(item.words)), len(item.words))[0])
            self.short.setdefault(len(item.words), {}).setdefault(number, []).append(item)

    @staticmethod
    def _numbers(terms: np.ndarray, n: int) -> np.ndarray:
        """A number of each ``n`` terms in a row; different ones may share it, so words are compared."""
        out = np.zeros(max(len(terms) - n + 1, 0), np.uint64)
        for i in range(n):
            out = out * _MIX + terms[i : len(terms) - n + 1 + i].astype(np.uint64) + np.uint64(1)
        return out

    def whole(self, texts: pa.Array, terms: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
        """As ``hits``, of the short items: the first place where their words stand in a row."""
        said = np.flatnonzero(terms < BUCKETS)
        doc = np.searchsorted(starts, said, side="right") - 1
        words: dict[int, list[str]] = {}
        for n, known in self.short.items():
            numbers = self._numbers(terms[said], n)
            at = np.flatnonzero(np.isin(numbers, np.array(list(known), np.uint64)) & (doc[: len(numbers)] == doc[n - 1 :]))
            found = set()
            for i, d in zip(at.tolist(), doc[at].tolist()):
                for item in known[int(numbers[i])]:
                    if (d, id(item)) in found:
                        continue
                    if d not in words:
                        words[d] = split_words(texts.slice(d, 1))[0].as_py()
                    begin, end = int(said[i] - starts[d]), int(said[i + n - 1] - starts[d]) + 1
                    if tuple(plain_words(words[d][begin:end])) == item.words:
                        found.add((d, id(item)))
                        same = _unit(self.space[terms[said[i : i + n]]].sum(axis=0)[None])[0]
                        yield d, item.item_id, float(same @ same), n, n, has_run(list(item.words), item.answer), begin

    def _list_terms(self) -> None:
        """Which terms each item has, as bits, and how often."""
        self.has = np.zeros((len(self.items), BUCKETS // 8 + 1), dtype=np.uint8)
        keys, times = [], []
        for k, masks in enumerate(self.masks):
            for t, places in sorted(masks.items()):
                self.has[k, t >> 3] |= 1 << (t & 7)
                keys.append(k * (BUCKETS + 1) + t)
                times.append(places.bit_count())
        self.term_keys, self.times = np.array(keys, np.int64), np.array(times, np.int64)

    def may_hold(self, terms: np.ndarray, starts: np.ndarray, doc: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Whether the surroundings of each candidate (document, first word of the window,
        item) have enough of the item's words, in any order."""
        n = self.lengths[k]
        low = starts[doc] + np.maximum(at - n, 0)
        sizes = np.maximum(np.minimum(starts[doc] + at + PASSAGE + n, starts[doc + 1]) - low, 0)
        which = np.repeat(np.arange(len(doc)), sizes)
        near = terms[np.arange(len(which)) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)]
        item = k[which]
        listed = np.flatnonzero(self.has[item, near >> 3] >> (near & 7).astype(np.uint8) & 1)
        which, near, item = which[listed], near[listed], item[listed]
        enough = np.bincount(which, minlength=len(doc)) >= MIN_LCS_WITH_ANSWER * n
        some = enough[which]
        # A word counts as often as both have it.
        keys, found = np.unique(which[some] * (BUCKETS + 1) + near[some], return_counts=True)
        which, near = keys // (BUCKETS + 1), keys % (BUCKETS + 1)
        times = self.times[np.searchsorted(self.term_keys, k[which] * (BUCKETS + 1) + near)]
        return np.bincount(which, np.minimum(found, times), minlength=len(doc)) >= MIN_LCS_WITH_ANSWER * n

    def near_enough(self, terms: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
        """The candidates, each once, that ``may_hold`` an item."""
        size = max(1, SHARED_WORDS // (PASSAGE + 2 * int(self.lengths.max(initial=1))))
        seen = set()
        for some in itertools.batched(itertools.chain(self.candidates(terms, starts), self.sharing(terms, starts)), size):
            doc, at, k = (np.array(x, np.int64) for x in list(zip(*some))[:3])
            for i in np.flatnonzero(self.may_hold(terms, starts, doc, at, k)).tolist():
                if some[i][:3] not in seen:
                    seen.add(some[i][:3])
                    yield some[i]

    def sharing(self, terms: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, None]]:
        """As ``candidates``, of every item that some stretch of a document
        (``PASSAGE`` words and an item's length on both sides) may match."""
        spans = PASSAGE + 2 * self.lengths
        gap = int(spans.max()) + PASSAGE
        # Words are numbered so that those of two documents are never near.
        doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        number = np.arange(len(terms)) + doc * gap
        begins = starts[:-1] + np.arange(len(starts) - 1) * gap
        wide = int(number[-1]) + 2 * gap if len(terms) else 0
        counts = self.list_at[terms + 1] - self.list_at[terms]
        total = np.concatenate([[0], np.cumsum(counts)])
        low = 0
        while low < len(terms):
            high = max(low + gap, int(np.searchsorted(total, total[low] + SHARED_WORDS, side="right")) - 1)
            # What begins in the last words of this part is found with the next.
            end = min(high + gap, len(terms))
            n = counts[low:end]
            at = np.repeat(np.arange(low, end), n)
            item = self.listed[np.arange(len(at)) + np.repeat(self.list_at[terms[low:end]] - (total[low:end] - total[low]), n)]
            keys = np.sort(item * wide + number[at])
            item, place = keys // wide, keys % wide
            last = np.arange(len(keys)) + self.rare[item] - 1
            near = np.flatnonzero(last < len(keys))
            near = near[keys[last[near]] - keys[near] < spans[item[near]]]
            item, place, until = item[near], place[near], place[last[near]]
            d = np.searchsorted(begins, place, side="right") - 1
            # Windows whose surroundings hold these words.
            n, place, until = self.lengths[item], place - begins[d], until - begins[d]
            first = np.maximum(-(-(until - PASSAGE - n + 1) // (2 * BLOCK)), 0)
            final = (place + n) // (2 * BLOCK)
            # Places of an item in a document ascend: what the one before holds is left out.
            again = (item[1:] == item[:-1]) & (d[1:] == d[:-1])
            first[1:] = np.where(again, np.maximum(first[1:], final[:-1] + 1), first[1:])
            some = np.maximum(final - first + 1, 0)
            which = np.repeat(np.arange(len(d)), some)
            window = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(some) - some, some)
            found = np.unique(np.stack([d[which], item[which], window * 2 * BLOCK], axis=1), axis=0)
            yield from ((x, w, k, None) for x, k, w in found.tolist())
            low = high

    def cosine(self, k: int, region: np.ndarray) -> float:
        """The largest cosine of an item's queries with a region's windows."""
        windows = [self.space[region[i : i + PASSAGE]].sum(axis=0) for i in range(0, max(len(region) - PASSAGE, 0) + 1, BLOCK)]
        return float(max((_unit(np.array(windows)) @ q[:, of == k]).max(initial=-1) for _, q, of in self.sides))

    def candidates(self, terms: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(document, first word of the window, item, cosine)."""
        # A document has an even number of blocks, then two empty ones: no
        # window holds words of two documents.
        n = np.diff(starts)
        blocks = 2 * (-(-n // (2 * BLOCK))) + 2
        first = np.concatenate([[0], np.cumsum(blocks)])
        laid = np.full(int(first[-1]) * BLOCK, BUCKETS, dtype=np.int32)
        laid[np.arange(len(terms)) + np.repeat(first[:-1] * BLOCK - starts[:-1], n)] = terms
        by_word = laid.reshape(-1, BLOCK)
        sums = np.empty((len(by_word), self.space.shape[1]), dtype=np.float32)
        for i in range(0, len(by_word), 2048):
            part = by_word[i : i + 2048]
            total = self.space[part[:, 0]]
            for k in range(1, BLOCK):
                total += self.space[part[:, k]]
            sums[i : i + 2048] = total
        pairs = sums[:-1] + sums[1:]
        for step, queries, of in self.sides:
            windows = pairs if step == 1 else pairs[0:-2:2] + pairs[2::2]
            for i in range(0, len(windows), 2048):
                cosines = _unit(windows[i : i + 2048]) @ queries
                w, q = np.nonzero(cosines >= MIN_COSINE)
                block = (i + w) * step
                doc = np.searchsorted(first, block, side="right") - 1
                word = (block - first[doc]) * BLOCK
                yield from zip(doc.tolist(), word.tolist(), of[q].tolist(), cosines[w, q].tolist())

    def hits(self, texts: pa.Array) -> Iterator[tuple]:
        """(document, item_id, cosine, lcs_words, item_words, answer_found, word).

        The subsequence is sought over terms first, then over the words."""
        terms, starts = batch_terms(texts)
        yield from self.whole(texts, terms, starts)
        if not self.items:
            return
        found: dict[tuple[int, int], tuple] = {}
        words: dict[int, list[str]] = {}
        for doc, at, k, cosine in self.near_enough(terms, starts):
            item, masks = self.items[k], self.masks[k]
            n = len(item.words)
            old = found.get((doc, k))
            if old is not None and old[3] >= MIN_LCS * n:
                continue
            # A window may stand anywhere in the item, so the region reaches an
            # item's length beyond it on both sides.
            begin, end = max(0, at - n), at + PASSAGE + n
            low = int(starts[doc])
            region = terms[low + begin : min(low + end, int(starts[doc + 1]))].tolist()
            if common_words(masks, n, region) < MIN_LCS_WITH_ANSWER * n:
                continue
            if doc not in words:
                words[doc] = split_words(texts.slice(doc, 1))[0].as_py()
            plain = plain_words(words[doc][begin:end])
            places: dict[str, int] = {}
            for i, w in enumerate(item.words):
                places[w] = places.get(w, 0) | 1 << i
            lcs = common_words(places, n, plain)
            if lcs < MIN_LCS_WITH_ANSWER * n or old is not None and lcs <= old[3]:
                continue
            answer = has_run(plain, item.answer)
            if lcs >= MIN_LCS * n or answer:
                if cosine is None:
                    cosine = old[2] if old is not None else self.cosine(k, np.array(region))
                found[doc, k] = (doc, item.item_id, cosine, lcs, n, answer, at)
        yield from found.values()


HIT_SCHEMA = (
    "doc_id long, item_id long, cosine double, lcs_words int, item_words int, answer_found boolean, window_start long"
)


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and benchmark item found in it (see ``HIT_SCHEMA``).

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns
    are not read.  Null and empty texts hold nothing, and items without a word are
    nowhere.  Items of fewer than ``MIN_ITEM_WORDS`` words are found where all of them
    stand in a row.  Rows that repeat an id are searched each.  Without documents or
    items there is no hit.
    """
    spark = docs.sparkSession
    importable(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    corpus = write_shared(corpus_terms(texts), "corpus-terms")
    idf = inverse_frequencies(corpus)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    asked = sketch(corpus_terms(items), idf, BENCHMARK_ROWS)
    sample = write_shared(sketch(corpus, idf, SKETCH_ROWS).unionByName(asked), "svd-passages")
    held = sample.count()
    if not held:
        return spark.createDataFrame([], HIT_SCHEMA)
    # A task adds up a matrix of BUCKETS rows, so it gets some thousand rows.
    sample = sample.coalesce(-(-held // TASK_ROWS))
    space = spark.sparkContext.broadcast((latent_space(spark, sample, idf), idf))

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Search(shared.value, *space.value)
            for batch in batches:
                ids = batch.column(0).to_pylist()
                for first, some in _slices(batch.column(1)):
                    rows = [(ids[first + d], *hit) for d, *hit in finder.hits(some)]
                    if rows:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(zip(*rows), _HIT_KINDS)], _HIT_NAMES
                        )

        return texts.mapInArrow(run, HIT_SCHEMA)

    out = None
    block: list[Item] = []
    queries = 0
    # The stated query set, a block at a time.
    for row in items.toLocalIterator():
        item = make_item(row.item_id, row.text)
        if not item.words:
            continue
        block.append(item)
        queries += 1 + len(item.words) // (QUERY_WORDS // 2)
        if queries >= QUERY_BLOCK:
            found = search(spark.sparkContext.broadcast(block))
            out = found if out is None else out.unionByName(found)
            block, queries = [], 0
    if block or out is None:
        if not block:
            return spark.createDataFrame([], HIT_SCHEMA)
        found = search(spark.sparkContext.broadcast(block))
        out = found if out is None else out.unionByName(found)
    return out


_HIT_NAMES = [x.split()[0] for x in HIT_SCHEMA.split(", ")]
_HIT_KINDS = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()]


def _slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of some ``size`` bytes, with the place of the first."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = held = 0
    for i, n in enumerate(lengths):
        held += int(n)
        if held >= size:
            yield at, texts.slice(at, i + 1 - at)
            at, held = i + 1, 0
    if at < len(lengths):
        yield at, texts.slice(at)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All places of ``benchmark`` items in ``documents``."""
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
