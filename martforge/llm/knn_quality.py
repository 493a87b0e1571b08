"""Operator 9: quality by nearest-neighbour voting in a latent-semantic space.

Terms are pairs of neighbouring character classes of the whole text, and a few
terms on words (repeating the one before, upper case, ended by a symbol, and
repeated within ``REPEAT_WORDS`` words, over the whole text).  TF-IDF vectors of a
bounded, documented sample of labelled rows are factorised by a randomised SVD;
the sample's latent vectors are broadcast (``voters`` rows of ``rank`` floats,
whatever the input).  Every document is projected, its cosine with every voter
is computed exactly in blocks, and the labels of the nearest voters are weighed
by similarity.  Nothing is shuffled to score documents.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import importable, table

#: Bound of the labelled sample, and with it of the broadcast.
VOTERS = 4096
RANK = 48
NEIGHBOURS = 15
#: Exponent of the similarity, and the weight of the sample's share of label 1.
SHARPNESS = 6.0
PRIOR_WEIGHT = 0.05
BLOCK = 512
#: Words among which repeats are counted: a share that a text's length does not move.
REPEAT_WORDS = 50

CLASSES = 64
_PUNCTUATION = b".,!?#*$%&|<>-'\"/:;()[]{}=_@+~^"
WORD_TERMS = 6
TERMS = CLASSES * CLASSES + WORD_TERMS


def _class_table() -> np.ndarray:
    """Class of each byte: letters a-z apart, A-Z one, digits one, space, line
    feed, other white space, punctuation apart, bytes above ASCII two."""
    out = np.zeros(256, dtype=np.int64)
    out[ord("a") : ord("z") + 1] = np.arange(1, 27)
    out[ord("A") : ord("Z") + 1] = 27
    out[ord("0") : ord("9") + 1] = 28
    out[ord(" ")], out[ord("\n")] = 29, 30
    out[[9, 11, 12, 13]] = 31
    for i, b in enumerate(_PUNCTUATION):
        out[b] = 32 + i
    out[0x80:0xC0], out[0xC0:] = 62, 63
    return out


CLASS_OF = _class_table()


def repeat_share(words: list[bytes]) -> float:
    """Share of words that repeat another of the same ``REPEAT_WORDS``: the mean
    over the whole text, window by window; the last one ends with the text."""
    n = len(words)
    if n <= REPEAT_WORDS:
        return (n - len(set(words))) / n if n else 0.0
    starts = [*range(0, n - REPEAT_WORDS, REPEAT_WORDS), n - REPEAT_WORDS]
    distinct = sum(len(set(words[i : i + REPEAT_WORDS])) for i in starts)
    return 1 - distinct / (REPEAT_WORDS * len(starts))


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text and their shares (of its character pairs, or its words)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    terms, shares = [], []
    if len(raw) > 1:
        classes = CLASS_OF[np.frombuffer(raw, dtype=np.uint8)]
        counts = np.bincount(classes[:-1] * CLASSES + classes[1:], minlength=CLASSES * CLASSES)
        terms = np.flatnonzero(counts)
        shares = counts[terms] / (len(raw) - 1)
    words = raw.split()
    n = len(words)
    told = (
        sum(map(bytes.__eq__, words[1:], words)),
        sum(map(bytes.isupper, words)),
        sum(w[-1] in b"#*$%&|<>!" for w in words),
    )
    line = [x / n for x in told] if n else [0.0] * 3
    line.append(repeat_share(words))
    line += [1.0 if n == 0 else 0.0, 1.0 if 0 < n < 5 else 0.0]
    at = np.flatnonzero(line)
    return (
        np.concatenate([np.asarray(terms, dtype=np.int64), at + CLASSES * CLASSES]),
        np.concatenate([np.asarray(shares, dtype=np.float64), np.asarray(line)[at]]),
    )


def weights(terms: np.ndarray, shares: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of a text's terms, of length 1."""
    w = np.sqrt(shares) * idf[terms]
    norm = np.sqrt((w * w).sum())
    return w / norm if norm else w


@dataclass(frozen=True)
class Voters:
    """What is broadcast: ``rank`` x terms and ``voters`` x rank floats."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


def randomised_svd(matrix: np.ndarray, rank: int, seed: int = 9, power: int = 3) -> np.ndarray:
    """Right singular vectors (rank x columns) by a randomised range finder."""
    rng = np.random.default_rng(seed)
    rank = min(rank, *matrix.shape)
    width = min(rank + 10, *matrix.shape)
    sketch = matrix.T @ rng.standard_normal((matrix.shape[0], width)).astype(matrix.dtype)
    q, _ = np.linalg.qr(sketch)
    for _ in range(power):
        q, _ = np.linalg.qr(matrix.T @ (matrix @ q))
    _, _, v = np.linalg.svd(matrix @ q, full_matrices=False)
    return (q @ v[:rank].T).T


def fit(rows: list[tuple[bytes, int]], rank: int = RANK) -> Voters:
    """Voters from (packed terms, label) rows of the bounded sample."""
    matrix = np.zeros((len(rows), TERMS), dtype=np.float32)
    for i, (packed, _) in enumerate(rows):
        terms, shares = unpack(packed)
        matrix[i, terms] = np.sqrt(shares)
    df = (matrix > 0).sum(axis=0)
    idf = (np.log((1 + len(rows)) / (1 + df)) + 1).astype(np.float32)
    matrix *= idf
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    labels = np.array([y for _, y in rows], dtype=np.float32)
    if not len(rows):
        return Voters(idf, np.zeros((0, TERMS), np.float32), np.zeros((0, 0), np.float32), labels, 0.5)
    basis = randomised_svd(matrix, rank).astype(np.float32)
    vectors = unit(matrix @ basis.T)
    return Voters(idf, basis, vectors, labels, float(labels.mean()))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def pack(terms: np.ndarray, shares: np.ndarray) -> bytes:
    return struct.pack("<i", len(terms)) + terms.astype("<u2").tobytes() + shares.astype("<f4").tobytes()


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    (n,) = struct.unpack_from("<i", packed)
    return np.frombuffer(packed, "<u2", n, 4).astype(np.int64), np.frombuffer(packed, "<f4", n, 4 + 2 * n)


def project(texts: list[str | None], voters: Voters) -> np.ndarray:
    """Latent unit vectors of texts (a zero vector where no term is known)."""
    out = np.zeros((len(texts), len(voters.basis)), dtype=np.float32)
    by_term = voters.basis.T
    for i, text in enumerate(texts):
        terms, shares = term_counts(text)
        out[i] = weights(terms, shares, voters.idf).astype(np.float32) @ by_term[terms]
    return unit(out)


def vote(vectors: np.ndarray, voters: Voters, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores from 0 to 1: neighbours' labels weighed by a power of the cosine.

    All voters as similar as the last neighbour count in full measure for their
    rank only, so ties are settled by the voters' fixed order.
    """
    if not len(voters.labels):
        return np.full(len(vectors), voters.prior)
    out = np.empty(len(vectors))
    k = min(neighbours, len(voters.labels))
    for at in range(0, len(vectors), BLOCK):
        cosines = vectors[at : at + BLOCK] @ voters.vectors.T
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        w = np.clip(np.take_along_axis(cosines, near, axis=1), 0, 1).astype(np.float64) ** SHARPNESS
        out[at : at + BLOCK] = ((w * voters.labels[near]).sum(axis=1) + PRIOR_WEIGHT * voters.prior) / (
            w.sum(axis=1) + PRIOR_WEIGHT
        )
    return np.clip(out, 0, 1)


def held_out(doc_id="doc_id"):
    """The rows no label is learnt from (fixed by the contract)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, label: str = "quality") -> DataFrame:
    """At most ``bound`` rows (doc_id, text, label) of ``docs`` with a label that
    may be learnt from, chosen by a hash of the id.

    Of several labels of an id the smallest counts, of several rows of an id one
    text.  Ids are chosen before any text is read.
    """
    told = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
    )
    chosen = (
        docs.select("doc_id")
        .join(told, "doc_id")
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(9)), "doc_id")
        .limit(bound)
    )
    # ``bound`` ids at most: small enough to send to every task.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))


def train(docs: DataFrame, labels: DataFrame, voters: int = VOTERS, rank: int = RANK) -> Voters:
    """Fit on the labelled sample; its packed terms (some 10 MB) reach the driver."""
    importable(docs.sparkSession)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(*term_counts(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["doc_id", "terms", "label"]
            )

    sample = labelled_sample(docs.withColumn("doc_id", F.col("doc_id").cast("long")), labels, voters)
    rows = sample.mapInArrow(terms, "doc_id long, terms binary, label int").collect()
    return fit([(bytes(r.terms), r.label) for r in sorted(rows, key=lambda r: r.doc_id)], rank)


def score_quality(docs: DataFrame, voters: Voters, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """``docs`` with the column ``score_column`` (replaced if there is one).

    A null text is an empty one: its only term is that it has no word, so it
    gets the share of label 1 if no voter is empty.  Without voters every score
    is 0.5.  Texts are read whole, and rows are scored one by one, so repeated
    rows get equal scores.
    """
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(voters)
    kept = docs.drop(score_column)
    at = kept.columns.index(text_column)
    schema = T.StructType([*kept.schema.fields, T.StructField(score_column, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                scores = vote(project(part.column(at).to_pylist(), known), known)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], schema.names)

    return kept.mapInArrow(run, schema)


def op9_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"),
    )
