"""Operator 1: quality rules learnt as a decision list.

Statistics of every whole text are counted once.  On a bounded, documented
sample of labelled rows sequential covering learns an ordered list of rules: a
rule is grown by adding the threshold condition with the largest information
gain, pruned on rows it was not grown on, and kept if it is precise enough
there; the rows it covers are taken away and the next rule is sought.  The list
is emitted as one ordered Spark conditional expression over the statistics, so
judging needs no shuffle and no Python beyond the counting of words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import importable, table
from martforge.llm.knn_quality import labelled_sample

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

#: Bound of the labelled sample, thresholds tried per statistic, rules and
#: conditions at most, share of rows that prune, and precision a rule needs.
SAMPLE = 8192
THRESHOLDS = 64
MAX_RULES = 16
MAX_CONDITIONS = 4
PRUNE_SHARE = 3
MIN_PRECISION = 0.95
MIN_COVER = 4

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_adjacent_words",
    "n_upper_words",
    "n_marked_words",
)


def repeated_window_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    n = len(words)
    if n <= width:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    code = at[: n - width + 1]
    for k in range(1, width):
        if len(ids) * (int(code.max()) + 1) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1].reshape(-1)
        code = code * len(ids) + at[k : n - width + 1 + k]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(code), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(width):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts ``COUNTS`` of a text; a null text has no word.

    Words are runs without ASCII white space, which is how ``bytes.split`` cuts.
    """
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    duplicates = lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            lines += 1
            if line in seen:
                duplicates += 1
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\r\x0b\x0c")),
        sum(map(text.count, SYMBOLS)),
        duplicates,
        repeated_window_words(words),
        lines,
        len(set(words)),
        sum(map(bytes.__eq__, words[1:], words)),
        sum(map(bytes.isupper, words)),
        sum(w[-1] in b"#*$%&|<>!" for w in words),
    )


def statistics() -> dict[str, Column]:
    """Statistics that rules may test, from the counts; 0 for a text without words."""
    words = F.col("n_words")

    def share(count: str, of: Column = words) -> Column:
        return F.when(of > 0, F.col(count) / of).otherwise(0.0)

    return {
        "n_words": words.cast("double"),
        "word_length": share("word_chars"),
        "symbols_per_word": share("n_symbols"),
        "duplicate_lines": share("n_dup_lines", F.col("n_lines")),
        "repeated_words": share("n_repeat_words"),
        "distinct_words": share("n_distinct_words"),
        "adjacent_words": share("n_adjacent_words"),
        "upper_words": share("n_upper_words"),
        "marked_words": share("n_marked_words"),
    }


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = statistics()[self.statistic]
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def holds(self, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
        v = x[:, list(names).index(self.statistic)]
        return v >= self.threshold if self.at_least else v < self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for c in rule:
        out &= c.holds(x, names)
    return out


def best_condition(x: np.ndarray, bad: np.ndarray, names: Sequence[str]) -> Condition | None:
    """The condition with the largest information gain for the rejected class."""
    p0, n0 = int(bad.sum()), int((~bad).sum())
    if not p0 or not n0:
        return None
    now = np.log2(p0 / (p0 + n0))
    best, found = 1e-9, None
    for j, name in enumerate(names):
        v = np.unique(x[:, j])
        if len(v) < 2:
            continue
        cuts = (v[1:] + v[:-1]) / 2
        if len(cuts) > THRESHOLDS:
            cuts = np.unique(np.quantile(x[bad, j], np.linspace(0, 1, THRESHOLDS // 2)).tolist() + np.quantile(cuts, np.linspace(0, 1, THRESHOLDS // 2)).tolist())
        above = x[:, j][:, None] >= cuts[None, :]
        p_above, n_above = above[bad].sum(axis=0), above[~bad].sum(axis=0)
        for at_least, p, n in ((True, p_above, n_above), (False, p0 - p_above, n0 - n_above)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / (p + n)) - now), 0.0)
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = float(gain[k]), Condition(name, at_least, float(cuts[k]))
    return found


def learn(x: np.ndarray, bad: np.ndarray, names: Sequence[str], prune: np.ndarray) -> list[Rule]:
    """Sequential covering: rules for the rejected class, in order."""
    rules: list[Rule] = []
    left = np.ones(len(x), dtype=bool)
    while len(rules) < MAX_RULES and (bad & left & ~prune).any():
        here, rule = left & ~prune, ()
        while len(rule) < MAX_CONDITIONS:
            inside = here & covers(rule, x, names)
            if rule and not (inside & ~bad).any():
                break
            condition = best_condition(x[inside], bad[inside], names)
            if condition is None:
                break
            rule += (condition,)

        def worth(r: Rule) -> float:
            inside = left & prune & covers(r, x, names)
            p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        inside = left & covers(rule, x, names)
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if p < MIN_COVER or p < MIN_PRECISION * (p + n) or (worth(rule) + 1) / 2 < MIN_PRECISION:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def first_rule(rules: Sequence[Rule]) -> Column:
    """Number (from 1) of the first rule that holds, else null."""
    out = None
    for i, rule in enumerate(rules, 1):
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(None).cast("int") if out is None else out.cast("int")


def with_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the counts in place of columns of these names and the text
    kept; whole texts are counted."""
    importable(docs.sparkSession)
    kept = docs.drop(*[c for c in COUNTS if c != text_column])
    at = kept.columns.index(text_column)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(t.as_py()) for t in batch.column(at)]
            counted = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns, *counted], schema.names)

    return kept.mapInArrow(count, schema)


def learn_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn the list from at most ``sample`` labelled rows (label 0: reject).

    Only their statistics reach the driver.  Without labelled rows of both kinds
    the list is empty and nothing is rejected by it.
    """
    names = list(statistics())
    rows = with_counts(labelled_sample(docs, labels, sample))
    got = rows.select("doc_id", "label", *[v.alias(f"s_{k}") for k, v in statistics().items()]).collect()
    got.sort(key=lambda r: r.doc_id)
    x = np.array([[r[f"s_{n}"] for n in names] for r in got], dtype=float).reshape(len(got), len(names))
    bad = np.array([r.label == 0 for r in got], dtype=bool)
    return learn(x, bad, names, np.arange(len(got)) % PRUNE_SHARE == 0)


def judge(docs: DataFrame, rules: Sequence[Rule], text_column: str = "text") -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``rule`` (number of the rule
    that rejects, null if none) and ``kept``.

    A null or empty text has no words, so the base check fails.  Repeated rows
    get equal verdicts; columns with the names of the results are replaced; an
    empty table gives no rows.
    """
    counted = with_counts(docs.drop("base_failed", "rule", "kept"), text_column)
    failed = (F.col("n_words") < BASE_MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("rule", first_rule(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the base check and the learnt list on all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select("doc_id", *COUNTS[:5], "base_failed", "kept", "rule")
