"""Operator 4: URL verdicts from rules and a character language-model ratio.

Rules name a host and a path prefix; the longest rule that fits decides.  All
other URLs are judged by two variable-order Markov models over characters, one
of the URLs that rules accept and one of those they reject, smoothed by
Witten-Bell interpolation from order 3 down to the uniform distribution.  The
score is the difference of the log-likelihoods divided by the number of
characters; its threshold is calibrated on rule-judged URLs kept out of the
counts (those whose MD5 starts with one of three of sixteen digits).

Only DataFrame functions are used.  Characters are put in 32 classes, so there
are 32**4 = 1,048,576 n-grams at most: the counts are aggregated with a map-side
combine, and the model is one array of that fixed length, which reaches the
tasks as a scalar subquery.  Scores are fixed-point integers, so sums do not
depend on their order.  Scoring does not shuffle a row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.llm.common import table, write_shared

CLASSES = 32
ORDER = 3
GRAMS = CLASSES ** (ORDER + 1)
#: Fixed-point steps of a natural logarithm, and of the threshold's grid.
SCALE = 1_000_000
STEP = 10_000
GRID = 1_000
#: MD5 digits of the URLs that calibrate instead of being counted.
HELD_OUT = ("0", "1", "2")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FROM = _UPPER + _UPPER.lower() + "0123456789" + "/" + "." + "-"
_TO = _UPPER + _UPPER + "[" * 10 + "\\" + "]" + "^"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


#: Rules of the registered query (fixed values, given by the contract).
RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"://([^/?#]*)", 1)).otherwise("")
    return F.translate(rest, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1)).otherwise("")


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(verdict, rule) of the longest rule whose host is the host or a parent of
    it and whose path starts the path; null if none fits."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.verdict).alias("verdict"), F.lit(rule.text).alias("rule"))).otherwise(out)
    return out


def classes_of(text: Column) -> Column:
    """The text with every character replaced by that of its class."""
    return F.regexp_replace(F.translate(text, _FROM, _TO), r"[^A-Z\[\\\]\^]", "_")


#: n-gram that ends at character i of the text: padded with the class "@" (0).
_GRAM = " + ".join(
    f"(ascii(substr(_padded, i + {k}, 1)) - 64) * {CLASSES ** (ORDER - k)}" for k in range(ORDER + 1)
)
GRAM_CODES = f"CASE WHEN _n > 0 THEN transform(sequence(1, _n), i -> {_GRAM}) ELSE array() END"


def with_grams(urls: DataFrame) -> DataFrame:
    """Add ``_n`` (characters) and ``_grams`` (an n-gram code for each of them)."""
    return (
        urls.withColumn("_padded", F.concat(F.lit("@" * ORDER), classes_of(F.concat("host", "path"))))
        .withColumn("_n", F.length("_padded") - ORDER)
        .withColumn("_grams", F.expr(GRAM_CODES))
        .drop("_padded")
    )


def gram_scores(counts: DataFrame) -> DataFrame:
    """(code, score) of every possible n-gram from counts (code, allow, block).

    The tables joined here have 32 to 1,048,576 rows, whatever the input.
    """
    spark = counts.sparkSession
    probs = None
    for order in range(ORDER + 1):
        size = CLASSES ** (order + 1)
        grams = counts.groupBy((F.col("code") % size).alias("g")).agg(
            *[F.sum(c).alias(f"n_{c}") for c in ("allow", "block")]
        )
        every = spark.range(size).select(F.col("id").cast("int").alias("g")).join(grams, "g", "left").na.fill(0)
        every = every.withColumn("h", F.expr(f"g div {CLASSES}"))
        totals = every.groupBy("h").agg(
            *[F.sum(f"n_{c}").alias(f"all_{c}") for c in ("allow", "block")],
            *[F.sum((F.col(f"n_{c}") > 0).cast("long")).alias(f"kinds_{c}") for c in ("allow", "block")],
        )
        every = every.join(totals, "h")
        if probs is None:
            every = every.withColumns({f"q_{c}": F.lit(1.0 / CLASSES) for c in ("allow", "block")})
        else:
            lower = probs.select(F.col("g").alias("l"), F.col("p_allow").alias("q_allow"), F.col("p_block").alias("q_block"))
            every = every.join(lower, F.col("g") % (size // CLASSES) == F.col("l"))
        probs = every.select(
            "g",
            *[
                F.when(
                    F.col(f"all_{c}") > 0,
                    (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"q_{c}")) / (F.col(f"all_{c}") + F.col(f"kinds_{c}")),
                )
                .otherwise(F.col(f"q_{c}"))
                .alias(f"p_{c}")
                for c in ("allow", "block")
            ],
        )
    return probs.select(
        F.col("g").alias("code"),
        F.round((F.log("p_allow") - F.log("p_block")) * SCALE).cast("int").alias("score"),
    )


def best_threshold(held_out: DataFrame) -> DataFrame:
    """One row ``threshold``.

    The best grid step has the largest sum of the shares of accepted URLs at or
    above and rejected URLs below it (ties: the one nearest 0, then the smaller);
    the threshold lies half-way between it and the next lower step that has
    URLs.  0 without URLs of both kinds."""
    steps = held_out.groupBy(
        F.greatest(F.least(F.floor(F.col("_mean") / STEP), F.lit(GRID)), F.lit(-GRID)).alias("step")
    ).agg(
        F.sum((F.col("_verdict") == "allow").cast("long")).alias("a"),
        F.sum((F.col("_verdict") == "block").cast("long")).alias("b"),
    )
    # At most 2 * GRID + 1 rows.
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rated = steps.select(
        "step",
        F.coalesce(F.lag("step").over(Window.orderBy("step")), "step").alias("lower"),
        (F.sum("a").over(every) - F.coalesce(F.sum("a").over(below), F.lit(0))).alias("kept"),
        F.coalesce(F.sum("b").over(below), F.lit(0)).alias("stopped"),
        F.sum("a").over(every).alias("all_a"),
        F.sum("b").over(every).alias("all_b"),
    ).where("all_a > 0 AND all_b > 0")
    gain = F.col("kept") * F.col("all_b") + F.col("stopped") * F.col("all_a")
    best = F.max(F.struct(gain.alias("gain"), (-F.abs("step")).alias("near"), (-F.col("step")).alias("low"), "lower"))
    half = (F.col("best.lower") - F.col("best.low")) * (STEP // 2)
    return rated.agg(best.alias("best")).select(F.coalesce(half, F.lit(0)).cast("long").alias("threshold"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url_column: str = "url") -> DataFrame:
    """Add host, path, rule, verdict and the score (``lm_score``, null if there
    is nothing to score) to every row of ``pages``.

    A null URL or one without ``://`` has an empty host and path, no rule, and a
    score of 0.  Repeated rows are counted and judged each.  Columns that have
    the names of the results are replaced.  An empty table gives no rows;
    without URLs of both kinds all scores are weighed against a threshold of 0.
    """
    new = ("host", "path", "rule", "verdict", "lm_score")
    url = F.coalesce(F.col(url_column), F.lit(""))
    keep = [c for c in pages.columns if c not in new or c == url_column]
    judged = pages.select(*keep).withColumns({"host": host_of(url), "path": path_of(url), "_md5": F.substring(F.md5(url), 1, 1)})
    judged = with_grams(judged.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules)))
    held_out = F.col("_md5").isin(*HELD_OUT)
    known = judged.where(F.col("_rule").isNotNull()).select(F.col("_rule.verdict").alias("_verdict"), "_grams", "_n", held_out.alias("_held"))
    counts = (
        known.where(~F.col("_held"))
        .select("_verdict", F.explode("_grams").alias("code"))
        .groupBy("code")
        .agg(*[F.sum((F.col("_verdict") == v).cast("long")).alias(v) for v in ("allow", "block")])
    )
    counts = write_shared(counts, "url-gram-counts")
    scores = write_shared(gram_scores(counts), "url-gram-scores")
    # GRAMS integers in rows of 1024: the size is fixed by the alphabet and the order.
    rows = scores.groupBy(F.expr("code div 1024").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("code", "score")))["score"].alias("line")
    )
    model = rows.agg(F.array_sort(F.collect_list(F.struct("row", "line")))["line"].alias("m")).scalar()
    judged, known = judged.withColumn("_model", model), known.withColumn("_model", model)
    total = F.aggregate("_grams", F.lit(0).cast("long"), lambda s, g: s + F.get(F.get("_model", F.shiftright(g, 10)), g % 1024))
    mean = F.when(F.col("_n") > 0, F.floor(total / F.col("_n"))).otherwise(0).cast("long")
    limit = best_threshold(known.where("_held").withColumn("_mean", mean)).scalar()
    return (
        judged.withColumn("_mean", mean)
        .withColumn("rule", F.col("_rule.rule"))
        .withColumn("verdict", F.coalesce(F.col("_rule.verdict"), F.when(F.col("_mean") >= limit, "allow").otherwise("block")))
        .withColumn("lm_score", F.when(F.col("_n") > 0, F.col("_mean") / SCALE))
        .select(*[c for c in keep if c not in new], "host", "path", "rule", "verdict", "lm_score")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every ``pages`` URL."""
    out = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


_SQL_GRAM = " + ".join(
    f"(ascii(substr(padded, i + {k}, 1)) - 64) * {CLASSES ** (ORDER - k)}" for k in range(ORDER + 1)
)


def _sql_rule(column: str) -> str:
    cases = "".join(
        f" WHEN (host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}')"
        f" THEN '{getattr(r, column)}'"
        for r in sorted(RULES, key=lambda r: -len(r.text))
    )
    return f"CASE{cases} END"


def _sql_order(order: int) -> str:
    size = CLASSES ** (order + 1)
    lower = (
        f"SELECT h.*, {1.0 / CLASSES} AS qa, {1.0 / CLASSES} AS qb FROM h{order} h"
        if order == 0
        else f"SELECT h.*, l.pa AS qa, l.pb AS qb FROM h{order} h JOIN p{order - 1} l ON h.g % {size // CLASSES} = l.g"
    )
    return f""",
e{order} AS (
  SELECT r.g, r.g // {CLASSES} AS h, coalesce(a, 0) AS a, coalesce(b, 0) AS b
  FROM (SELECT unnest(range({size})) AS g) r LEFT JOIN (
    SELECT code % {size} AS g, sum(a) AS a, sum(b) AS b FROM counts GROUP BY 1) n ON r.g = n.g
), h{order} AS (
  SELECT e.g, e.a, e.b, t.* EXCLUDE (h) FROM e{order} e JOIN (
    SELECT h, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb
    FROM e{order} GROUP BY h) t ON e.h = t.h
), p{order} AS (
  SELECT g, CASE WHEN na > 0 THEN (a + ta * qa) / (na + ta) ELSE qa END AS pa,
            CASE WHEN nb > 0 THEN (b + tb * qb) / (nb + tb) ELSE qb END AS pb
  FROM ({lower})
)"""


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP4_SQL = f"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), j AS (
  SELECT *, {_sql_rule('text')} AS rule, {_sql_rule('verdict')} AS told,
    substr(md5(url), 1, 1) IN {HELD_OUT} AS held, row_number() OVER () AS uid,
    '{"@" * ORDER}' || regexp_replace(translate(host || path, {_sql_text(_FROM)}, {_sql_text(_TO)}), '[^A-Z\\[\\\\\\]\\^]', '_', 'g') AS padded
  FROM u
), grams AS (
  SELECT uid, told, held, {_SQL_GRAM} AS code
  FROM (SELECT uid, told, held, padded, unnest(range(1, length(padded) - {ORDER} + 1)) AS i FROM j)
), counts AS (
  SELECT code, count(*) FILTER (told = 'allow') AS a, count(*) FILTER (told = 'block') AS b
  FROM grams WHERE told IS NOT NULL AND NOT held GROUP BY code
){''.join(_sql_order(k) for k in range(ORDER + 1))},
scores AS (
  SELECT g AS code, CAST(round((ln(pa) - ln(pb)) * {SCALE}) AS BIGINT) AS score FROM p{ORDER}
), means AS (
  SELECT uid, floor(sum(score) / count(*)) AS mean FROM grams JOIN scores USING (code) GROUP BY uid
), judged AS (
  SELECT j.*, coalesce(mean, 0) AS mean FROM j LEFT JOIN means USING (uid)
), steps AS (
  SELECT greatest(least(floor(mean / {STEP}), {GRID}), -{GRID}) AS step,
    count(*) FILTER (told = 'allow') AS a, count(*) FILTER (told = 'block') AS b
  FROM judged WHERE told IS NOT NULL AND held GROUP BY 1
), rated AS (
  SELECT step, coalesce(lag(step) OVER (ORDER BY step), step) AS lower, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b,
    sum(a) OVER () - coalesce(sum(a) OVER w, 0) AS kept, coalesce(sum(b) OVER w, 0) AS stopped
  FROM steps WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), best AS (
  SELECT coalesce((SELECT (step + lower) * {STEP // 2} FROM rated WHERE all_a > 0 AND all_b > 0
    ORDER BY kept * all_b + stopped * all_a DESC, abs(step), step LIMIT 1), 0) AS threshold
)
SELECT page_id, host, path, rule,
  coalesce(told, CASE WHEN mean >= threshold THEN 'allow' ELSE 'block' END) AS verdict
FROM judged, best
"""
