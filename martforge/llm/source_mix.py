"""Operator 11: a mixture of sources by Sainte-Laguë apportionment, native.

1. *Targets.*  Sources in order of code point (null last) weigh 5, 2, 1, repeating,
   and share all words; a target stops at three times its source's words and what
   is above is shared again by weight.  The end of that is a water level: with the
   sources sorted by cap over weight, the level is the largest of "words left over
   weight left" over all prefixes that could have stopped.
2. *Apportionment.*  The words of the mix are cut into blocks of equal length, the
   blocks into shards.  Blocks go to the highest quotients ``target / (2a + 1)``.
   All but a few per source are certain from the bounds of the method, so only some
   five rows a source and shard are ranked.  A shard's quota is the difference of
   the apportionments up to it and before it, which is never negative.
3. *Selection.*  A source's documents lie one after another in a seeded order, three
   laps long, and are cut into blocks of the same length.  Earlier laps are taken
   whole first; inside a lap a seeded one-to-one map of block numbers says which
   blocks come and in which place, and a place falls into a shard by the quotas.

Only ids, sizes and digests are shuffled, never texts.  Positions come from 4,096
seeded groups a source, so a source with a third of all rows is spread; a document
knows its blocks from its position by arithmetic, so no row per block is made.
Sources are one row each in a single task when they are ordered and levelled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.llm.common import WORD, table, write_shared

#: Weights in order of the sources, repeating, and laps a source may be read (fixed values of the contract).
WEIGHTS = (5, 2, 1)
MAX_LAPS = 3
#: Words of a block, shards, and the seed of order and selection.
BLOCK_WORDS = 32
SHARDS = 40
SEED = 11
#: Hex digits of a digest that name a row's group in its source (16**3 groups).
GROUP_DIGITS = 3
#: Multipliers of the map of block numbers; primes, and no lap has a number of blocks that all of them divide.
PRIMES = (999_979, 999_961, 999_953, 999_931)


def source_sizes(rows: DataFrame) -> DataFrame:
    """One row per source: ``source``, ``source_size``, and ``place`` in code point order from 0."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)


def levelled_targets(sources: DataFrame, laps: int = MAX_LAPS) -> DataFrame:
    """``sources`` (``source_size``, ``weight``, ``place``) with ``target`` (double).

    Targets sum up to all words.  Products are decimal, so they are exact."""
    wide = "decimal(38,0)"
    cap = F.lit(laps).cast(wide) * F.col("source_size")
    every = Window.partitionBy()
    lower = Window.orderBy((cap.cast("double") / F.col("weight")).asc(), F.col("place").asc())
    before = lower.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every).cast(wide) - F.coalesce(F.sum(cap).over(before), F.lit(0)).cast(wide)
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = F.max(F.struct((F.col("left").cast("double") / F.col("weight_left")).alias("v"), "left", "weight_left"))
    out = sources.withColumns({"left": left, "weight_left": weight_left}).withColumn("level", level.over(every))
    share = (F.col("weight") * F.col("level.left")).cast("double") / F.col("level.weight_left")
    return out.withColumn("target", F.least(share, cap.cast("double"))).drop("left", "weight_left", "level")


def apportion(sources: DataFrame, shards: int, block_words: int) -> DataFrame:
    """``sources`` with ``quotas``: blocks of the source in the shards up to and
    including each shard, by Sainte-Laguë; equal quotients go to the earlier source.

    With ``n`` sources, ``H`` blocks and a source's share ``s`` of the targets, the
    method gives it from ``s * (H - n / 2) - 1/2`` to ``s * (H + n / 2) + 1/2`` blocks:
    fewer are certain, more impossible, and those between are ranked."""
    every = Window.partitionBy()
    live = (
        sources.where("target > 0")
        .withColumns({"n": F.count(F.lit(1)).over(every), "total": F.sum("target").over(every)})
        .withColumn("words", F.sum("source_size").over(every))  # what all targets add up to, exactly
        .select("place", "target", "n", "total", F.expr(f"words div {block_words}").alias("blocks"))
    )
    houses = live.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "house", F.expr(f"(blocks * (shard + 1)) div {shards}")
    )
    share = F.col("target") / F.col("total")
    houses = houses.withColumns(
        {
            "sure": F.greatest(F.floor(share * (F.col("house") - F.col("n") / 2)) - 1, F.lit(0)).cast("long"),
            "most": (F.floor(share * (F.col("house") + F.col("n") / 2)) + 2).cast("long"),
        }
    )
    by_shard = Window.partitionBy("shard")
    open_seats = houses.withColumn("open", F.col("house") - F.sum("sure").over(by_shard)).withColumn(
        "seat", F.explode(F.expr("sequence(sure, most)"))
    )
    quotient = F.col("target") / (2 * F.col("seat") + 1)
    rank = F.row_number().over(by_shard.orderBy(quotient.desc(), F.col("place"), F.col("seat")))
    won = open_seats.withColumn("won", (rank <= F.col("open")).cast("long"))
    quotas = won.groupBy("place", "shard").agg((F.first("sure") + F.sum("won")).alias("quota"))
    listed = quotas.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("by_shard"))
    return sources.join(listed, "place", "left").select(
        *sources.columns,
        F.coalesce(F.col("by_shard.quota"), F.array_repeat(F.lit(0).cast("long"), shards)).alias("quotas"),
    )


def positions(rows: DataFrame, seed: int, keys: list[str]) -> DataFrame:
    """``rows`` with ``offset``: words of the source's documents before this one, in an
    order that digests of ``keys`` settle.  Rows equal in all keys are interchangeable."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    mixed = rows.withColumn("mix", F.md5(F.concat_ws("|", F.lit(str(seed)), *texts).cast("binary"))).drop(
        *[c for c in keys if c not in ("doc_id", "source", "size")]
    )
    mixed = write_shared(mixed.withColumn("lot", F.substring("mix", 1, GROUP_DIGITS)), "mix-rows")
    lots = mixed.groupBy("source", "lot").agg(F.sum("size").alias("lot_size"))
    earlier = Window.partitionBy("source").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select(
        F.col("source").alias("lot_source"),
        F.col("lot").alias("lot_name"),
        F.coalesce(F.sum("lot_size").over(earlier), F.lit(0)).alias("lot_offset"),
    )
    before = Window.partitionBy("source", "lot").orderBy("mix", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = mixed.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("lot_source")) & (F.col("lot") == F.col("lot_name"))
    return inside.join(lots, same).withColumn("offset", F.col("inside") + F.col("lot_offset")).drop(
        "inside", "lot_offset", "lot_source", "lot_name", "lot", "mix"
    )


def select_pieces(placed: DataFrame, sources: DataFrame, block_words: int, seed: int, laps: int = MAX_LAPS) -> DataFrame:
    """``placed`` (``source``, ``size``, ``offset``) with its source's columns and
    ``pieces``: an array of (lap, shard, place, start, length), the stretches of the
    document's words that the mix takes, lap after lap.

    A block belongs to the lap in which it starts.  Blocks are exactly ``block_words``
    long; what is left at the end of the last lap is no block."""
    facts = sources.select(F.col("source").alias("of"), "source_size", "target", "quotas")
    joined = placed.join(facts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    b, s = block_words, "source_size"
    blocks = f"(({laps} * {s}) div {b})"
    first = f"least(({{0}} * {s} + {b - 1}) div {b}, {blocks})"  # first block that starts in a lap
    of_lap = ", ".join(
        f"named_struct('first', {first.format(lap)}, 'n', {first.format(lap + 1)} - {first.format(lap)})" for lap in range(laps)
    )
    choice = " ".join(f"when of_lap.n % {p} <> 0 then {p}" for p in PRIMES)
    joined = joined.withColumn("laps", F.expr(f"array({of_lap})"))
    # Stretches [from, to) of the source's stream of laps that this document fills, by block.
    stretches = f"""flatten(transform(sequence(0, {laps - 1}), lap ->
        transform(
            if(size = 0, cast(array() as array<bigint>), sequence((lap * {s} + offset) div {b}, (lap * {s} + offset + size - 1) div {b})),
            block -> named_struct(
                'lap', lap, 'block', block,
                'start', greatest(block * {b} - lap * {s} - offset, 0),
                'stop', least((block + 1) * {b} - lap * {s} - offset, size)
            )
        )))"""
    starts_in = f"(x.block * {b}) div {s}"
    ranked = f"""transform(filter({stretches}, x -> x.block < {blocks}), x -> named_struct(
        'lap', x.lap, 'block', x.block, 'start', x.start, 'stop', x.stop, 'of_lap', laps[cast({starts_in} as int)]))"""
    place = f"""of_lap.first + ((x.block - of_lap.first) * (case {choice} else 1 end) + {seed} * 7919) % of_lap.n"""
    place = place.replace("of_lap.", "x.of_lap.")
    chosen = f"""filter(transform({ranked}, x -> named_struct('lap', x.lap, 'place', {place}, 'start', x.start, 'stop', x.stop)),
        x -> x.place < quotas[size(quotas) - 1])"""
    pieces = f"""transform({chosen}, x -> named_struct(
        'lap', x.lap, 'shard', size(filter(quotas, q -> q <= x.place)), 'place', x.place,
        'start', x.start, 'length', x.stop - x.start))"""
    # `size` names the column and the function; only the call has a bracket behind it.
    return joined.withColumn("pieces", F.expr(pieces)).drop("laps", "quotas")


def mix_sources(
    docs: DataFrame,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (``doc_id``, ``source``, text): a row per document with
    ``size``, ``source_size``, ``target`` and ``pieces`` (see ``select_pieces``), and a row
    per source with ``target`` and the cumulative ``quotas`` of its shards.

    A null text has no words; a null source is a source of its own, the last; a source
    without words has the target 0; documents without words give no pieces; repeated
    rows are documents of their own; an empty table gives no rows.  Other columns of
    ``docs`` are not looked at.  Same rows, same seed: same mix.
    """
    rows = docs.select(
        F.col("doc_id"),
        F.col("source"),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(text_column).alias("text"),
    )
    placed = write_shared(positions(rows, seed, ["doc_id", "text"]), "mix-positions")
    sources = source_sizes(placed)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    targets = write_shared(levelled_targets(sources.withColumn("weight", weight)), "mix-targets")
    quotas = write_shared(apportion(targets, shards, block_words), "mix-quotas")
    return select_pieces(placed, quotas, block_words, seed), quotas


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each of all ``documents``."""
    mixed, _ = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda total, p: total + p["length"])
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source")


#: The same mix in DuckDB SQL: every seat of every source is ranked by its quotient,
#: and every block of every document is made a row.
OP11_SQL = f"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           md5(concat_ws('|', '{SEED}', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))) AS mix
    FROM documents
), placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY mix, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before_it,
           row_number() OVER () AS row_no
    FROM docs
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM docs GROUP BY source
), weighed AS (
    SELECT *, [{', '.join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1] AS weight FROM sources
), stops AS (
    SELECT *, (SELECT sum(source_size) FROM weighed)
              - coalesce(sum({MAX_LAPS} * source_size) OVER before, 0) AS words_left,
           (SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM weighed
    WINDOW before AS (ORDER BY ({MAX_LAPS} * source_size)::DOUBLE / weight, place
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT words_left, weight_left FROM stops
    ORDER BY words_left::DOUBLE / weight_left DESC, words_left DESC, weight_left DESC LIMIT 1
), targets AS (
    SELECT w.*, least((w.weight * l.words_left)::DOUBLE / l.weight_left, ({MAX_LAPS} * w.source_size)::DOUBLE) AS target
    FROM weighed w, level l
), house AS (
    SELECT (sum(source_size) // {BLOCK_WORDS})::BIGINT AS blocks FROM targets
), seats AS (
    SELECT place, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, place, seat) AS rank
    FROM (SELECT place, target, unnest(range(0, (target // {BLOCK_WORDS})::BIGINT + 2 + (SELECT count(*) FROM targets))) AS seat
          FROM targets WHERE target > 0)
), quotas AS (
    SELECT t.*, coalesce(q.quota, 0) AS quota
    FROM targets t LEFT JOIN (SELECT place, count(*) AS quota FROM seats, house WHERE rank <= blocks GROUP BY place) q USING (place)
), laps AS (
    SELECT place, lap, least((lap * source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}, {MAX_LAPS} * source_size // {BLOCK_WORDS}) AS first,
           least(((lap + 1) * source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS}, {MAX_LAPS} * source_size // {BLOCK_WORDS}) - first AS n
    FROM quotas, range({MAX_LAPS}) r(lap)
), pieces AS (
    SELECT d.row_no, q.place, q.quota, q.source_size, lap * q.source_size + d.before_it AS here, d.size,
           unnest(range((lap * q.source_size + d.before_it) // {BLOCK_WORDS},
                        (lap * q.source_size + d.before_it + d.size - 1) // {BLOCK_WORDS} + 1)) AS block
    FROM placed d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source, range({MAX_LAPS}) r(lap)
    WHERE d.size > 0
), taken AS (
    SELECT p.row_no,
           sum(least((p.block + 1) * {BLOCK_WORDS}, p.here + p.size) - greatest(p.block * {BLOCK_WORDS}, p.here)) AS taken
    FROM pieces p JOIN laps l ON l.place = p.place AND l.lap = p.block * {BLOCK_WORDS} // p.source_size
    WHERE p.block < {MAX_LAPS} * p.source_size // {BLOCK_WORDS}
      AND l.first + ((p.block - l.first) * CASE {' '.join(f'WHEN l.n % {p} <> 0 THEN {p}' for p in PRIMES)} ELSE 1 END
                     + {SEED * 7919}) % l.n < p.quota
    GROUP BY p.row_no
)
SELECT d.doc_id, d.size, q.source_size, q.target, coalesce(t.taken, 0)::BIGINT AS taken, d.source
FROM placed d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN taken t USING (row_no)
"""
