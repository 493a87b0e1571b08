"""Operator 7: exact n-gram Jaccard join with set-relation skipping.

Texts become sets of hashed word shingles.  The join finds all pairs of sets
whose similarity reaches a threshold, as components of linked documents:

* Equal sets are one class, by a 128-bit digest of the set; from here on a class
  stands for all its documents.
* Relations between sets: sets that share a min-hash are compared with one hub of
  their group, so the members of a group of near copies are linked through few
  comparisons, and every member's distance to its component's leader is known.
* A family is a group of sets whose min-hashes agree with common hubs, linked or
  not.  Links inside a crowded family are found by the differences of its members
  from the family's majority (``families.py``), and outside it stands for them.
  Sets that meet a family in the lists and may be linked to its members are
  guests in its index.
* Index lists: shingles are ordered (frequent ones last, others by hash), and only
  a prefix of each set is indexed.  A component or family is one entry in a list
  however many members share the shingle.  Lists are skipped by blocks: entries whose
  position is beyond the first block need not meet each other, and sizes and
  positions that cannot reach the threshold do not.  Two sets that met have to
  share enough of their prefixes before they are compared whole.
* A component's answers are derived from its leader's: the leaders of two
  components that met in a list are compared, and only members whose distances
  to the leaders leave room for a link are compared themselves.

All pairs that reach the threshold end up in one component; none is dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm.common import importable, table, write_shared
from martforge.llm.components import components
from martforge.llm.families import differences, family_links

#: Independent min-hashes of a set; the first of them name the groups that hubs
#: are sought in.
MIN_HASHES = 8
HUB_KEYS = 4
#: Components (or single classes) that make a family crowded; smaller families meet in
#: the index lists.  Both ways are exact.
CROWDED = 3
#: A shingle in this many of the examined prefixes is frequent; entries that the
#: list of frequent shingles has at most (8 bytes each).
FREQUENT = 24
FREQUENT_ENTRIES = 1_000_000
#: Ids up to which a set of wanted documents is broadcast; beyond, it is joined.
BROADCAST_IDS = 1_000_000

_BASE = np.uint64(0x9FB21C651E98DF25)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.full(1 << 14, _BASE, dtype=np.uint64), dtype=np.uint64)
_SEEDS = np.random.default_rng(7).integers(1 << 62, 1 << 63, MIN_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts in a row (A-Z as a-z), and where
    each text's begin (and the end).  Words are runs without ASCII white space."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    wide = pa.types.is_large_string(words.type)
    at = np.frombuffer(words.buffers()[1], np.int64 if wide else np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[at[0] : at[-1]]
    starts, lengths = at[:-1] - at[0], np.diff(at)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    parts = (data + np.uint64(1)) * _POWERS[place & (len(_POWERS) - 1)]
    parts[place >= len(_POWERS)] *= _STEP
    sums = np.add.reduceat(np.append(parts, np.uint64(0)), starts)
    real = lengths > 0  # a text that begins or ends with white space has empty words
    out = mixed(sums + lengths.astype(np.uint64) * _STEP)[real]
    kept = np.concatenate([[0], np.cumsum(real)])
    ends = np.concatenate([[0], np.cumsum(counts)])
    return out, kept[ends]


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, starts = word_hashes(texts)
    if len(words) >= width:
        rolled = words[: len(words) - width + 1].copy()
        for k in range(1, width):
            rolled = mixed(rolled) * _STEP + words[k : len(words) - width + 1 + k]
        rolled = mixed(rolled)
    for i in range(len(texts)):
        lo, hi = int(starts[i]), int(starts[i + 1])
        if hi - lo >= width:
            yield np.unique(rolled[lo : hi - width + 1])
        elif hi > lo:
            one = words[lo : lo + 1].copy()
            for k in range(lo + 1, hi):
                one = mixed(one) * _STEP + words[k : k + 1]
            yield mixed(one ^ np.uint64(hi - lo))
        else:
            yield np.zeros(0, np.uint64)


def prefix_length(n: int, percent: int) -> int:
    """Positions of a set of ``n`` that hold its first common shingle with any
    set of ``percent`` or more: not more than n - ceil(t n) precede it."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _slices(texts: pa.Array, size: int = 1 << 20) -> Iterator[tuple[int, pa.Array]]:
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = held = 0
    for i, n in enumerate(lengths):
        held += int(n)
        if held >= size:
            yield at, texts.slice(at, i + 1 - at)
            at, held = i + 1, 0
    if at < len(lengths):
        yield at, texts.slice(at)


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, digest, keys) of each row: size, digest and min-hashes of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                sizes, digests, keys = [], [], []
                for s in shingle_sets(texts, width):
                    sizes.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    keys.append(np.array([(s * k).min() for k in _SEEDS], np.uint64) if len(s) else s)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _lists(keys)],
                    ["doc_id", "n", "digest", "keys"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, keys array<long>")


def frequent_shingles(docs: DataFrame, width: int, percent: int) -> np.ndarray:
    """The shingles that stand in the most prefixes, sorted.

    Counted over one and a half prefixes of all texts; ``FREQUENT_ENTRIES`` of
    them at most are put last in the order of shingles, which decides how long
    lists get, not what is found."""

    def low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                heads = [s[: prefix_length(len(s), percent) * 3 // 2] for s in shingle_sets(texts, width)]
                tokens, n = np.unique(np.concatenate(heads).view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(n.astype(np.int32))], ["token", "n"])

    counts = docs.select("text").mapInArrow(low, "token long, n int").groupBy("token").agg(F.sum("n").alias("c"))
    often = write_shared(counts.where(F.col("c") >= FREQUENT), "frequent")
    if often.count() > FREQUENT_ENTRIES:
        often = often.orderBy(F.desc("c"), "token").limit(FREQUENT_ENTRIES)
    return np.sort(np.array([r.token for r in often.select("token").toLocalIterator()], np.int64).view(np.uint64))


def _wanted(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is one of the distinct ``nodes`` (node).

    Broadcast behind a count of its rows, else joined by a shuffle."""
    if nodes.count() <= BROADCAST_IDS:
        nodes = F.broadcast(nodes)
    return docs.join(nodes, docs["doc_id"] == nodes["node"], "left_semi")


def sets_of(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles): the sets of the given documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                sets = list(shingle_sets(texts, width))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), _lists(sets)], ["node", "shingles"]
                )

    return _wanted(docs, nodes).mapInArrow(run, "node long, shingles array<long>")


def paired_sets(docs: DataFrame, pairs: DataFrame, width: int, label: str) -> DataFrame:
    """The sets of all documents in ``pairs`` (a, b, ...)."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    return write_shared(sets_of(docs, write_shared(nodes, f"{label}-nodes"), width), f"{label}-sets")


def compared(docs: DataFrame, pairs: DataFrame, width: int, label: str, sets: DataFrame | None = None) -> DataFrame:
    """``pairs`` (a, b, ...) with ``both``, the exact size of the intersection.

    An id that several rows have gives a row for each of their sets."""
    sets = paired_sets(docs, pairs, width, label) if sets is None else sets
    left, right = sets.withColumnsRenamed({"node": "a", "shingles": "sa"}), sets.withColumnsRenamed({"node": "b", "shingles": "sb"})
    met = pairs.join(left, "a").join(right, "b")
    return write_shared(met.withColumn("both", F.size(F.array_intersect("sa", "sb")).cast("long")).drop("sa", "sb").distinct(), label)


def reaches(both: Column, na: Column, nb: Column, percent: int) -> Column:
    return 100 * both >= percent * (na + nb - both)


def linked_sets(docs: DataFrame, classes: DataFrame, signs: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) between classes (node, n) such that all links lie in their
    components.  ``signs`` has the signatures of the classes' documents."""
    t = percent / 100
    #: |A xor B| <= slack * (|A| + |B|) for linked sets.
    slack = (1 - t) / (1 + t) + 1e-9
    # The smaller of two different linked sets has this many shingles at least.
    least = math.ceil(t / (1 - t) - 1e-9) if percent < 100 else None
    if least is None:
        return classes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    classes = classes.where(F.col("n") >= least)
    signed = write_shared(signs.join(classes.select(F.col("node").alias("doc_id")), "doc_id").dropDuplicates(["doc_id"]), "class-signatures")

    # Hubs: each set against the smallest node of its min-hash groups, if most of
    # their min-hashes agree.  What this misses, the index lists find.
    keyed = signed.select(F.col("doc_id").alias("node"), "n", "keys", F.posexplode(F.slice("keys", 1, HUB_KEYS)).alias("k", "key"))
    hubs = keyed.groupBy("k", "key").agg(F.min(F.struct("node", "n", "keys")).alias("hub"), F.count(F.lit(1)).alias("c")).where("c > 1")
    agree = F.size(F.filter(F.zip_with("keys", "hub.keys", lambda x, y: x == y), lambda same: same))
    stars = (
        keyed.join(hubs, ["k", "key"])
        .where((F.col("node") != F.col("hub.node")) & (percent * F.greatest("n", "hub.n") <= 100 * F.least("n", "hub.n")))
        .where(agree >= max(1, int(0.7 * t * MIN_HASHES)))
        .select(F.col("node").alias("a"), F.col("hub.node").alias("b"), F.col("n").alias("na"), F.col("hub.n").alias("nb"))
        .distinct()
    )
    stars = write_shared(stars, "stars")
    star_sets = paired_sets(docs, stars, width, "star-links")
    families = components(stars)
    stars = compared(docs, stars, width, "star-links", star_sets)
    edges = stars.where(reaches(F.col("both"), F.col("na"), F.col("nb"), percent)).select("a", "b", "na", "nb", "both")
    groups = components(edges)

    # Members of components and their distances to their leader, the smallest node.
    sizes = classes.select("node", "n")
    members = write_shared(groups.join(sizes, "node"), "members")
    leaders = members.where("node = component").select("component", F.col("n").alias("nl"))
    known = edges.select(F.col("a").alias("node"), F.col("b").alias("component"), F.col("both").alias("told"))
    others = members.where("node <> component").join(leaders, "component").join(known, ["node", "component"], "left")
    asked = others.where("told IS NULL").select(F.col("node").alias("a"), F.col("component").alias("b"), F.col("n").alias("na"), F.col("nl").alias("nb"))
    asked = compared(docs, write_shared(asked, "leader-pairs"), width, "leader-links")
    far = (
        others.where("told IS NOT NULL").select("node", "component", "n", (F.col("n") + F.col("nl") - 2 * F.col("told")).alias("r"))
        .unionByName(asked.select(F.col("a").alias("node"), F.col("b").alias("component"), F.col("na").alias("n"), (F.col("na") + F.col("nb") - 2 * F.col("both")).alias("r")))
        .unionByName(leaders.select(F.col("component").alias("node"), "component", F.col("nl").alias("n"), F.lit(0).cast("long").alias("r")))
    )
    far = write_shared(far, "distances")

    # Crowded families: differences from their first member.
    kin = crowded_families(families, groups, signs)
    near = write_shared(differences(kin, star_sets), "family-members")
    far = write_shared(
        far.join(near.select("node"), "node", "left_anti").unionByName(
            near.select("node", F.col("family").alias("component"), "n", F.size("diff").cast("long").alias("r"))
        ),
        "family-distances",
    )
    crowded = near.select("family").distinct()

    pairs = met_in_lists(docs, signed, far, width, percent, slack)
    # Leaders first.
    pairs = pairs.join(sizes.withColumnsRenamed({"node": "a", "n": "na"}), "a").join(sizes.withColumnsRenamed({"node": "b", "n": "nb"}), "b")
    led = compared(docs, write_shared(pairs, "led-pairs"), width, "met-links")
    linked = reaches(F.col("both"), F.col("na"), F.col("nb"), percent)
    edges = edges.select("a", "b").unionByName(led.where(linked).select("a", "b"))
    # Then members that the distances leave room for; all members of a component are
    # linked with its leader, those of a family need not be.
    led = (
        led.join(crowded.select(F.col("family").alias("a"), F.lit(True).alias("fa")), "a", "left")
        .join(crowded.select(F.col("family").alias("b"), F.lit(True).alias("fb")), "b", "left")
        .na.fill(False, ["fa", "fb"])
    )
    apart = (F.col("na") + F.col("nb") - 2 * F.col("both")).alias("d")
    open_pairs = led.where(~linked | F.col("fa") | F.col("fb")).select(
        F.col("a").alias("ca"), F.col("b").alias("cb"), "na", "nb", apart, "fa", "fb"
    )
    span = far.groupBy("component").agg(F.max("r").alias("r"), F.max("n").alias("m"), F.count(F.lit(1)).alias("s"))
    # A class without a component is its own leader, at distance 0.
    spread = (
        open_pairs.join(span.withColumnsRenamed({"component": "ca", "r": "ra", "m": "ma", "s": "sa"}), "ca", "left")
        .join(span.withColumnsRenamed({"component": "cb", "r": "rb", "m": "mb", "s": "sb"}), "cb", "left")
        .where("ra IS NOT NULL OR rb IS NOT NULL")
        .na.fill(0, ["ra", "rb", "sa", "sb"])
        .withColumns({"ma": F.coalesce("ma", "na"), "mb": F.coalesce("mb", "nb")})
        .where(F.col("ra") + F.col("rb") + slack * (F.col("ma") + F.col("mb")) >= F.col("d"))
    )
    spread = write_shared(spread, "open-pairs")

    # The larger family of a pair takes the other's members as guests.
    a_hosts = F.col("fa") & (~F.col("fb") | (F.col("sa") >= F.col("sb")))
    hosted = spread.where("fa OR fb").select(
        F.when(a_hosts, F.col("ca")).otherwise(F.col("cb")).alias("family"),
        F.when(a_hosts, F.col("cb")).otherwise(F.col("ca")).alias("guest"),
        F.when(a_hosts, F.col("nb")).otherwise(F.col("na")).alias("ng"),
        (F.col("d") - F.when(a_hosts, F.col("ra") + slack * F.col("ma")).otherwise(F.col("rb") + slack * F.col("mb"))).alias("gap"),
    )
    guests = (
        hosted.join(far.withColumnRenamed("component", "guest"), "guest", "left")
        .where(F.coalesce("r", F.lit(0)) + slack * F.coalesce("n", "ng") >= F.col("gap"))
        .select(F.coalesce("node", "guest").alias("node"), "family")
    )
    guests = write_shared(guests.distinct(), "guests")
    visits = guests.select(F.col("node").alias("a"), F.col("family").alias("b"))
    visiting = differences(guests.withColumn("unit", F.col("node")), paired_sets(docs, visits, width, "guests"))
    near = near.withColumn("guest", F.lit(False)).unionByName(visiting.withColumn("guest", F.lit(True)))
    edges = edges.unionByName(family_links(write_shared(near, "families-with-guests"), percent))

    def side(x: str) -> DataFrame:
        return far.select(F.col("component").alias(f"c{x}"), F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("r").alias(f"r_{x}"))

    one = spread.where("NOT (fa OR fb)").join(side("a"), "ca", "left").withColumns(
        {"a": F.coalesce("a", "ca"), "n_a": F.coalesce("n_a", "na"), "r_a": F.coalesce("r_a", F.lit(0))}
    ).where(F.col("r_a") + F.col("rb") + slack * (F.col("n_a") + F.col("mb")) >= F.col("d"))
    two = one.join(side("b"), "cb", "left").withColumns(
        {"b": F.coalesce("b", "cb"), "n_b": F.coalesce("n_b", "nb"), "r_b": F.coalesce("r_b", F.lit(0))}
    )
    room = F.col("r_a") + F.col("r_b") + slack * (F.col("n_a") + F.col("n_b")) >= F.col("d")
    fits = percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b")
    rest = two.where(room & fits & ~((F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb")))).select(
        "a", "b", F.col("n_a").alias("na"), F.col("n_b").alias("nb")
    )
    rest = write_shared(rest, "member-pairs")
    if not rest.isEmpty():
        last = compared(docs, rest, width, "member-links")
        edges = edges.unionByName(last.where(linked).select("a", "b"))
    return edges


def crowded_families(families: DataFrame, groups: DataFrame, signs: DataFrame) -> DataFrame:
    """(node, family, unit) of the families (node, component) with ``CROWDED`` units
    or more: components of ``groups`` or single classes.

    A family with an id that has several different sets is left out: an id names
    one set of a family.  Its links are found in the lists."""
    several = signs.groupBy("doc_id").agg(F.min("digest").alias("d0"), F.max("digest").alias("d1")).where("d0 < d1")
    kin = (
        families.withColumnRenamed("component", "family")
        .join(groups.withColumnRenamed("component", "unit"), "node", "left")
        .withColumn("unit", F.coalesce("unit", "node"))
        .join(several.select(F.col("doc_id").alias("node"), F.lit(1).alias("several")), "node", "left")
    )
    kin = write_shared(kin, "families")
    units = F.count(F.when(F.col("unit") == F.col("node"), 1))
    wanted = kin.groupBy("family").agg(units.alias("units"), F.count("several").alias("several")).where(
        (F.col("units") >= CROWDED) & (F.col("several") == 0)
    )
    return kin.drop("several").join(wanted.select("family"), "family", "left_semi").select("node", "family", "unit")


def met_in_lists(
    docs: DataFrame, signed: DataFrame, far: DataFrame, width: int, percent: int, slack: float
) -> DataFrame:
    """Pairs (a, b) of components (or single classes) that meet in an index list."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, width, percent))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                out = []
                for s in shingle_sets(texts, width):
                    if len(known) and len(s):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        last = known[at] == s
                        if last.any():
                            s = np.concatenate([s[~last], s[last]])
                    out.append(s[: prefix_length(len(s), percent)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), _lists(out)], ["doc_id", "prefix"])

    heads = docs.mapInArrow(prefixes, "doc_id long, prefix array<long>")
    placed = (
        signed.select(F.col("doc_id").alias("node"), "n")
        .join(far.select("node", "component"), "node", "left")
        .join(heads.withColumnRenamed("doc_id", "node"), "node")
        .dropDuplicates(["node"])
        .select(F.coalesce("component", "node").alias("c"), F.col("component").isNotNull().alias("many"), "n", "prefix")
    )
    heads = write_shared(placed, "prefixes")
    placed = heads.select("c", "many", "n", F.posexplode("prefix").alias("pos", "token"))
    # A component has one entry in a list; a single class has one anyway.
    single = placed.where("NOT many").select("token", "c", F.col("n").alias("lo"), F.col("n").alias("hi"), "pos")
    many = placed.where("many").groupBy("token", "c").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("pos"))
    # One shuffle lays out the lists; most have one entry and go.
    entries = single.unionByName(many).repartition("token")
    several = entries.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("token")
    entries = write_shared(entries.join(several, "token").withColumn("first", F.col("pos") <= slack * F.col("hi")), "lists")
    x, y = entries.where("first").alias("x"), entries.alias("y")
    may = (
        (F.col("x.token") == F.col("y.token"))
        # Two entries beyond the first block of their lists cannot be linked.
        & ((~F.col("y.first") & (F.col("x.c") != F.col("y.c"))) | (F.col("x.c") < F.col("y.c")))
        & (percent * F.col("x.lo") <= 100 * F.col("y.hi"))
        & (percent * F.col("y.lo") <= 100 * F.col("x.hi"))
        & (F.col("x.pos") + F.col("y.pos") <= slack * (F.col("x.hi") + F.col("y.hi")))
    )
    pairs = write_shared(
        x.join(y, may).select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")).distinct(), "met"
    )
    # Two single classes have to share enough of their prefixes: what is shared
    # beyond the prefix that ends first is at most what that set has beyond it.
    alone = heads.where("NOT many").select("c", "n", "prefix")
    both = (
        pairs.join(alone.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("prefix").alias("pa")), "a", "left")
        .join(alone.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("prefix").alias("pb")), "b", "left")
    )
    asked = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    beyond = F.expr(f"({percent} * greatest(na, nb) + 99) div 100 - 1")
    enough = F.size(F.array_intersect("pa", "pb")) >= asked - beyond
    return both.where(F.coalesce(enough, F.lit(True))).select("a", "b")


def jaccard_components(
    docs: DataFrame, width: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of
    their sets of ``width``-word shingles; a component is named by its smallest
    id.  A text with fewer words is one shingle; null and empty texts have none
    and are linked with nothing.  Rows without an id have no component id.  Rows
    that repeat an id have one node; other columns are not read.
    """
    spark = docs.sparkSession
    importable(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    signs = write_shared(signatures(texts, width), "signatures")
    classes = write_shared(
        signs.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("n").alias("n")).where("node IS NOT NULL"),
        "classes",
    )
    nodes = classes.select("node", "n").dropDuplicates(["node"])
    edges = linked_sets(texts, nodes, signs.select("doc_id", "n", "digest", "keys"), width, percent)
    found = components(edges)
    # Few classes are linked to others; the join's hot side, one digest with very
    # many documents, is split by AQE.
    named = classes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    out = signs.select("doc_id", "n", "digest").join(named, "digest", "left")
    return out.select(
        F.col("doc_id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` with 3-word shingles and 90 percent."""
    return jaccard_components(table(spark, sf_dir, "documents"), 3, 90)
