"""Operator 12: the prefix trie of rebuilt conversations, from composable fingerprints.

A conversation is rebuilt from the first turns of a base conversation and its own
turns after as many.  No rebuilt text is made.  A turn is an affine map modulo a
prime (its multiplier and shift come from a digest of role and text), a sequence of
turns is the product of their maps, and products combine: the fingerprint of a rebuilt
prefix is the base's head product times the own product without its head.

* Prefix products of all conversations come from one scan over turns sorted by
  conversation: each task multiplies what it holds, and a conversation cut between
  tasks gets the product of its earlier parts (one row a task reaches the driver).  A
  conversation with a third of all turns is thus spread over many tasks.
* A node is a group of equal fingerprints.  Groups are checked: their members must have
  equal parents and a last turn of equal name, and a turn's name must stand for one
  role and text among all turns that conversations refer to.  If a check fails, the
  work is done again with other digests.
* Sums over subtrees need no walk.  Every node is owned by its smallest member, and the
  nodes that a conversation owns are the end of its path; so the sum over a subtree is
  the sum of what its members own, less what the owner owns above it.  Leaves likewise.

Groups are aggregated before they are shuffled; joins are by conversation or by node
with one row on one side, so the engine can split a hot key.  The digest of the members
that end at a node reads their ids in order, as a stream of joined chunks: a SHA-256 is
sequential, but no group is held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import importable, table, write_shared

PRIME = (1 << 61) - 1
#: Most turns that a head can have (fixed value of the contract), and ids in a chunk.
MAX_HEAD = 3
CHUNK_IDS = 4096
#: Digests tried before giving up.
SEEDS = 4

TURN = ("a1", "b1", "a2", "b2")  # a turn's maps, in two lanes; together they are its name
PREFIX = ("p1", "q1", "p2", "q2")  # products of them
UPTO = ("x1", "y1", "x2", "y2")  # the same, with the turn itself
PARENT = ("u1", "v1", "u2", "v2")
UNIT = (1, 0, 1, 0)

Value = tuple[int, ...]


def turn_name(seed: int, role: bytes, text: bytes) -> Value:
    """Two affine maps for a turn; multipliers are never 0."""
    d = hashlib.blake2b(len(role).to_bytes(8, "little") + role + text, digest_size=32, salt=seed.to_bytes(16, "little")).digest()
    a, b, c, e = (int.from_bytes(d[i : i + 8], "little") for i in range(0, 32, 8))
    return 1 + a % (PRIME - 1), b % PRIME, 1 + c % (PRIME - 1), e % PRIME


def product(x: Value, y: Value) -> Value:
    """The fingerprint of a sequence ``x`` followed by ``y``."""
    return (
        x[0] * y[0] % PRIME,
        (y[0] * x[1] + y[1]) % PRIME,
        x[2] * y[2] % PRIME,
        (y[2] * x[3] + y[3]) % PRIME,
    )


def inverse(x: Value) -> Value:
    """The map with ``product(inverse(x), product(x, y)) == y``."""
    i, j = pow(x[0], -1, PRIME), pow(x[2], -1, PRIME)
    return i, -x[1] * i % PRIME, j, -x[3] * j % PRIME


def counted(x: Value, y: Value) -> Value:
    """``product``, with the number of turns as a fifth part."""
    return *product(x, y), x[4] + y[4]


def added(x: Value, y: Value) -> Value:
    return (x[0] + y[0],)


def scanned(
    df: DataFrame,
    segment: str,
    order: Sequence[Column],
    elements: Sequence[str],
    out: Sequence[str],
    combine: Callable[[Value, Value], Value],
    unit: Value,
    label: str,
    upto: Sequence[str] = (),
) -> DataFrame:
    """``df`` with ``out``: the product of the ``elements`` of earlier rows of the same
    ``segment`` (never null), in ``order``; and ``upto``, if given: that product with the row's own.

    Every task scans the sorted rows it holds and the result is written; then one row
    per task says what its first and last segment came to, and rows of a segment that
    began in an earlier task are multiplied by what it had come to there.
    """
    importable(df.sparkSession)
    sorted_rows = df.repartitionByRange(F.col(segment), *order).sortWithinPartitions(F.col(segment), *order)
    places = [df.columns.index(c) for c in elements]
    key = df.columns.index(segment)
    fields = [T.StructField(c, T.LongType()) for c in (*out, "_part", "_pos", "_run")]
    schema = T.StructType([*df.schema.fields, *fields])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, pos, run, at, so_far = TaskContext.get().partitionId(), 0, -1, None, unit
        for batch in batches:
            rows = []
            for name, *element in zip(batch.column(key).to_pylist(), *[batch.column(p).to_pylist() for p in places]):
                if run < 0 or name != at:
                    run, at, so_far = run + 1, name, unit
                rows.append((*so_far, part, pos, run))
                so_far = combine(so_far, tuple(element))
                pos += 1
            new = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(fields)
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema.names)

    laid = write_shared(sorted_rows.mapInArrow(local, schema), label)
    row = F.struct(F.col(segment).alias("segment"), F.col("_run").alias("run"), F.array(*elements).alias("e"), F.array(*out).alias("x"))
    edges = laid.groupBy("_part").agg(
        F.max_by(row, "_pos").alias("last"), F.max_by(row, F.when(F.col("_run") == 0, F.col("_pos"))).alias("first")
    )
    carry: dict[int, Value] = {}
    open_segment, open_value = None, unit
    for edge in sorted(edges.collect(), key=lambda r: r["_part"]):  # one row a task
        first, last = edge["first"], edge["last"]
        value = combine(tuple(first["x"]), tuple(first["e"]))
        if first["segment"] == open_segment:
            carry[edge["_part"]] = open_value
            value = combine(open_value, value)
        if last["run"]:
            value = combine(tuple(last["x"]), tuple(last["e"]))
        open_segment, open_value = last["segment"], value
    spots, given = [schema.names.index(c) for c in out], len(df.columns)
    part_at, run_at = schema.names.index("_part"), schema.names.index("_run")
    full = T.StructType([*df.schema.fields, *[T.StructField(c, T.LongType()) for c in (*out, *upto)]])

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            values = list(zip(*[columns[s].to_pylist() for s in spots]))
            for k, (part, run) in enumerate(zip(columns[part_at].to_pylist(), columns[run_at].to_pylist())):
                if run == 0 and part in carry:
                    values[k] = combine(carry[part], values[k])
            if upto:
                own = zip(*[columns[p].to_pylist() for p in places])
                values = [(*v, *combine(v, e)) for v, e in zip(values, own)]
            new = [pa.array(c, pa.int64()) for c in zip(*values)] or [pa.array([], pa.int64())] * len((*out, *upto))
            yield pa.RecordBatch.from_arrays([*columns[:given], *new], full.names)

    return laid.mapInArrow(carried, full) if carry or upto else laid.select(*df.columns, *out)


def named_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """Slim rows (``conv_id``, ``turn``, name, ``words``, ``one``); texts stay in their tasks."""
    importable(conversations.sparkSession)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("conv_id", "turn", *TURN, "words", "one")])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))
            named = [(*turn_name(seed, r or b"", t or b""), len((t or b"").split()), 1) for r, t in zip(roles, texts)]
            new = [pa.array(c, pa.int64()) for c in zip(*named)] or [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], schema.names)

    return rows.mapInArrow(name, schema)


def ambiguous_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """Names that stand for more than one (role, text); only names are checked that
    more than one turn has, so only such texts are shuffled."""
    importable(conversations.sparkSession)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.LongType()) for c in TURN]])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = (batch.column(i).cast(pa.binary()).to_pylist() for i in (0, 1))
            new = [pa.array(c, pa.int64()) for c in zip(*[turn_name(seed, r, t) for r, t in zip(roles, texts)])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(new or [pa.array([], pa.int64())] * 4)], schema.names)

    seen = rows.mapInArrow(name, schema).groupBy(*TURN).agg(
        F.min("role").alias("r0"), F.max("role").alias("r1"), F.min("text").alias("t0"), F.max("text").alias("t1")
    )
    return seen.where("r0 <> r1 OR t0 <> t1")


def heads(prefixes: DataFrame, base: Column, head: Column) -> DataFrame:
    """A row per conversation: ``h`` (head turns asked for), ``k`` (those the base has),
    ``n_turns`` when rebuilt, products ``own`` of its own head and ``of_base`` of the
    base's, and ``first`` (the base's first turns, at most ``MAX_HEAD``)."""
    early = F.when(
        F.col("ordinal") <= MAX_HEAD,
        F.struct("ordinal", F.array(*PREFIX).alias("p"), F.array(*UPTO).alias("x"), F.array(*TURN).alias("t"), "words"),
    )
    convs = prefixes.groupBy("conv_id").agg(
        F.max("ordinal").alias("m"), F.array_sort(F.collect_list(early)).alias("early")
    )
    asked = convs.withColumns({"h": F.least(head, F.lit(MAX_HEAD)).cast("long"), "base": base})
    bases = convs.select(F.col("conv_id").alias("base"), F.col("m").alias("base_m"), F.col("early").alias("base_early"))
    joined = asked.join(bases, "base", "left")
    unit = F.array(*[F.lit(u).cast("long") for u in UNIT])
    reached = lambda early, n: F.when(n > 0, F.element_at(early, n.cast("int"))["x"]).otherwise(unit)
    k = F.least("h", F.coalesce("base_m", F.lit(0))).cast("long")
    return joined.withColumn("k", k).select(
        "conv_id",
        "base",
        "h",
        "k",
        (F.col("k") + F.greatest(F.col("m") - F.col("h"), F.lit(0))).alias("n_turns"),
        reached("early", F.least("h", "m")).alias("own"),
        reached("base_early", F.col("k")).alias("of_base"),
        F.when(F.col("k") > 0, F.slice("base_early", 1, F.col("k").cast("int"))).otherwise(F.slice("early", 1, 0)).alias("first"),
    )


def members(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """A row per rebuilt conversation and depth: fingerprint, the parent's, the last
    turn's name, ``words`` and reference (``ref_conv``, ``ref_turn``: the original turn
    that stands there, from 1), and ``ends`` (1 if the conversation ends there)."""
    facts = convs.select(F.col("conv_id").alias("of"), "h", "k", "n_turns", "own", "of_base")
    own = prefixes.drop(*UPTO).join(facts, prefixes["conv_id"] == facts["of"]).where("ordinal > h").drop("of")
    names = ["conv_id", "depth", *PREFIX, *PARENT, *TURN, "words", "ref_conv", "ref_turn", "ends"]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names])
    columns = own.columns
    at = {c: columns.index(c) for c in columns}

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, Value] | None = None
        for batch in batches:
            got = {c: batch.column(i).to_pylist() for c, i in at.items()}
            rows = []
            for i, conv in enumerate(got["conv_id"]):
                if last is None or last[0] != conv:  # the change of heads, once a conversation
                    last = conv, product(tuple(got["of_base"][i]), inverse(tuple(got["own"][i])))
                name = tuple(got[c][i] for c in TURN)
                parent = product(last[1], tuple(got[c][i] for c in PREFIX))
                ordinal, depth = got["ordinal"][i], got["k"][i] + got["ordinal"][i] - got["h"][i]
                rows.append(
                    (conv, depth, *product(parent, name), *parent, *name, got["words"][i], conv, ordinal, int(depth == got["n_turns"][i]))
                )
            new = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays(new, names)

    first = convs.withColumn("t", F.explode("first")).select(
        "conv_id",
        F.col("t.ordinal").alias("depth"),
        *[F.col("t.x")[i].alias(c) for i, c in enumerate(PREFIX)],
        *[F.col("t.p")[i].alias(c) for i, c in enumerate(PARENT)],
        *[F.col("t.t")[i].alias(c) for i, c in enumerate(TURN)],
        F.col("t.words").alias("words"),
        F.col("base").alias("ref_conv"),
        F.col("t.ordinal").alias("ref_turn"),
        (F.col("t.ordinal") == F.col("n_turns")).cast("long").alias("ends"),
    )
    nothing = {c: F.lit(None).cast("long") for c in (*PARENT, *TURN, "ref_conv", "ref_turn")}
    root = convs.select("conv_id", "n_turns").withColumns(
        {"depth": F.lit(0).cast("long"), "words": F.lit(0).cast("long"), "ends": (F.col("n_turns") == 0).cast("long")}
        | {c: F.lit(u).cast("long") for c, u in zip(PREFIX, UNIT)}
        | nothing
    )
    return own.mapInArrow(rebuild, schema).unionByName(first).unionByName(root.select(*names))


NODE = ("depth", *PREFIX)


def grouped_nodes(rows: DataFrame) -> DataFrame:
    """A row per node; ``same`` tells whether all members have one parent and one last turn."""
    one = [F.min(c).eqNullSafe(F.max(c)) for c in (*PARENT, *TURN)]
    return rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in PARENT],
        F.max("words").alias("words"),
        F.min(F.struct("ref_conv", "ref_turn")).alias("last_turn"),
        F.sum("ends").alias("n_ends"),
        reduce(Column.__and__, one).alias("same"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node with ends: SHA-256 of their ids, ascending, joined by commas."""
    ends = ends.select(*NODE, "conv_id")
    chunk = T.StructType([*ends.schema.fields, T.StructField("ids", T.StringType())])
    digest = T.StructType([*ends.schema.fields[:-1], T.StructField("ends_sha256", T.StringType())])
    n = len(NODE)

    def flushed(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
        types = [pa.int64()] * (len(schema) - 1) + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for *node, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if ids and (node != key or len(ids) == CHUNK_IDS):
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = node
                ids.append(conv)
            if out:
                yield flushed(out, chunk)
        if ids:
            yield flushed([(*key, ids[0], ",".join(map(str, ids)))], chunk)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for *node, ids in zip(*columns[:n], columns[-1]):
                if node != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield flushed(out, digest)
        if state is not None:
            yield flushed([(*key, state.hexdigest())], digest)

    chunks = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(join, chunk)
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(read, digest)


def verified_nodes(conversations: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Members and nodes, after the checks of the module's text."""
    for seed in range(SEEDS):
        turns = scanned(
            named_turns(conversations, seed),
            "conv_id",
            [F.col("turn").asc_nulls_first(), *map(F.col, TURN)],
            [*TURN, "one"],
            [*PREFIX, "before"],
            counted,
            (*UNIT, 0),
            "trie-turns",
            [*UPTO, "ordinal"],
        )
        prefixes = turns.select("conv_id", "ordinal", *PREFIX, *UPTO, *TURN, "words")
        convs = write_shared(heads(prefixes, base, head), "trie-heads")
        rows = write_shared(members(prefixes, convs), "trie-members")
        nodes = write_shared(grouped_nodes(rows), "trie-nodes")
        if nodes.where("NOT same").isEmpty() and ambiguous_turns(conversations, seed).isEmpty():
            return rows, nodes
    raise RuntimeError("turns of different texts kept getting equal names")


def prefix_trie(conversations: DataFrame, base: Column, head: Column) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    ``conversations`` has ``conv_id``, ``turn``, ``role``, ``text``; ``base`` and ``head`` are
    expressions over ``conv_id``: whose first turns a conversation takes, and how many
    (``MAX_HEAD`` at most).  Turns are ordered by ``turn`` (null first); equal turn numbers are
    ordered by their digests, and repeated rows are repeated turns.  A null role or
    text is empty.  Rows without a ``conv_id`` belong to no conversation and are left
    out.  An empty table has no nodes, not even a root.  Further columns are not
    looked at.  Returned per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and ``last_turn``, the
    conversation and place (from 1) of an original turn that stands there.
    """
    rows, nodes = verified_nodes(conversations, base, head)
    above = (F.col("depth") - 1).alias("depth")
    up = nodes.where("depth > 0").select(above, *[F.col(u).alias(p) for u, p in zip(PARENT, PREFIX)])
    children = up.groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    valued = nodes.join(children, list(NODE), "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
            "saves": (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    owned = scanned(valued, "conv_id", [F.col("depth")], ["saves"], ["owned_above"], added, (0,), "trie-owned")
    owned = write_shared(owned, "trie-nodes-owned")
    by_owner = owned.groupBy(F.col("conv_id").alias("owner")).agg(
        F.sum("saves").alias("owner_saves"), F.sum((F.col("n_children") == 0).cast("long")).alias("owner_leaves")
    )
    worth = by_owner.where("owner_saves > 0 OR owner_leaves > 0")
    below = (
        rows.select("conv_id", *NODE)
        .join(worth, rows["conv_id"] == worth["owner"])
        .groupBy(*NODE)
        .agg(F.sum("owner_saves").alias("members_save"), F.sum("owner_leaves").alias("n_leaves"))
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(p).alias(u) for u, p in zip(PARENT, PREFIX)], F.col("conv_id").alias("parent_conv_id"))
    digests = end_digests(rows.where("ends = 1"))
    return (
        owned.join(below, list(NODE))
        .join(digests, list(NODE), "left")
        .join(parents, ["depth", *PARENT], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("members_save") - F.col("owned_above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
            "last_turn",
        )
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``, rebuilt on the first of each twenty."""
    conv = F.col("conv_id")
    nodes = prefix_trie(
        table(spark, sf_dir, "conversations"), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4
    )
    return nodes.drop("last_turn")
