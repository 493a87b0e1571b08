"""Links inside families of near copies, by an index of differences.

A family is a group of sets that resemble each other; most of its pairs may lie
below the threshold, and all of them share most shingles, so index lists over the
sets would make every pair meet.  Here each set is kept as its difference from a
reference set of the family, the shingles that most members have:

* ``|A xor B| = |DA| + |DB| - 2 |DA and DB|`` for the differences DA and DB, so two
  members are linked exactly if their differences share enough.  With
  ``w = (100 + p) |D| - (100 - p) |A|`` for p percent that is
  ``2 (100 + p) |DA and DB| >= wa + wb``.
* Members whose ``w`` and the family's least ``w`` add up to 0 or less are linked
  with the member that has the least; all links with ``wa + wb <= 0`` join two of
  these, so nothing is asked about them.
* All other links share a part of their differences.  Only the prefix of a
  difference that must hold a first common shingle is indexed, shingles that few
  members differ in first.

No text, set or difference is dropped, and no list is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import write_shared


#: What names a member's set.
MEMBER = ["family", "node", "copy"]


def differences(kin: DataFrame, sets: DataFrame) -> DataFrame:
    """(family, node, copy, unit, n, diff) of the members ``kin`` (node, family, unit):
    the shingles in which a set and that of its family's first member differ.

    A node may be in several families; an id that several rows have has a row for
    each of their sets, told apart by ``copy``."""
    mine = sets.select("node", F.col("shingles").alias("own"))
    first = sets.select(F.col("node").alias("family"), F.col("shingles").alias("ref"))
    return (
        kin.join(mine, "node").join(first, "family")
        .select(
            "family", "node", F.xxhash64("own").alias("copy"), "unit", F.size("own").cast("long").alias("n"),
            F.concat(F.array_except("own", "ref"), F.array_except("ref", "own")).alias("diff"),
        )
        .dropDuplicates(MEMBER)
    )


def _referred(near: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``near`` with differences from the majority of each family instead of its
    first member, and (family, token, c): the members that now differ in a shingle."""
    counts = write_shared(
        near.select("family", F.explode("diff").alias("token")).groupBy("family", "token").agg(F.count(F.lit(1)).alias("c")),
        "difference-counts",
    )
    sizes = near.groupBy("family").agg(F.count(F.lit(1)).alias("m"))
    counts = counts.join(sizes, "family").withColumn("most", 2 * F.col("c") > F.col("m"))
    # A list has at most twice as many shingles as a member differs in on average.
    moved = counts.where("most").groupBy("family").agg(F.collect_list("token").alias("moved"))
    own = near.join(moved, "family", "left").withColumn("moved", F.coalesce("moved", F.array().cast("array<long>")))
    own = own.withColumn("diff", F.concat(F.array_except("diff", "moved"), F.array_except("moved", "diff"))).drop("moved")
    counts = counts.select("family", "token", F.when(F.col("most"), F.col("m") - F.col("c")).otherwise(F.col("c")).alias("c"))
    return own, counts


def family_links(near: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) such that every link between members of one family lies in a
    component of them and of the given units.

    ``near`` has the rows of :func:`differences` and ``guest``; members of one
    ``unit`` are known to be connected, and two guests need not meet here."""
    own, counts = _referred(near)
    r, n = F.size("diff").cast("long"), F.col("n")
    own = write_shared(own.withColumn("r", r).withColumn("w", (100 + percent) * r - (100 - percent) * n), "family-differences")
    least = own.groupBy("family").agg(F.min(F.struct("w", "node")).alias("least"))
    own = own.join(least.select("family", F.col("least.w").alias("w0"), F.col("least.node").alias("centre")), "family")
    own = own.withColumn("central", F.col("w") + F.col("w0") <= 0)
    surely = own.where(F.col("central") & (F.col("node") != F.col("centre"))).select(F.col("node").alias("a"), F.col("centre").alias("b"))

    def needed(w: Column) -> Column:
        return F.greatest(F.lit(1).cast("long"), F.ceil(w / (2.0 * (100 + percent)) - 1e-9))

    # Positions in the family's order of shingles, rare ones first.
    told = own.select(*MEMBER, F.explode("diff").alias("token")).join(counts, ["family", "token"])
    order = told.groupBy(*MEMBER).agg(F.array_sort(F.collect_list(F.struct("c", "token"))).alias("order"))
    head = F.slice("order", F.lit(1), F.greatest(F.lit(0).cast("long"), F.col("r") - needed(F.col("w") + F.col("w0")) + 1).cast("int"))
    known = [*MEMBER, "unit", "guest", "central", "n", "w"]
    entries = (
        own.select(*known, "r", "w0").join(order, MEMBER)
        .select(*known, "r", F.posexplode(head).alias("pos", "entry"))
        .where("entry.c > 1")  # in one difference alone it meets nothing
        .select(*known, F.col("entry.token").alias("token"), (F.col("r") - F.col("pos")).alias("left"))
    )
    entries = write_shared(entries, "difference-lists")
    x, y = entries.alias("x"), entries.alias("y")
    may = (
        (F.col("x.family") == F.col("y.family")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.unit") != F.col("y.unit")) & ~(F.col("x.central") & F.col("y.central")) & ~(F.col("x.guest") & F.col("y.guest"))
        & (percent * F.greatest("x.n", "y.n") <= 100 * F.least("x.n", "y.n"))
        # What follows the first common shingle has to be enough.
        & (F.least("x.left", "y.left") >= needed(F.col("x.w") + F.col("y.w")))
    )
    met = x.join(y, may).select(
        F.col("x.family").alias("family"), F.col("x.node").alias("a"), F.col("x.copy").alias("copy_a"),
        F.col("y.node").alias("b"), F.col("y.copy").alias("copy_b"),
    )
    pairs = write_shared(met.distinct(), "difference-pairs")
    one = own.select("family", F.col("node").alias("a"), F.col("copy").alias("copy_a"), F.col("w").alias("wa"), F.col("diff").alias("da"))
    two = own.select("family", F.col("node").alias("b"), F.col("copy").alias("copy_b"), F.col("w").alias("wb"), F.col("diff").alias("db"))
    shared = F.size(F.array_intersect("da", "db")).cast("long")
    both = pairs.join(one, ["family", "a", "copy_a"]).join(two, ["family", "b", "copy_b"])
    linked = both.where(2 * (100 + percent) * shared >= F.col("wa") + F.col("wb"))
    return write_shared(surely.unionByName(linked.select("a", "b")).distinct(), "family-links")
