"""JSON dimensions and nested catalogs.

A dimension document maps a display name to ``{"value": id}``, where ids may
be numbers or strings.  Any number of such documents (one per line or one per
file) parse with one ``from_json`` and one ``explode``: no driver-side JSON.
A catalog is a tree of named nodes whose children sit under ``options``; a
child is either a scalar leaf or a node object.  It is flattened one level per
``explode``, keeping each level's JSON text as a string (``flatten_catalog``, for a known
depth), or walked to any depth in one scan (``walk_catalog``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.session import ensure_checkpoint_dir

DIMENSION_TYPE = "map<string,struct<value:string>>"
LEVEL_TYPE = "map<string,string>"


def parse_dimension(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(name, value)`` of every member of every document.

    Numeric and text ids both come back as text (``12`` and ``"12"`` -> ``'12'``).
    """
    m = F.from_json(F.col(text_col), DIMENSION_TYPE)
    return docs.select(F.explode(m).alias("name", "v")).select("name", F.col("v.value").alias("value"))


def with_all_member(dim: DataFrame, label: str, value: str = "0") -> DataFrame:
    """Add the "All ..." member that means "no filter" (K5)."""
    spark = dim.sparkSession
    sentinel = spark.range(1).select(F.lit(label).alias("name"), F.lit(value).alias("value"))
    return dim.unionByName(sentinel)


def dimension_json(dim: DataFrame) -> DataFrame:
    """One JSON document per member, ``{"<name>": {"value": "<id>"}}`` (the K5 writer format)."""
    return dim.select(F.to_json(F.create_map(F.col("name"), F.struct(F.col("value").alias("value")))).alias("text"))


def write_dimension(dim: DataFrame, path: str) -> None:
    """Write a dimension as JSON lines, distributed (K5)."""
    dimension_json(dim).write.mode("overwrite").text(path)


def _node_value(node: Column) -> Column:
    """A node's own value: ``$.value`` of an object, or the scalar itself."""
    return F.coalesce(F.get_json_object(node, "$.value"),
                      F.when(~F.trim(node).startswith("{"), node))


def _children(node: Column) -> Column:
    return F.from_json(F.get_json_object(node, "$.options"), LEVEL_TYPE)


def flatten_catalog(docs: DataFrame, text_col: str = "text", depth: int = 3) -> DataFrame:
    """``(depth, k1 .. k<depth>, value)`` for every node of every catalog tree.

    Level d holds the nodes reached by d keys; absent deeper keys are NULL.  A
    tree with nodes below ``depth`` keys is refused with an error: none is lost.
    """
    lvl = docs.select(F.explode(F.from_json(F.col(text_col), LEVEL_TYPE)).alias("k1", "n1"))
    out = lvl.select(F.lit(1).alias("depth"), "k1", *[F.lit(None).cast("string").alias(f"k{i}") for i in range(2, depth + 1)],
                     _node_value(F.col("n1")).alias("value"))
    cur, keys = lvl, ["k1"]
    for d in range(2, depth + 1):
        cur = cur.select(*keys, F.explode(_children(F.col(f"n{d - 1}"))).alias(f"k{d}", f"n{d}"))
        keys = keys + [f"k{d}"]
        if d == depth:
            below = F.get_json_object(F.col(f"n{d}"), "$.options")
            deeper = F.raise_error(F.concat(F.lit(f"catalog nodes below {depth} levels, under "), F.col(f"k{d}")))
            cur = cur.withColumn(f"n{d}", F.when(F.size(F.map_keys(F.from_json(below, LEVEL_TYPE))) > 0, deeper.cast("string")).otherwise(F.col(f"n{d}")))
        level = cur.select(F.lit(d).alias("depth"), *keys,
                           *[F.lit(None).cast("string").alias(f"k{i}") for i in range(d + 1, depth + 1)],
                           _node_value(F.col(f"n{d}")).alias("value"))
        out = out.unionByName(level)
    return out


def _members(node: Column) -> Column:
    return F.explode(F.try_variant_get(node, "$", "map<string,variant>")).alias("key", "node")


def walk_catalog(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(depth, path, value)`` of every node of every catalog tree, however deep.

    Documents are scanned and parsed once, as VARIANT; each level is written to the
    cluster's shared folder and is all that the next one reads, so the work is one pass
    over the nodes and a lost executor costs its tasks.  Text that is no JSON object
    gives no nodes (``unparsed`` lists it).
    """
    spark = docs.sparkSession
    place = f"{ensure_checkpoint_dir(spark).rstrip('/')}/catalog-{uuid.uuid4().hex}"
    level = docs.select(_members(F.try_parse_json(F.col(text_col)))).select(F.array("key").alias("path"), "node")
    depth = 0
    while depth == 0 or not level.isEmpty():
        depth += 1
        level.write.parquet(f"{place}/depth={depth}")
        stored = spark.read.schema(level.schema).parquet(f"{place}/depth={depth}")
        level = stored.select("path", _members(F.try_variant_get("node", "$.options", "variant"))).select(
            F.array_append("path", F.col("key")).alias("path"), "node")
    node = F.col("node")
    own = F.when(F.schema_of_variant(node).startswith("OBJECT"), F.try_variant_get(node, "$.value", "string")).otherwise(
        F.try_variant_get(node, "$", "string"))
    return spark.read.schema("path array<string>, node variant, depth int").parquet(place).select("depth", "path", own.alias("value"))


def unparsed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that are no JSON objects (or name a member twice): the rejects of a walk."""
    return docs.filter(F.try_variant_get(F.try_parse_json(F.col(text_col)), "$", "map<string,variant>").isNull())


def code_dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(field, name, code)`` of the option lists of catalog documents (S10): the members of
    every node that has options; codes come as text, whether given as numbers or text."""
    nodes = walk_catalog(docs, text_col)
    return nodes.filter("depth = 2").select(
        F.col("path")[0].alias("field"), F.col("path")[1].alias("name"), F.col("value").alias("code")
    ).filter("code IS NOT NULL").distinct()
