"""Helpers shared by the corpus operators: shared tables, row ids, word patterns."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run without ASCII white space (fixed value, given by the contract).
WORD = r"[^\x20\x09-\x0D]+"

_REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver imported it."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _REPO not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_REPO, *filter(None, paths)])


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset a temporary folder stands in, but only under a ``local``
    master (tests); a cluster without the setting is an error.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="martforge-shared-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path for one intermediate result in the shared folder."""
    return f"{shared_root(spark)}/martforge-{uuid.uuid4().hex}/{label}"


def write_shared(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the reads of its own tasks.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores before it as no column of ``frames`` has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def utf8_text(column: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
