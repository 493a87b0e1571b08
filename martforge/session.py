"""Session helpers.

Library code never builds its own session: every operator takes DataFrames and
returns DataFrames.  These helpers exist for tests, the bench and the run driver.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes (so no
# side is broadcast unless it is measured small), coalesces small shuffle
# partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Wide generated projections (the 256-column closeout row) make constraint
    # propagation super-linear in plan size; it only infers extra filters.
    "spark.sql.constraintPropagation.enabled": "false",
}


def tune_for_wide_plans(spark: SparkSession) -> None:
    """Planner setting for the wide form plans (result-neutral)."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "martforge") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is.  Only when it is unset (local tests) do we create a scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="martforge-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def write_staged(df: DataFrame, label: str) -> DataFrame:
    """``df``, written to a new place in the shared folder and read from there: what
    several parts of a plan need is worked out once, and its size is known."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
