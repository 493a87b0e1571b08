"""Create / drop catalog tables from the declared schemas (K6)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T


def create_table_sql(name: str, schema: T.StructType, location: str | None = None,
                     partition_by: list[str] | None = None) -> str:
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet"
    if partition_by:
        sql += " PARTITIONED BY (" + ", ".join(partition_by) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    return sql


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str | None = None,
                 partition_by: list[str] | None = None) -> None:
    spark.sql(create_table_sql(name, schema, location, partition_by))


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
