"""A key holding a third of the rows: operators stay aggregation + join (no
window on the key, no per-key collection) and give whole, exact results."""

from pyspark.sql import functions as F

from martforge.operators import dedup, stats


def hot_frame(spark, n=30000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("o"),
        (F.col("id") % 97 + 100).cast("int").alias("avg_carcass_wt"),
        F.lit("G").alias("group_num"),
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_duplicates_without_window(spark):
    df = hot_frame(spark)
    marked = dedup.mark_duplicate_keys(df, ["k"])
    assert "Window" not in plan(marked)
    assert marked.filter("is_dup").count() == 10000
    later = dedup.mark_later_duplicates(df, ["k"], ["o"])
    assert "Window" not in plan(later)
    assert later.filter("is_later").count() == 10000 - 1  # exactly one row of the hot key is first


def test_hot_key_unique_join_keeps_all_rows(spark):
    df = hot_frame(spark)
    header = spark.range(1, 30000).select(F.col("id").alias("k"), F.lit("H").alias("g"))
    j = dedup.unique_key_join(df, header, ["k"], ["g"])
    assert "Window" not in plan(j)
    assert j.count() == 20000  # every non-hot row joins once; the hot key 0 has no header row


def test_hot_group_statistics_are_partial_aggregations(spark):
    df = hot_frame(spark).withColumn("load_id", (F.col("o") % 2).cast("string"))
    s = stats.load_stddev_avg(df)
    p = plan(s)
    assert "Window" not in p and "partial_" in p.replace("partial_stddev", "partial_")
    assert s.count() == 1
