"""Column-function fixtures over the test tables (F1-F5, F11-F18 coverage queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.mathx import cell_number, half_even, half_even_float, ratio, serial_to_date
from martforge.functions.text import (after_colon, concat_key, not_contains_ci, strip_copy_suffix, strip_unit,
                                      zfill)


def text_fixture(part: DataFrame) -> DataFrame:
    """Text helpers on part names and brands."""
    k = F.col("p_partkey")
    header = F.when(k % 2 == 0, F.concat(F.col("p_name"), F.lit(" (lb)"))).otherwise(F.col("p_name"))
    copy = F.concat(F.col("p_brand"), F.lit("."), (F.col("p_size") % 5).cast("string"))
    labelled = F.when(k % 2 == 0, F.concat(F.lit("Brand: "), F.col("p_brand"))).otherwise(F.col("p_brand"))
    return part.select(
        "p_partkey",
        zfill(k.cast("string"), 4).alias("padded"),
        strip_unit(header).alias("header"),
        strip_copy_suffix(copy).alias("copy_name"),
        after_colon(labelled).alias("label_value"),
        concat_key(F.col("p_brand"), F.when(F.col("p_size") > 25, F.col("p_type")), sep="|").alias("key"),
        not_contains_ci("p_name", "green").alias("no_green"),
    )


def math_fixture(lineitem: DataFrame) -> DataFrame:
    """Numeric helpers on line items."""
    n = F.col("l_linenumber")
    q = F.col("l_quantity").cast("int")
    cell = (F.when(n == 1, F.lit("")).when(n == 2, F.lit("-"))
            .when(n == 3, F.concat(F.lit("-"), q.cast("string"))).otherwise(q.cast("string")))
    return lineitem.select(
        "l_orderkey", "l_linenumber",
        serial_to_date((F.col("l_orderkey") % 40000 + 20000).cast("string")).alias("serial_date"),
        half_even(F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(0.005).cast("decimal(4,3)"), 2)
        .cast("decimal(18,2)").alias("price_rounded"),
        F.abs(q - 25).alias("abs_dev"),
        F.coalesce(half_even_float(ratio("l_extendedprice", "l_discount"), 2), F.lit(0.0))
        .cast("decimal(18,2)").alias("price_per_discount"),
        F.col("l_returnflag").try_cast("int").alias("flag_number"),
        cell_number(cell).cast("decimal(18,0)").alias("cell_value"),
    )
