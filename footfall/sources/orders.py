"""Order lines seen as a clickstream: a larger input with many days and many equal times.

The user is the customer, the item the part, the category the number of the part's brand and the
time the (midnight) order date. Order lines have no behaviour; the line number stands in for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.schemas import RAW

BEHAVIOR_OF_LINE = ("pv", "fav", "cart", "buy")  # by line number modulo 4


def orders_as_raw(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Order lines joined with their order and part, as raw clickstream rows.

    A closed range of days is compared with the stored order date and reaches the scan.

    Both joins are left to Spark, which sends a side to every executor only if its size allows
    it and otherwise shuffles, splitting keys that hold too many rows.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    lines = table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    kind = orders.schema["o_orderdate"].dataType
    if start:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(start).cast(kind))
    if end:
        after = F.date_add(F.lit(end).cast("date"), 1).cast(kind)
        orders = orders.filter(F.col("o_orderdate") < after)
    parts = table("part").select("p_partkey", "p_brand")
    names = F.array(*(F.lit(b) for b in BEHAVIOR_OF_LINE))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            F.substring_index("p_brand", "#", -1).try_cast("bigint").alias("category_id"),
            F.element_at(names, F.col("l_linenumber") % 4 + 1).alias("behavior"),
            F.unix_timestamp("o_orderdate").alias("timestamp"),
        )
        .select(*RAW.names)
    )
