"""Places of all rows in an order, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored


def with_place(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` with the place (from 1) of each row in ``order``, which must tell all rows apart.

    Rows are spread by ranges of the order and sorted within them; the counts of the ranges (one row each) give the
    place where each range begins.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(spread.withColumn("_id", F.monotonically_increasing_id()))
    within = numbered.select(F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"), "*").drop("_id")
    counts = within.groupBy("_range").agg(F.count("*").alias("_n"))
    begins = counts.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_begin"))
    return within.join(begins, "_range").withColumn(name, (F.col("_begin") + F.col("_at") + 1).cast("int")).drop("_range", "_at", "_begin")
