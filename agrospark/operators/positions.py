"""Global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def global_positions(df: DataFrame, keys: list[str], name: str = "position") -> DataFrame:
    """``df`` with the position (from 1) of every row in the order of ``keys``.

    Rows are dealt by range, numbered within their range and shifted by the sizes of
    the ranges before (one row a range).  The ranges are written first, so numbers and
    sizes are of the same dealing.  Rows that are equal in all keys are numbered in any
    order; they share a range, so the keys should tell rows apart.
    """
    dealt = cut_lineage(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    shift = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return (dealt.withColumn("_own", own).join(shift, "_range")
            .withColumn(name, (F.col("_own") + F.col("_shift")).cast("long")).drop("_range", "_own", "_shift"))


def dense_codes(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """(label, code): the distinct labels numbered from 0 in their own order, exactly."""
    found = global_positions(df.select(label).where(F.col(label).isNotNull()).distinct(), [label], code)
    return found.withColumn(code, (F.col(code) - 1).cast("int"))
