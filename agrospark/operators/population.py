"""Roulette over a population that is a table (J10, G4): distributed prefix sums and an as-of match."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _before(dealt: DataFrame, total, name: str) -> DataFrame:
    """Per range, an aggregate over all ranges before it (one row a range)."""
    rows = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn(name, total(rows))


def prefix_weights(population: DataFrame, key: str = "id", weight: str = "weight") -> DataFrame:
    """(key, weight, start): the sum of the whole weights (long) before each individual, in
    the order of ``key``, which tells individuals apart.  Null and negative weights count 0."""
    w = F.greatest(F.coalesce(F.col(weight).cast("long"), F.lit(0)), F.lit(0))
    dealt = cut_lineage(population.select(F.col(key).alias("id"), w.alias("weight")).repartitionByRange("id")
                        .withColumn("_range", F.spark_partition_id()), "weights")
    sizes = _before(dealt.groupBy("_range").agg(F.sum("weight").alias("_n")),
                    lambda rows: F.coalesce(F.sum("_n").over(rows), F.lit(0)), "_shift").drop("_n")
    own = F.sum("weight").over(Window.partitionBy("_range").orderBy("id").rowsBetween(Window.unboundedPreceding, 0))
    return (dealt.withColumn("_own", own - F.col("weight")).join(sizes, "_range")
            .select(F.col("id").alias(key), F.col("weight").alias(weight), (F.col("_own") + F.col("_shift")).alias("start")))


def roulette_rows(population: DataFrame, draws: DataFrame, key: str = "id", weight: str = "weight",
                  draw: str = "draw", share: str = "share") -> DataFrame:
    """(draw, key): for each draw, whose ``share`` is in [0, 1), the individual in whose stretch
    of the summed weights floor(share * total) falls.

    Individuals and draws are dealt together by their place on the line, so the draws of an
    individual that holds most of the weight spread over many ranges; the last individual of a
    range is carried into the ranges after it (one row a range).  Without any weight, or with a
    null share, a draw's key is null.  Ties of places go to the individual with a weight.
    """
    placed = cut_lineage(prefix_weights(population, key, weight).where(F.col(weight) > 0), "placed")
    total = F.lit(placed.agg(F.max(F.col("start") + F.col(weight))).first()[0]).cast("long")      # one number
    at = F.least(F.floor(F.col(share) * total), total - 1)
    at = F.when(F.col(share).isNotNull(), at)                                            # least() skips nulls
    line = (placed.select(F.col("start").alias("_at"), F.lit(0).alias("_kind"), F.col(key).alias("_id"), F.lit(None).alias("_draw"))
            .unionByName(draws.select(at.alias("_at"), F.lit(1).alias("_kind"),
                                                               F.lit(None).alias("_id"), F.col(draw).alias("_draw"))))
    mixed = F.xxhash64("_draw")                    # parts the draws that meet at one place
    dealt = cut_lineage(line.withColumn("_mix", mixed).repartitionByRange("_at", "_kind", "_mix")
                        .withColumn("_range", F.spark_partition_id()), "line")
    order = ["_at", "_kind", "_mix"]
    last = dealt.groupBy("_range").agg(F.max(F.when(F.col("_kind") == 0, F.struct("_at", "_id")))["_id"].alias("_n"))
    carried = _before(last, lambda rows: F.last("_n", True).over(rows), "_carried").drop("_n")
    here = F.last("_id", True).over(Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (dealt.withColumn("_here", here).join(carried, "_range").where("_kind = 1")
            .select(F.col("_draw").alias(draw),
                    F.when(F.col("_at").isNotNull(), F.coalesce("_here", "_carried")).alias(key)))
