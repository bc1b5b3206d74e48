"""Structured Streaming roll-ups.

The reference refreshes a daily price log when the day is missing; the
streaming form keeps per-day and per-month aggregates of a reading stream
with watermarks, so late rows inside the delay are still counted and state
is dropped once the watermark passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def daily_rollup(stream: DataFrame, ts: str, keys: list[str], value: str,
                 delay: str = "1 hour") -> DataFrame:
    """Tumbling one-day windows per key, append mode (a day is emitted
    once the watermark passes its end)."""
    return (stream.withWatermark(ts, delay)
                  .groupBy(F.window(ts, "1 day").alias("w"), *keys)
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"),
                       (F.sum(value).cast("double") / F.count(value)).alias("mean"))
                  .select(F.col("w.start").cast("date").alias("day"), *keys, "n", "total", "mean"))


def monthly_rollup(stream: DataFrame, ts: str, keys: list[str], value: str,
                   delay: str = "1 day") -> DataFrame:
    """Calendar-month groups; ``window('1 month')`` is not allowed and
    month grouping needs **update** mode (rows re-emitted as they change)."""
    return (stream.withWatermark(ts, delay)
                  .groupBy(F.date_trunc("month", ts).alias("month"), *keys)
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")))


def latest_per_day(stream: DataFrame, ts: str, key: str, delay: str = "1 day") -> DataFrame:
    """The latest row per (day, key); rows of the same time by their other
    columns.  State is one row per open day and key."""
    rest = [c for c in stream.columns if c not in (ts, key)]
    return (stream.withWatermark(ts, delay)
                  .groupBy(F.window(ts, "1 day").alias("w"), key)
                  .agg(F.max(F.struct(ts, *rest)).alias("r"))
                  .select(F.col("w.start").cast("date").alias("day"), key, "r.*"))


def land_as_stream_source(df: DataFrame, name: str, closed_by: str | None = None) -> str:
    """Write a table as a folder of files a file stream source can read.

    ``closed_by`` names the event time: a last row three days after the newest
    one, NULL elsewhere, lets the watermark pass the last day, whose windows an
    append-mode query would otherwise never emit (the row's own never is)."""
    path = scratch_path(df.sparkSession, f"{name}-src")
    df.write.parquet(path)
    if closed_by:
        end = df.agg(F.expr(f"date_trunc('DAY', max({closed_by})) + INTERVAL 3 DAYS").alias(closed_by))
        nulls = [F.lit(None).cast(t).alias(c) if c != closed_by else F.col(c) for c, t in df.dtypes]
        end.filter(F.col(closed_by).isNotNull()).select(*nulls).write.mode("append").parquet(path)
    return path


def land_arrivals(df: DataFrame, arrival: str, name: str) -> str:
    """Write a table as one file per value of ``arrival``, in that order: a file
    stream source that reads one file a trigger sees the rows as they arrived.
    One job a value, so ``arrival`` is a coarse period (days), not a row's time."""
    path = scratch_path(df.sparkSession, f"{name}-src")
    for r in df.select(arrival).distinct().orderBy(arrival).toLocalIterator():
        df.where(F.col(arrival).eqNullSafe(F.lit(r[0]))).drop(arrival).coalesce(1).write.mode("append").parquet(path)
    return path


def write_log_batch(batch: DataFrame, batch_id: int, path: str, day: str = "day") -> None:
    """S12 on a stream: what a micro-batch changed, below a folder of its day and batch.

    Only the partitions of this batch are overwritten, so a batch that is run again
    after a failure replaces its own rows, and rows of other batches are never touched."""
    (batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(day, "batch").parquet(path))


def read_log(spark: SparkSession, path: str, schema, key: str, day: str = "day") -> DataFrame:
    """The log's current row per (day, key): the one of the last batch that changed it."""
    log = spark.read.schema(schema).parquet(path)
    rest = [c for c in log.columns if c not in (day, key, "batch")]
    return log.groupBy(day, key).agg(F.max(F.struct("batch", *rest)).alias("r")).select(day, key, *[f"r.{c}" for c in rest])


def price_log(spark: SparkSession, stream: DataFrame, ts: str, key: str, name: str, delay: str = "3 days") -> DataFrame:
    """X3 + S12: the latest row per (day, key), kept up to date batch by batch.

    The state carries the latest row of every open day between batches; a row whose day
    ended more than ``delay`` before the newest time seen is too late and changes nothing.
    The stream runs to the end of what has landed; the log is then read back."""
    path, ckpt = scratch_path(spark, f"{name}-log"), scratch_path(spark, f"{name}-ckpt")
    rows = latest_per_day(stream, ts, key, delay)
    q = (rows.writeStream.outputMode("update").foreachBatch(lambda b, i: write_log_batch(b, i, path))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return read_log(spark, path, rows.withColumn("batch", F.lit(0).cast("long")).schema, key)


def run_append(spark: SparkSession, query: DataFrame, name: str) -> DataFrame:
    """Run to completion (``availableNow``) into a parquet sink, read it back."""
    sink, ckpt = scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")
    q = (query.writeStream.outputMode("append").format("parquet").option("path", sink)
              .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink)


def run_update(spark: SparkSession, query: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Update-mode query: each micro-batch's changed rows are appended with
    their batch id (``foreachBatch``); the result keeps the latest per key."""
    sink, ckpt = scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")

    def write(batch, batch_id):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(sink)
    q = (query.writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(sink)
    last = out.groupBy(*keys).agg(F.max("_batch").alias("_batch"))
    return out.join(last, keys + ["_batch"]).drop("_batch")
