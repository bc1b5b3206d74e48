"""Streaming queries over the events table, run to the end of the landed data
(a closing row lets the watermark pass the last day)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import read_table
from ..streaming import rollups as S
from .registry import register


def _events_stream(spark, d, name, closed_by=None):
    ev = read_table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value",
                                               F.col("value").cast("decimal(18,2)").alias("amount"))
    src = S.land_as_stream_source(ev, name, closed_by)
    return spark.readStream.schema(ev.schema).parquet(src)


@register("events_daily_stream_rollup", covers=("X1",), sql="""
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) AS mean
FROM events GROUP BY 1, 2""")
def events_daily_stream_rollup(spark, d):
    st = _events_stream(spark, d, "events-daily", closed_by="ts")
    out = S.run_append(spark, S.daily_rollup(st, "ts", ["event_type"], "amount"), "events-daily")
    return out.withColumn("total", F.col("total").cast("double"))


@register("events_monthly_stream_rollup", covers=("X2",), sql="""
SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY 1, 2""")
def events_monthly_stream_rollup(spark, d):
    st = _events_stream(spark, d, "events-monthly")
    out = S.run_update(spark, S.monthly_rollup(st, "ts", ["event_type"], "amount"),
                       "events-monthly", ["month", "event_type"])
    return out.withColumns({"month": F.col("month").cast("date"), "total": F.col("total").cast("double")})


@register("events_first_per_day_stream", covers=("X3",), sql="""
SELECT day, event_type, strftime(r.ts, '%Y-%m-%d %H:%M:%S') AS latest, r.value AS value
FROM (SELECT CAST(ts AS DATE) AS day, event_type, max({'ts': ts, 'value': value}) AS r FROM events GROUP BY 1, 2)""")
def events_first_per_day_stream(spark, d):
    st = _events_stream(spark, d, "events-first", closed_by="ts").drop("amount")
    out = S.run_append(spark, S.latest_per_day(st, "ts", "event_type"), "events-first")
    return out.select("day", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("latest"), "value")


PERIOD_DAYS, DELAY_DAYS = 5, 3


@register("events_price_log_stream", covers=("X3", "S12"), sql=f"""
WITH arriving AS (
  SELECT ts, event_type, value, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) // {PERIOD_DAYS}
         + CASE WHEN event_id % 11 = 5 THEN 2 WHEN event_id % 7 = 3 THEN 1 ELSE 0 END AS period
  FROM events WHERE ts IS NOT NULL),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY period) AS file FROM arriving),
newest AS (SELECT file, max(max(ts)) OVER (ORDER BY file) AS t FROM numbered GROUP BY file),
read AS (
  SELECT n.* FROM numbered n LEFT JOIN newest w ON w.file = n.file - 2
  WHERE w.t IS NULL OR CAST(n.ts AS DATE) + INTERVAL 1 DAY > w.t - INTERVAL {DELAY_DAYS} DAY)
SELECT day, event_type, strftime(r.ts, '%Y-%m-%d %H:%M:%S') AS latest, r.value AS value
FROM (SELECT CAST(ts AS DATE) AS day, event_type, max({{'ts': ts, 'value': value}}) AS r FROM read GROUP BY 1, 2)""")
def events_price_log_stream(spark, d):
    """The price log fed by one file a period of five days.  One event in seven arrives a
    period late, one in eleven two; a late event whose day ended three days or more before the
    newest time of the file before the last one is too late (Spark tells late rows by
    the watermark of the batch before)."""
    late = F.when(F.col("event_id") % 11 == 5, 2).when(F.col("event_id") % 7 == 3, 1).otherwise(0)
    ev = read_table(spark, d, "events").where("ts IS NOT NULL").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type", "value",
        (F.floor(F.unix_date(F.col("ts").cast("date")) / PERIOD_DAYS) + late).alias("period"))
    src = S.land_arrivals(ev, "period", "price-log")
    stream = spark.readStream.schema(ev.drop("period").schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = S.price_log(spark, stream, "ts", "event_type", "price-log", f"{DELAY_DAYS} days")
    return out.select("day", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("latest"), "value")
